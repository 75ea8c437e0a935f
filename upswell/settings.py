"""Values that define the meaning of the results. Every operator takes them as defaults."""

# --- fixed values: size bands, (lower bound, label), left-closed ---
SIZE_BANDS = (
    (0, "<10k"),
    (10_000, "10k-50k"),
    (50_000, "50k-500k"),
    (500_000, "500k-2M"),
    (2_000_000, "2M+"),
)
SUPERSTAR_BAND = "2M+"
EMERGING_BANDS = ("<10k", "10k-50k", "50k-500k")

# --- fixed values: growth score ---
SHORT_WINDOW_DAYS = 7
LONG_WINDOW_DAYS = 14
CHART_WINDOW_DAYS = 14
MIN_BAND_SIZE = 10
Z_CLIP = 5.0
MAD_TO_SD = 1.4826
CHART_ENTRY_CAP = 3
SCORE_WEIGHTS = {
    "listener_growth_z": 0.45,
    "play_growth_z": 0.25,
    "chart_entry_points": 0.15,
    "yt_view_growth_z": 0.15,
}

# --- fixed values: pool upkeep ---
SIMILAR_LIMIT = 15
MAX_POOL_SIZE = 5000
MAX_SEED_SHARE = 0.4
POOL_MAX_AGE_DAYS = 7
MAX_EVENT_ENTITIES = 2500

# --- fixed values: name matching ---
AUTO_THRESHOLD = 95
REVIEW_THRESHOLD = 85
MIN_FUZZY_LEN = 5
MATCHED_METHODS = ("mbid", "exact", "fuzzy")
TRIBUTE_PHRASES = (
    "tribute",
    "salute to",
    "the music of",
    "celebrating the music",
    "songs of",
    "a night of",
)

# --- fixed values: serving ---
MAX_LIMIT = 50
STALE_AFTER_DAYS = 2
EVENT_HORIZON_DAYS = 90
HISTORY_EXPORT_DAYS = 30
CANCELED = ("canceled", "cancelled")
CHEAP_PRICE = 30.0
RISING_SCORE = 70.0

# --- fixed values: taste ---
SEED_COUNT = 50
SIM_WEIGHT, TAG_WEIGHT = 0.7, 0.3
ENTITY_TAGS, SEED_TAGS = 5, 10
ESTABLISHED, SMALL_FLOOR = 1_000_000, 10_000
JUNK_TAGS = ("seen live", "favorites", "favourites", "favorite", "fav", "love", "albums i own")
SHOW_WEIGHTS = {
    "any": {"connection": 0.4, "breakout": 0.4, "emerging": 0.2},
    "mine": {"familiarity": 0.55, "breakout": 0.25, "emerging": 0.2},
    "new": {"match": 0.35, "novelty": 0.25, "breakout": 0.25, "emerging": 0.15},
}
SUPPORT_SLOT = 0.8
CHEAP_WEIGHT = 0.35
CHEAP_SCALE = 100.0

# --- fixed values: run quality ---
MIN_COVERAGE = 0.90
MAX_PARSE_LOSS = 0.01
MAX_ERROR_RATE = 0.10
RELOAD_RECENT_DAYS = 2

# --- fixed values: brief texts ---
MAX_BIO_CHARS = 900
BRIEF_TOP_N = 50
BRIEF_SHOWS = 100
NO_LABEL = "No label mentioned in the Last.fm bio"

# --- fixed values: tracked chart countries, (chart name, ISO code, nationality word) ---
COUNTRIES = (
    ("Canada", "CA", "canadian"),
    ("United States", "US", "american"),
    ("United Kingdom", "GB", "british"),
    ("Ireland", "IE", "irish"),
    ("Australia", "AU", "australian"),
    ("Brazil", "BR", "brazilian"),
    ("Mexico", "MX", "mexican"),
    ("Argentina", "AR", "argentine"),
    ("Colombia", "CO", "colombian"),
    ("Chile", "CL", "chilean"),
    ("Spain", "ES", "spanish"),
    ("France", "FR", "french"),
    ("Germany", "DE", "german"),
    ("Italy", "IT", "italian"),
    ("Netherlands", "NL", "dutch"),
    ("Sweden", "SE", "swedish"),
    ("Poland", "PL", "polish"),
    ("Nigeria", "NG", "nigerian"),
    ("South Africa", "ZA", "south african"),
    ("Japan", "JP", "japanese"),
    ("Korea, Republic of", "KR", "korean"),
    ("Philippines", "PH", "filipino"),
)
COUNTRY_ALIASES = (
    ("usa", "United States"),
    ("uk", "United Kingdom"),
    ("south korea", "Korea, Republic of"),
    ("korea", "Korea, Republic of"),
)
