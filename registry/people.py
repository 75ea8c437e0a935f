from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from registry.ingest import event_lines
from registry.serving import joined, shows_table, today
from upswell import views
from upswell.functions import text
from upswell.operators import fuzzy, latest
from upswell.operators.robust import with_ranks
from upswell.plans import briefs, pool, resolve, shows, signals, taste
from upswell.sources import export, landing
from upswell.staging import staged


# --- names ---------------------------------------------------------------------------------


def normalize_names(spark: SparkSession, folder: str) -> DataFrame:
    """Every page title and every document's first line in its normalized forms."""
    titles = views.table(spark, folder, "pages").select(
        F.regexp_extract("html", "<title>(.*?)</title>", 1).alias("name")
    )
    lines = views.table(spark, folder, "documents").select(
        F.substring_index("text", "\n", 1).alias("name")
    )
    names = titles.union(lines).distinct()
    return names.select(
        "name",
        text.normalize_name(F.col("name")).alias("normalized"),
        text.match_form(F.col("name")).alias("match_form"),
        text.fold_place(F.col("name")).alias("place"),
        text.is_tribute(F.col("name")).alias("tribute"),
    )


def entity_keys(spark: SparkSession, folder: str) -> DataFrame:
    return views.table(spark, folder, "part").select(
        "p_partkey",
        text.entity_key(
            F.concat(F.lit("  "), F.upper("p_name"), F.lit("  Ünit ")),
            F.when(F.col("p_size") > 25, F.concat(F.lit("P-"), "p_partkey")).when(
                F.col("p_size") > 10, ""
            ),
        ).alias("artist_key"),
        text.pseudonym(F.col("p_brand")).alias("pseudonym"),
        text.valid_username(F.replace("p_brand", F.lit("#"), F.lit("-"))).alias("valid"),
        text.valid_username(F.col("p_brand")).alias("invalid"),
    )


def ascii_clean(spark: SparkSession, folder: str) -> DataFrame:
    return views.table(spark, folder, "documents").select(
        "doc_id", F.md5(text.ascii_punctuation(F.col("text"))).alias("clean")
    )


def html_anchor_strip(spark: SparkSession, folder: str) -> DataFrame:
    return views.table(spark, folder, "pages").select(
        "page_id", F.md5(text.strip_anchors(F.col("html"))).alias("stripped")
    )


def word_truncate(spark: SparkSession, folder: str) -> DataFrame:
    return views.table(spark, folder, "documents").select(
        "doc_id", text.truncate_words(F.col("text")).alias("shortened")
    )


def fuzzy_candidates(spark: SparkSession, folder: str) -> DataFrame:
    """All pairs of billed and tracked names that are at least 85 alike."""
    left = views.title_performers(spark, folder).select(
        fuzzy.sorted_tokens(text.match_form(F.col("performer_name"))).alias("text")
    )
    right = views.title_artists(spark, folder).select(
        fuzzy.sorted_tokens(text.match_form(F.col("name"))).alias("text")
    )
    return fuzzy.similar_texts(left.distinct(), right.distinct()).withColumn(
        "score", F.round("score", 6)
    )


def matches(spark: SparkSession, folder: str) -> DataFrame:
    return resolve.match_performers(
        views.title_performers(spark, folder), views.title_artists(spark, folder)
    )


def entity_match(spark: SparkSession, folder: str) -> DataFrame:
    return matches(spark, folder).withColumn("match_score", F.round("match_score", 6))


def match_counts(spark: SparkSession, folder: str) -> DataFrame:
    return resolve.match_counts(matches(spark, folder))


def match_review(spark: SparkSession, folder: str) -> DataFrame:
    """Uncertain names with the page (as the event) they are billed on."""
    events = views.table(spark, folder, "pages").select(
        F.col("page_id").alias("event_id"),
        F.col("url").alias("event_name"),
        F.lit("2001-06-01").cast("date").alias("event_date"),
        F.lit("web").alias("venue"),
    )
    return resolve.review_queue(
        matches(spark, folder), views.title_performers(spark, folder), events
    ).withColumn("match_score", F.round("match_score", 6))


ASKED = [
    "Small Ring", "smal ring", "the red widget", "rd widgt", "blue  bolt!", "bolt blue",
    "hot gaer", "large plates", "old", "xylophone",
]


def fuzzy_lookup(spark: SparkSession, folder: str) -> DataFrame:
    named = views.catalog_signals(spark, folder).drop("name").join(
        views.table(spark, folder, "part").select(
            F.concat(F.lit("mbid:p"), "p_partkey").alias("artist_key"), F.col("p_name").alias("name")
        ),
        "artist_key",
    )
    found = resolve.find_entities(named, ASKED)
    return found.withColumn(
        "alternatives",
        F.array_join(
            F.transform("alternatives", lambda a: F.concat(a["name"], F.lit("="), a["score"])), "|"
        ),
    )


def closest_words(spark: SparkSession, folder: str) -> DataFrame:
    """For the last word of every page title, the four first words of titles most like it."""
    words = F.split(F.lower(F.regexp_extract("html", "<title>(.*?)</title>", 1)), " ")
    pages = views.table(spark, folder, "pages").select(words[0].alias("first"), F.element_at(words, -1).alias("last"))
    entries = pages.select(F.col("first").alias("text"), F.col("first").alias("label")).filter("text <> ''")
    found = fuzzy.closest(pages.select(F.col("last").alias("text")).filter("text <> ''"), entries)
    return found.select("asked", "place", "text", F.round("score", 6).alias("score"))


def possible_alias(spark: SparkSession, folder: str) -> DataFrame:
    return signals.possible_aliases(views.user_profile(spark, folder))


def live_tables(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Nested ticketing records of a second source, parsed, matched and shaped like the first:
    its shows, its bills and the signals its acts are found in. Lines and bills are read by several
    branches, so they are worked out once."""
    lines = staged(event_lines(spark, folder))
    events = landing.bookable(landing.parse_events(lines))
    bill = staged(landing.parse_bills(lines))
    order = [F.col("event_id").cast("bigint").desc(), F.col("billing_order").desc()]
    # Promoted parts are tracked under a name key, so only their name can match.
    tracked = views.table(spark, folder, "part").select(
        F.when(F.col("p_type") == "PROMO", F.concat(F.lit("name:part "), "p_partkey"))
        .otherwise(F.concat(F.lit("mbid:P"), "p_partkey"))
        .alias("artist_key"),
        F.concat(F.lit("Part "), "p_partkey").alias("name"),
    )
    acts = resolve.performers_of(bill, order).withColumn("performer_mbid", F.col("attraction_id"))
    found = resolve.match_performers(acts, resolve.pool_as_artists(tracked))
    tracked_signals = views.catalog_signals(spark, folder).withColumn(
        "artist_key", F.concat(F.lit("mbid:P"), F.substring("artist_key", 7, 20))
    )
    listed = shows.live_shows(events, bill, resolve.trusted_bill(bill, found), tracked_signals)
    return listed, bill, tracked_signals


def live_source(spark: SparkSession, folder: str) -> DataFrame:
    return live_tables(spark, folder)[0].select(
        F.col("event_id").cast("bigint").alias("event_id"),
        "event_date",
        "city",
        "min_price",
        "artist_key",
        "artist_name",
        "is_headliner",
    )


def live_search(spark: SparkSession, folder: str) -> DataFrame:
    """The same show search, run over the second source."""
    listed, bill, tracked_signals = live_tables(spark, folder)
    out = shows.show_search(  # it reads the shows for the page and for its counts
        staged(listed), bill, tracked_signals, today(), max_price=20.0, days_ahead=45, limit=50
    )
    return joined(out, "lineup")


# --- taste ---------------------------------------------------------------------------------


def built(spark: SparkSession, folder: str) -> taste.Taste:
    return taste.Taste.build(
        views.listening(spark, folder),
        views.tracked_signals(spark, folder),
        views.similar_edges(spark, folder),
    )


def plays_of(spark: SparkSession, folder: str) -> DataFrame:
    return taste.listed_plays(
        views.listening(spark, folder), views.tracked_signals(spark, folder)
    )


def seeds_of(spark: SparkSession, folder: str) -> DataFrame:
    return staged(taste.user_seeds(plays_of(spark, folder)))


def user_seeds(spark: SparkSession, folder: str) -> DataFrame:
    return taste.user_seeds(plays_of(spark, folder)).withColumn("weight", F.round("weight", 9))


def user_library(spark: SparkSession, folder: str) -> DataFrame:
    return taste.user_library(plays_of(spark, folder)).withColumn(
        "familiarity", F.round("familiarity", 9)
    )


def user_tags(spark: SparkSession, folder: str) -> DataFrame:
    # Read once, so not written: only the columns that tags need travel.
    seeds = taste.user_seeds(plays_of(spark, folder))
    return taste.user_tags(seeds, views.tracked_signals(spark, folder)).withColumn(
        "weight", F.round("weight", 9)
    )


def similar_scores(spark: SparkSession, folder: str) -> DataFrame:
    seeds = seeds_of(spark, folder)
    links = staged(taste.two_way_links(
        views.similar_edges(spark, folder), views.tracked_signals(spark, folder)
    ))
    return taste.similar_scores(seeds, links).withColumn("sim", F.round("sim", 9))


def affinity(spark: SparkSession, folder: str) -> DataFrame:
    """Every user with every entity they play or are linked to."""
    return built(spark, folder).known_pairs().select("user", "artist_key", "plays", "affinity")


def taste_profile(spark: SparkSession, folder: str) -> DataFrame:
    out = taste.taste_profile(built(spark, folder))
    top = F.transform(
        "top_artists", lambda a: F.concat_ws("=", a["name"], a["plays"].cast("string"), a["size_band"])
    )
    breaking = F.transform(
        "your_artists_breaking", lambda a: F.concat_ws("=", a["artist_key"], a["rank_score"].cast("string"))
    )
    return (
        out.withColumn("top_artists", F.array_join(top, "|"))
        .withColumn("your_artists_breaking", F.array_join(breaking, "|"))
        .withColumn("top_tags", F.array_join("top_tags", "|"))
    )


def discover(spark: SparkSession, folder: str) -> DataFrame:
    return taste.discover(built(spark, folder))


def user_shows(spark: SparkSession, folder: str, who: str, cheap: bool) -> DataFrame:
    scored = views.tracked_signals(spark, folder)
    matching = shows.matching_shows(
        shows_table(spark, folder), scored, today(), max_price=40.0, days_ahead=90
    )
    return taste.shows_for_users(
        built(spark, folder), matching, views.order_bills(spark, folder), who, cheap
    ).drop("headliner", "lineup_size", "score_parts")


def shows_for_users(spark: SparkSession, folder: str) -> DataFrame:
    return user_shows(spark, folder, "any", False)


def shows_mine_cheap(spark: SparkSession, folder: str) -> DataFrame:
    return user_shows(spark, folder, "mine", True)


def shows_new(spark: SparkSession, folder: str) -> DataFrame:
    return user_shows(spark, folder, "new", False)


# --- pool ----------------------------------------------------------------------------------


def pool_day() -> Column:
    return F.lit("2001-05-15").cast("date")


def pool_seeds(spark: SparkSession, folder: str) -> DataFrame:
    return latest.first_source_wins(views.pool_seeds(spark, folder), "artist_key")


def neighbour_votes(spark: SparkSession, folder: str) -> DataFrame:
    return pool.neighbour_votes(
        views.similar_edges(spark, folder), pool_seeds(spark, folder)
    )


def pool_merge(spark: SparkSession, folder: str) -> DataFrame:
    parts = views.table(spark, folder, "part").select(
        F.concat(F.lit("mbid:p"), "p_partkey").alias("artist_key"),
        F.concat_ws(" ", "p_name", "p_brand").alias("name"),
        F.concat(F.lit("p"), "p_partkey").alias("mbid"),
        F.lit("similar:x").alias("source"),
        F.col("p_partkey").alias("position"),
    )
    neighbours = parts.join(neighbour_votes(spark, folder), "artist_key")
    return pool.merge_pool(
        views.pool_members(spark, folder),
        pool_seeds(spark, folder),
        neighbours,
        pool_day(),
        max_size=700,
        seed_share=0.4,
    )


def pool_event_append(spark: SparkSession, folder: str) -> DataFrame:
    lines = staged(event_lines(spark, folder))  # events and bills are both read from them
    events = landing.parse_events(lines).withColumn("event_id", F.col("event_id").cast("bigint"))
    bill = landing.parse_bills(lines).withColumn("event_id", F.col("event_id").cast("bigint"))
    bill = bill.withColumn("performer_mbid", F.col("attraction_id"))
    return pool.add_event_performers(
        views.pool_members(spark, folder), pool.billed_performers(bill, events), pool_day(), cap=500
    )


def pool_stale(spark: SparkSession, folder: str) -> DataFrame:
    return pool.pool_is_stale(views.pool_members(spark, folder), pool_day())


# --- briefs --------------------------------------------------------------------------------


def brief_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Each entity's bio is the document with its number, whole."""
    docs = views.table(spark, folder, "documents").select(
        F.concat(F.lit("mbid:p"), "doc_id").alias("artist_key"),
        F.col("text").alias("bio_summary"),
        F.array("lang", "source").alias("similar_names"),
    )
    return docs


def facts(spark: SparkSession, folder: str, **options) -> DataFrame:
    ranked = with_ranks(
        views.catalog_signals(spark, folder), "breakout_score", "breakout_rank", "percentile"
    )
    signals = ranked.withColumns(
        {
            "new_listeners_7d": F.expr("lastfm_listeners div 50"),
            "plays_7d_growth_pct": F.col("listeners_14d_growth_pct") - 20,
        }
    )
    return briefs.brief_facts(
        signals, brief_profile(spark, folder), shows_table(spark, folder), **options
    )


def brief_facts(spark: SparkSession, folder: str) -> DataFrame:
    dated = F.transform(
        "shows", lambda s: F.concat(s["event_date"].cast("string"), F.lit(" "), s["event_id"])
    )
    return facts(spark, folder, first_shows=5).select(
        "artist_key", "name", "breakout_score", "breakout_rank", "bio_summary",
        F.array_join(dated, "|").alias("shows"), "n_shows",
    )


def brief_prompts(spark: SparkSession, folder: str) -> DataFrame:
    return briefs.prompts(facts(spark, folder), instructions="Write a brief.")


def parsed_briefs(spark: SparkSession, folder: str) -> DataFrame:
    return briefs.parse_briefs(views.brief_responses(spark, folder), "v2")


def text_sections(spark: SparkSession, folder: str) -> DataFrame:
    return parsed_briefs(spark, folder)


def brief_retry_merge(spark: SparkSession, folder: str) -> DataFrame:
    raw = views.brief_responses(spark, folder)
    again = raw.select(
        "artist_key",
        F.struct(
            F.concat(F.lit("### Signing status\nSecond "), "name").alias("result"),
            F.lit(None).cast("string").alias("errorMessage"),
        ).alias("response"),
        F.lit("small").alias("model"),
        F.lit("2001-05-16 00:00:00").cast("timestamp_ntz").alias("generated_at"),
    )
    return briefs.parse_briefs(briefs.merge_retries(raw, again), "v2")


def export_briefs(spark: SparkSession, folder: str) -> DataFrame:
    dated = parsed_briefs(spark, folder).withColumn("as_of_date", pool_day())
    return export.prepare("scout_briefs", dated)


def failed_briefs(spark: SparkSession, folder: str) -> DataFrame:
    return briefs.failed_briefs(parsed_briefs(spark, folder))


def brief_labels(spark: SparkSession, folder: str) -> DataFrame:
    return briefs.label_briefs(parsed_briefs(spark, folder), views.catalog_signals(spark, folder))


def entity_brief(spark: SparkSession, folder: str) -> DataFrame:
    named = views.catalog_signals(spark, folder).withColumn("name", F.substring_index("name", " ", 2))
    return briefs.entity_brief(named, parsed_briefs(spark, folder), "SMALL ring")


QUERIES = {
    "normalize_names": normalize_names,
    "entity_keys": entity_keys,
    "ascii_clean": ascii_clean,
    "html_anchor_strip": html_anchor_strip,
    "word_truncate": word_truncate,
    "fuzzy_candidates": fuzzy_candidates,
    "entity_match": entity_match,
    "match_counts": match_counts,
    "match_review": match_review,
    "fuzzy_lookup": fuzzy_lookup,
    "closest_words": closest_words,
    "possible_alias": possible_alias,
    "live_source": live_source,
    "live_search": live_search,
    "user_seeds": user_seeds,
    "user_library": user_library,
    "user_tags": user_tags,
    "similar_scores": similar_scores,
    "affinity": affinity,
    "taste_profile": taste_profile,
    "discover": discover,
    "shows_for_users": shows_for_users,
    "shows_mine_cheap": shows_mine_cheap,
    "shows_new": shows_new,
    "neighbour_votes": neighbour_votes,
    "pool_seeds": pool_seeds,
    "pool_merge": pool_merge,
    "pool_event_append": pool_event_append,
    "pool_stale": pool_stale,
    "brief_facts": brief_facts,
    "brief_prompts": brief_prompts,
    "text_sections": text_sections,
    "brief_retry_merge": brief_retry_merge,
    "export_briefs": export_briefs,
    "failed_briefs": failed_briefs,
    "brief_labels": brief_labels,
    "entity_brief": entity_brief,
}
