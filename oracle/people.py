"""Names, matching, taste, pool and briefs."""

from __future__ import annotations

from oracle import serving  # noqa: F401  (defines shows and bill_lists)
from oracle.base import define, query


def fold(x: str) -> str:
    return f"replace(strip_accents(lower({x})), 'ß', 'ss')"


def form(x: str) -> str:
    words = (
        f"trim(regexp_replace(regexp_replace(replace({fold(x)}, '&', ' and '), "
        r"'[^\p{L}\p{N}_\s]', ' ', 'g'), '\s+', ' ', 'g'))"
    )
    return f"coalesce(nullif(trim(regexp_replace({words}, '^the ', '')), ''), {words})"


def tokens(x: str) -> str:
    return f"array_to_string(list_sort(string_split({x}, ' ')), ' ')"


def lcs(a: str, b: str) -> str:
    """Longest common subsequence: one row of counts per character of ``b``."""
    return f"""list_last(list_reduce(
      list_transform(string_split({b}, ''), lambda ch: [unicode(ch)]),
      lambda prev, cur: list_reduce(
        list_transform(range(1, length({a}) + 1), lambda j: [j]),
        lambda acc, j: list_append(acc,
          CASE WHEN unicode(substr({a}, CAST(j[1] AS BIGINT), 1)) = cur[1] THEN prev[j[1]] + 1
               ELSE greatest(prev[j[1] + 1], list_last(acc)) END),
        [0::BIGINT]),
      list_resize([0::BIGINT], length({a}) + 1, 0::BIGINT)))"""


def alike(a: str, b: str) -> str:
    return f"(200.0::DOUBLE * {lcs(a, b)} / (length({a}) + length({b})))"


TRIBUTE = (
    r"(?i)\b(tribute|salute to|the music of|celebrating the music|songs of|a night of)\b"
)

define("titles", "SELECT page_id, url, regexp_extract(html, '<title>(.*?)</title>', 1) AS title FROM pages")
define(
    "billed",
    f"""
  SELECT *, {form("performer_name")} AS form FROM (
    SELECT page_id, 'a' || page_id AS attraction_id,
      CASE WHEN contains(url, 'utm_source') THEN regexp_replace(title, '^(.*?)e', '\\1')
           WHEN contains(url, '?page') THEN 'The ' || title
           WHEN url LIKE '%/' THEN title || ' Tribute'
           WHEN url LIKE '%.html' THEN translate(title, 'or', '')
           WHEN contains(url, '#top')
             THEN array_to_string(list_reverse(string_split(title, ' ')), ' ')
           ELSE title END AS performer_name,
      CASE WHEN contains(url, '://blog.') THEN 'T' || page_id END AS performer_mbid
    FROM titles)""",
    ["titles"],
)
define(
    "tracked_names",
    f"""
  SELECT *, {form("name")} AS form FROM (
    SELECT 'art:' || page_id AS artist_key, regexp_replace(title, '[*#%$]', '', 'g') AS name,
           't' || page_id AS mbid FROM titles)""",
    ["titles"],
)
define(
    "close_pairs",
    f"""
  SELECT left_text, right_text
  FROM (SELECT DISTINCT {tokens("form")} AS left_text FROM billed),
       (SELECT DISTINCT {tokens("form")} AS right_text FROM tracked_names)
  WHERE levenshtein(left_text, right_text)
        <= floor(0.15 * (length(left_text) + length(right_text)) + 1e-9)""",
    ["billed", "tracked_names"],
)
define(
    "alike_pairs",
    f"""
  SELECT * FROM (SELECT left_text, right_text, {alike("left_text", "right_text")} AS score
                 FROM close_pairs) WHERE score >= 85""",
    ["close_pairs"],
)
define(
    "by_form",
    "SELECT form, min(artist_key) AS artist_key, arg_min(name, artist_key) AS artist_name "
    "FROM tracked_names GROUP BY 1",
    ["tracked_names"],
)
define(
    "matches",
    f"""
  SELECT attraction_id, performer_name,
    CASE WHEN tribute THEN NULL ELSE coalesce(id_key, name_key, similar_key) END AS artist_key,
    CASE WHEN tribute THEN NULL WHEN id_key IS NOT NULL THEN id_name
         ELSE coalesce(name_name, similar_name) END AS artist_name,
    CASE WHEN tribute THEN 0.0 WHEN id_key IS NOT NULL OR name_key IS NOT NULL THEN 100.0
         ELSE round(coalesce(score, 0.0), 6) END::DOUBLE AS match_score,
    CASE WHEN tribute THEN 'tribute' WHEN id_key IS NOT NULL THEN 'mbid'
         WHEN name_key IS NOT NULL THEN 'exact' WHEN score IS NULL THEN 'none'
         WHEN score >= 95 AND length(form) >= 5 THEN 'fuzzy' ELSE 'review' END AS match_method
  FROM (
    SELECT b.*, regexp_matches(performer_name, '{TRIBUTE}') AS tribute,
      t.artist_key AS id_key, t.name AS id_name, f.artist_key AS name_key,
      f.artist_name AS name_name, s.score, s.artist_key AS similar_key,
      s.artist_name AS similar_name
    FROM billed b
    LEFT JOIN tracked_names t ON lower(b.performer_mbid) = lower(t.mbid)
    LEFT JOIN by_form f ON f.form = b.form
    LEFT JOIN (
      SELECT left_text, score, artist_key, artist_name
      FROM alike_pairs JOIN (SELECT {tokens("form")} AS right_text, min(artist_key) AS artist_key,
                               arg_min(artist_name, artist_key) AS artist_name
                             FROM by_form GROUP BY 1) USING (right_text)
      QUALIFY row_number() OVER (PARTITION BY left_text ORDER BY score DESC, artist_key) = 1) s
      ON s.left_text = {tokens("b.form")})""",
    ["billed", "tracked_names", "by_form", "alike_pairs"],
)

ASKED = [
    "Small Ring", "smal ring", "the red widget", "rd widgt", "blue  bolt!", "bolt blue",
    "hot gaer", "large plates", "old", "xylophone",
]
define(
    "asked",
    f"SELECT query, {form('query')} AS query_form FROM (VALUES "
    + ", ".join(f"('{q}')" for q in ASKED)
    + ") v(query)",
)
define(
    "lookup_near",
    f"""
  SELECT query, query_form, list({{'score': score, 'form': form, 'artist_key': artist_key, 'name': name}}
                     ORDER BY score DESC, form) AS near
  FROM (SELECT *, {alike("a", "b")} AS score FROM (
          SELECT query, query_form, form, artist_key, name, {tokens("query_form")} AS a,
                 {tokens("form")} AS b
          FROM asked, (
            SELECT lower(p_name) AS form, p_name AS name, 'mbid:p' || p_partkey AS artist_key
            FROM part QUALIFY row_number() OVER (PARTITION BY lower(p_name)
              ORDER BY p_brand = 'Brand#13', p_size DESC, 'mbid:p' || p_partkey) = 1))
        QUALIFY row_number() OVER (PARTITION BY query ORDER BY score DESC, form) <= 4)
  GROUP BY ALL""",
    ["asked"],
)

# --- taste ---------------------------------------------------------------------------------

define(
    "tracked",
    """
  SELECT s.* EXCLUDE (tags),
    [string_split(p_name, ' ')[1] || ' ' || p_brand, 'Seen Live',
     string_split(p_name, ' ')[2] || ' ' || p_size, p_type || ' ' || p_brand] AS tags,
    [lower(string_split(p_name, ' ')[1] || ' ' || p_brand),
     lower(string_split(p_name, ' ')[2] || ' ' || p_size), lower(p_type || ' ' || p_brand)] AS kept
  FROM signals s JOIN part ON 'mbid:p' || p_partkey = artist_key WHERE p_type <> 'MEDIUM'""",
    ["signals"],
)
define(
    "entity_tags",
    """SELECT artist_key, tag, sum(1.0::DOUBLE / pos) AS w
       FROM (SELECT artist_key, unnest(kept) AS tag, generate_subscripts(kept, 1) AS pos FROM tracked)
       GROUP BY 1, 2""",
    ["tracked"],
)
define(
    "plays",
    """
  SELECT l.user, l.period, l.name, l.mbid, l.playcount,
    coalesce('mbid:' || lower(l.mbid), 'name:' || lower(l.name)) AS own_key,
    coalesce(k.artist_key, n.artist_key) AS artist_key
  FROM listening l
  LEFT JOIN tracked k ON k.artist_key = 'mbid:' || lower(l.mbid)
  LEFT JOIN (SELECT lower(name) AS lname, artist_key FROM tracked
             QUALIFY row_number() OVER (PARTITION BY lower(name) ORDER BY possible_alias_of
               NULLS FIRST, lastfm_listeners DESC, artist_key) = 1) n ON n.lname = lower(l.name)""",
    ["listening", "tracked"],
)
define(
    "seeds",
    """
  SELECT "user", place, lname, kept.name AS name, kept.artist_key AS artist_key,
         kept.own_key AS own_key, plays, raw / sum(raw) OVER (PARTITION BY "user") AS weight
  FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY "user" ORDER BY round(raw, 9) DESC, lname)
                   AS INTEGER) AS place
    FROM (
      SELECT "user", lower(name) AS lname, sum(ln(1 + playcount)) AS raw,
        coalesce(min(playcount) FILTER (period = 'overall'), 0) AS plays,
        list({'name': name, 'artist_key': artist_key, 'own_key': own_key}
             ORDER BY period <> 'overall', playcount DESC, name, mbid NULLS FIRST)[1] AS kept
      FROM plays GROUP BY "user", lower(name))
    QUALIFY place <= 50)""",
    ["plays"],
)
define(
    "library",
    """
  SELECT "user", artist_key, playcount AS plays,
    ln(1 + playcount) / ln(1 + max(playcount) OVER (PARTITION BY "user")) AS familiarity
  FROM (SELECT * FROM plays WHERE artist_key IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY "user", artist_key
          ORDER BY period <> 'overall', playcount DESC) = 1)""",
    ["plays"],
)
define(
    "utags",
    """SELECT "user", tag, sum(weight * w) AS weight FROM seeds JOIN entity_tags USING (artist_key)
       GROUP BY ALL""",
    ["seeds", "entity_tags"],
)
define(
    "links",
    """
  SELECT s.user, candidate, s.name, max(s.weight * match) AS part
  FROM (SELECT "user", artist_key AS seed_key, name, weight, true AS owned FROM seeds
        WHERE artist_key IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY "user", artist_key ORDER BY place DESC) = 1
        UNION ALL
        SELECT "user", own_key, name, weight, false FROM seeds WHERE artist_key IS NULL) s
  JOIN (SELECT from_key AS seed_key, to_key AS candidate, match, true AS outward FROM edges
        UNION ALL SELECT to_key, from_key, match, false FROM edges) e
    ON e.seed_key = s.seed_key AND (owned OR outward)
  WHERE candidate IN (SELECT artist_key FROM tracked)
    AND NOT EXISTS (SELECT 1 FROM seeds o WHERE o.user = s.user AND o.artist_key = candidate)
  GROUP BY ALL""",
    ["seeds", "edges", "tracked"],
)
define(
    "sims",
    """
  SELECT "user", candidate AS artist_key, total / max(total) OVER (PARTITION BY "user") AS sim,
         through
  FROM (SELECT "user", candidate, sum(part) AS total,
               list(name ORDER BY round(part, 9) DESC, name)[1:2] AS through
        FROM links GROUP BY ALL)""",
    ["links"],
)
define(
    "cosines",
    """
  SELECT u.user, e.artist_key, sum(u.weight * e.w) / any_value(un.norm) / any_value(en.norm) AS cosine,
    list(u.tag ORDER BY round(u.weight, 9) DESC, u.tag)[1:3] AS shared
  FROM utags u JOIN entity_tags e USING (tag)
  JOIN (SELECT "user", sqrt(sum(weight * weight)) AS norm FROM utags GROUP BY 1) un ON un.user = u.user
  JOIN (SELECT artist_key, sqrt(sum(w * w)) AS norm FROM entity_tags GROUP BY 1) en
    ON en.artist_key = e.artist_key
  GROUP BY u.user, e.artist_key""",
    ["utags", "entity_tags"],
)


def scored_pairs(source: str) -> str:
    """Affinity and reason for the (user, artist_key) rows of ``source``."""
    return f"""
  SELECT p.user, p.artist_key, coalesce(l.plays, 0) AS plays,
    coalesce(l.familiarity, 0.0) AS familiarity,
    round_even(round(round(CASE WHEN h.user IS NULL THEN coalesce(c.cosine, 0)
               ELSE 0.7 * coalesce(s.sim, 0) + 0.3 * coalesce(c.cosine, 0) END, 9) * 1000, 6), 0) / 1000 AS affinity,
    concat_ws('; ',
      CASE WHEN l.plays > 0 THEN 'you''ve played them ' || l.plays
        || CASE WHEN l.plays = 1 THEN ' time' ELSE ' times' END END,
      'similar to ' || array_to_string(s.through, ', '),
      'shares ' || array_to_string(c.shared, ', ')) AS because
  FROM ({source}) p
  LEFT JOIN library l ON l.user = p.user AND l.artist_key = p.artist_key
  LEFT JOIN sims s ON s.user = p.user AND s.artist_key = p.artist_key
  LEFT JOIN cosines c ON c.user = p.user AND c.artist_key = p.artist_key
  LEFT JOIN (SELECT DISTINCT "user" FROM sims) h ON h.user = p.user"""


define(
    "known",
    scored_pairs(
        'SELECT "user", artist_key FROM library UNION SELECT "user", artist_key FROM sims'
    ),
    ["library", "sims", "cosines"],
)
define(
    "found",
    scored_pairs(
        """SELECT "user", artist_key FROM library UNION SELECT "user", artist_key FROM sims
           UNION SELECT "user", artist_key FROM cosines"""
    ),
    ["library", "sims", "cosines"],
)
define(
    "breaking",
    """
  SELECT l.user, l.artist_key, round_even(round(round(breakout_score / 100
      * greatest(0, least(1, ln(1000000 / lastfm_listeners) / ln(100)))
      * (0.25 + 0.75 * familiarity), 9) * 1000, 6), 0) / 1000 AS rank_score
  FROM library l JOIN tracked t USING (artist_key)
  WHERE breakout_score >= 70 AND possible_alias_of IS NULL""",
    ["library", "tracked"],
)

PARTS = {
    "familiarity": "k.familiarity",
    "novelty": "(1 - k.familiarity)",
    "match": "k.affinity",
    "connection": "greatest(k.familiarity, k.affinity)",
    "breakout": "(coalesce(s.breakout_score, 0) / 100)",
    "emerging": "(CASE WHEN s.size_band IN ('<10k', '10k-50k', '50k-500k') THEN 1.0 ELSE 0.0 END)",
    "cheap": "(CASE WHEN s.min_price <> 0 THEN greatest(0.0, 1.0 - s.min_price / 100) ELSE 0.0 END)",
}


def user_shows(weights: dict[str, float]) -> str:
    score = "0.0::DOUBLE" + "".join(f" + {PARTS[p]} * {w}::DOUBLE" for p, w in weights.items())
    return query(
        ["known", "shows", "bill_lists"],
        f"""
      SELECT * EXCLUDE (is_headliner, because, bill),
        CASE WHEN is_headliner THEN 'headliner' ELSE 'support' END AS role,
        concat_ws('; ', CASE WHEN NOT is_headliner THEN 'opening for ' || bill[1] END,
                  nullif(because, '')) AS why
      FROM (
        SELECT k.user, s.event_id, s.event_date, s.artist_key, s.artist_name, s.city,
          s.is_headliner, s.min_price, k.plays, k.affinity, k.because,
          round_even(round(round(({score}) * CASE WHEN s.is_headliner THEN 1.0 ELSE 0.8 END, 9) * 1000, 6), 0) / 1000 AS rank_score,
          count(*) OVER (PARTITION BY k.user) AS total_matches,
          count(s.min_price) OVER (PARTITION BY k.user) AS priced_matches,
          CAST(row_number() OVER (PARTITION BY k.user ORDER BY rank_score DESC, s.event_date,
            s.event_id, s.artist_key) AS INTEGER) AS place
        FROM known k JOIN shows s USING (artist_key)
        WHERE s.event_date BETWEEN DATE '2001-05-20' AND DATE '2001-05-20' + 90
          AND (s.min_price <= 40 OR s.min_price IS NULL))
      LEFT JOIN bill_lists USING (event_id)
      WHERE place <= 10""",
    )


# --- pool ----------------------------------------------------------------------------------

POOL_PART = "'mbid:p' || p_partkey AS artist_key, p_name || ' ' || p_brand AS name, 'p' || p_partkey AS mbid"
define(
    "members",
    f"""
  SELECT {POOL_PART}, CASE WHEN p_size > 40 THEN 'geo:Canada' WHEN p_size > 30
           THEN 'event:Toronto' ELSE 'similar:x' END AS source,
         DATE '2001-05-01' AS added_date, DATE '2001-05-01' AS pool_date
  FROM part WHERE p_type = 'ECONOMY'""",
)
define(
    "seed_entries",
    f"""
  SELECT {POOL_PART}, p_partkey AS position,
         CASE WHEN p_size > 35 THEN 'geo:Brazil' ELSE 'tag:rock' END AS source
  FROM part WHERE p_size > 35 OR p_type IN ('PROMO', 'SMALL')""",
)
define(
    "votes",
    """SELECT to_key AS artist_key, count(*) AS votes FROM edges
       WHERE to_key NOT IN (SELECT artist_key FROM seed_entries) GROUP BY 1""",
    ["edges", "seed_entries"],
)
define(
    "fresh",
    f"""
  SELECT *, row_number() OVER (ORDER BY tier, votes DESC, position, artist_key) AS place
  FROM (
    SELECT * FROM (
      SELECT *, 0 AS votes, CASE WHEN row_number() OVER (ORDER BY position, artist_key) <=
          greatest(280 - (SELECT count(*) FROM members WHERE source LIKE 'geo:%'), 0)
          THEN 0 ELSE 2 END AS tier
      FROM (SELECT artist_key, name, mbid, source, position FROM seed_entries
            WHERE artist_key NOT IN (SELECT artist_key FROM members))
      UNION ALL
      SELECT artist_key, name, mbid, 'similar:x', position, votes, 1
      FROM votes JOIN (SELECT {POOL_PART}, p_partkey AS position FROM part) USING (artist_key)
      WHERE artist_key NOT IN (SELECT artist_key FROM members))
    QUALIFY row_number() OVER (PARTITION BY lower(name)
      ORDER BY tier, votes DESC, position, artist_key) = 1)
  WHERE lower(name) NOT IN (SELECT lower(name) FROM members)""",
    ["members", "seed_entries", "votes"],
)

# --- briefs --------------------------------------------------------------------------------

define(
    "responses",
    """
  SELECT 'mbid:p' || conv_id || CASE WHEN turn > 0 THEN ':' || turn ELSE '' END AS artist_key, coalesce(p_name, 'Talk ' || conv_id) AS name,
    CASE WHEN length(text) >= 120 THEN '### Who they are' || chr(10) || text || chr(10)
        || '### Signing status' || chr(10)
        || CASE p_type WHEN 'PROMO' THEN 'No label mentioned in the Last.fm bio (not confirmed).'
             WHEN 'SMALL' THEN '  ' ELSE 'Signed to ' || coalesce(p_name, 'Talk ' || conv_id) || ' – Records' END
        || CASE WHEN p_type = 'LARGE' THEN '' ELSE chr(10) || '### Where' || chr(10) || 'Charts.' END
      WHEN length(text) >= 60 THEN '  ' END AS result,
    CASE WHEN length(text) < 60 THEN 'too short' END AS error_message,
    'large' AS model, TIMESTAMP '2001-05-15' AS generated_at
  FROM conversations LEFT JOIN (
    SELECT p_partkey AS conv_id, p_type, p_name FROM part) p USING (conv_id)""",
)


def parsed(source: str) -> str:
    clean = (
        f"regexp_replace(regexp_replace(result, '[\\x{{2010}}-\\x{{2015}}]', '-', 'g'), "
        f"'[\\x{{00A0}}\\x{{202F}}\\x{{2009}}]', ' ', 'g')"
    )
    return f"""
  SELECT *, CASE WHEN signing_status IS NOT NULL THEN
      NOT starts_with(signing_status, 'No label mentioned in the Last.fm bio') END AS label_mentioned
  FROM (
    SELECT artist_key, name, model, generated_at, 'v2' AS prompt_version,
      CASE WHEN NOT blank THEN trim({clean}) END AS brief_md,
      CASE WHEN blank THEN coalesce(error_message, 'empty response') END AS error,
      nullif(trim(regexp_extract(CASE WHEN NOT blank THEN trim({clean}) END,
        '(?s)### Signing status\\s*(.*?)\\s*(###|$)', 1)), '') AS signing_status
    FROM (SELECT *, coalesce(trim(result), '') = '' AS blank FROM {source}))"""


define("briefs", parsed("responses"), ["responses"])
define(
    "retried",
    """
  SELECT artist_key, name,
    CASE WHEN blank THEN '### Signing status' || chr(10) || 'Second ' || name ELSE result END AS result,
    CASE WHEN NOT blank THEN error_message END AS error_message,
    CASE WHEN blank THEN 'small' ELSE model END AS model,
    CASE WHEN blank THEN TIMESTAMP '2001-05-16' ELSE generated_at END AS generated_at
  FROM (SELECT *, coalesce(trim(result), '') = '' AS blank FROM responses)""",
    ["responses"],
)
define(
    "facts",
    """
  SELECT s.*, d.text AS bio_summary, [d.lang, d.source] AS similar_names, d.doc_id
  FROM (SELECT *, lastfm_listeners // 50 AS new_listeners_7d,
          listeners_14d_growth_pct - 20 AS plays_7d_growth_pct
        FROM (SELECT *, CAST(rank() OVER (ORDER BY breakout_score DESC NULLS LAST) AS INTEGER) AS breakout_rank FROM signals)
        WHERE breakout_score IS NOT NULL AND possible_alias_of IS NULL
          AND size_band <> '2M+' ORDER BY breakout_score DESC, artist_key LIMIT 50) s
  LEFT JOIN documents d ON 'mbid:p' || doc_id = artist_key""",
    ["signals"],
)

define(
    "live_rows",
    """
  SELECT CAST(e.event_id AS VARCHAR) AS event_id, e.event_name, e.event_date, e.local_time,
    e.status, CASE WHEN e.tm_genre <> '2-HIGH' THEN e.venue ELSE '1 Main St' END AS venue, e.city,
    e.min_price, e.max_price, e.currency, CAST(NULL AS VARCHAR) AS ticket_url,
    coalesce(s.key, 'name:part ' || p_partkey) AS artist_key,
    coalesce(s.name, performer_name) AS artist_name, b.billing_order = 0 AS is_headliner,
    s.breakout_score, s.size_band, s.lastfm_listeners, s.genres, s.listeners_7d_growth_pct
  FROM show_events e JOIN bills b USING (event_id) JOIN part ON attraction_id = 'p' || p_partkey
  LEFT JOIN (SELECT *, 'mbid:P' || artist_key[7:] AS key FROM signals) s
    ON s.artist_key = 'mbid:p' || p_partkey AND p_type <> 'PROMO'
  WHERE e.status <> 'canceled' AND e.tm_genre <> '5-LOW'""",
    ["show_events", "bills", "signals"],
)
define(
    "live_bills",
    """
  SELECT CAST(event_id AS VARCHAR) AS event_id, list(performer_name ORDER BY billing_order) AS bill
  FROM bills GROUP BY 1""",
    ["bills"],
)
define(
    "show_lists",
    """
  SELECT *, row_number() OVER (PARTITION BY artist_key ORDER BY event_date, event_id) AS place,
    count(*) OVER (PARTITION BY artist_key) AS n FROM shows""",
    ["shows"],
)

BIO = r"regexp_replace(coalesce(bio_summary, ''), '^\s+|\s+$', '', 'g')"
PERCENT = "coalesce(printf('%+.1f%%', round_even(round(round({c}, 9) * 10, 6), 0) / 10), 'n/a')"

ORACLES = {
    "normalize_names": rf"""
      SELECT DISTINCT name, trim(regexp_replace({fold("name")}, '\s+', ' ', 'g')) AS normalized,
        {form("name")} AS match_form, {fold("trim(name)")} AS place,
        regexp_matches(name, '{TRIBUTE}') AS tribute
      FROM (SELECT regexp_extract(html, '<title>(.*?)</title>', 1) AS name FROM pages
            UNION SELECT string_split(text, chr(10))[1] FROM documents)""",
    "entity_keys": """
      SELECT p_partkey, CASE WHEN p_size > 25 THEN 'mbid:p-' || p_partkey
               ELSE 'name:' || lower(p_name) || ' unit' END AS artist_key,
        'user#' || sha256(lower(p_brand))[1:8] AS pseudonym, true AS valid, false AS invalid
      FROM part""",
    "ascii_clean": r"""
      SELECT doc_id, md5(regexp_replace(regexp_replace(text, '[\x{2010}-\x{2015}]', '-', 'g'),
        '[\x{00A0}\x{202F}\x{2009}]', ' ', 'g')) AS clean FROM documents""",
    "html_anchor_strip": r"""
      SELECT page_id, md5(trim(regexp_replace(html, '<a href=.*?</a>\.?', '', 'g'))) AS stripped
      FROM pages""",
    "word_truncate": """
      SELECT doc_id, CASE WHEN length(text) > 900 THEN
        regexp_replace(substr(text, 1, 900), '(?s) [^ ]*$', '') || '...' ELSE text END AS shortened
      FROM documents""",
    "fuzzy_candidates": query(
        ["alike_pairs"], "SELECT left_text, right_text, round(score, 6) AS score FROM alike_pairs"
    ),
    "entity_match": query(["matches"], "SELECT * FROM matches"),
    "match_counts": query(
        ["matches"], "SELECT match_method, count(*) AS performers FROM matches GROUP BY 1"
    ),
    "match_review": query(
        ["matches"],
        """SELECT m.*, page_id AS event_id, url AS event_name, DATE '2001-06-01' AS event_date,
             'web' AS venue
           FROM matches m JOIN pages ON 'a' || page_id = attraction_id
           WHERE match_method = 'review'""",
    ),
    "fuzzy_lookup": query(
        ["lookup_near"],
        """
      SELECT query, method IS NOT NULL AS matched, method,
        CASE method WHEN 'fuzzy' THEN round(near[1].score, 1) END AS score,
        CASE method WHEN 'exact' THEN hit.artist_key WHEN 'fuzzy' THEN near[1].artist_key END
          AS artist_key,
        CASE method WHEN 'exact' THEN hit.name WHEN 'fuzzy' THEN near[1].name END AS name,
        array_to_string(list_transform(
          CASE method WHEN 'fuzzy' THEN others[2:3] ELSE others[1:3] END,
          lambda o: o.name || '=' || round(o.score, 1)), '|') AS alternatives
      FROM (SELECT *, list_filter(near, lambda n: n.form = query_form)[1] AS hit,
                   list_filter(near, lambda n: n.form <> query_form) AS others,
                   CASE WHEN list_contains(list_transform(near, lambda n: n.form), query_form)
                        THEN 'exact'
                        WHEN near[1].score >= 95 AND length(query_form) >= 5
                         AND near[2].score < 95 THEN 'fuzzy' END AS method
            FROM lookup_near)""",
    ),
    "closest_words": query(
        ["titles"],
        f"""
      SELECT asked, CAST(place AS INTEGER) AS place, text, round(score, 6) AS score FROM (
        SELECT asked, text, score, row_number() OVER (PARTITION BY asked ORDER BY score DESC, text) AS place
        FROM (SELECT asked, text, {alike("asked", "text")} AS score
              FROM (SELECT DISTINCT lower(list_last(string_split(title, ' '))) AS asked FROM titles WHERE NOT title LIKE '% ' AND title <> ''),
                   (SELECT DISTINCT lower(string_split(title, ' ')[1]) AS text FROM titles WHERE NOT title LIKE ' %' AND title <> '')))
      WHERE place <= 4""",
    ),
    "possible_alias": query(
        ["user_profile"],
        """SELECT artist_key, alias_name AS possible_alias_of FROM user_profile
           WHERE alias_name IS NOT NULL""",
    ),
    "live_source": query(
        ["show_events", "bills", "signals"],
        """
      SELECT e.event_id, e.event_date, e.city, e.min_price,
        CASE WHEN p_type = 'PROMO' THEN 'name:part ' || p_partkey ELSE 'mbid:P' || p_partkey END
          AS artist_key,
        CASE WHEN p_type = 'PROMO' THEN performer_name ELSE s.name END AS artist_name,
        n = 1 AS is_headliner
      FROM show_events e
      JOIN (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY billing_order) AS n
            FROM bills) b USING (event_id)
      JOIN part ON attraction_id = 'p' || p_partkey
      JOIN signals s ON s.artist_key = 'mbid:p' || p_partkey
      WHERE e.status <> 'canceled' AND e.tm_genre <> '5-LOW'""",
    ),
    "live_search": query(
        ["live_rows", "live_bills"],
        """
      SELECT * EXCLUDE (bill), CASE WHEN is_headliner THEN 'headliner' ELSE 'support' END AS role,
        bill[1] AS headliner, array_to_string(bill[1:6], '|') AS lineup,
        CAST(len(bill) AS INTEGER) AS lineup_size, min_price IS NOT NULL AS price_known
      FROM (SELECT *, count(*) OVER () AS total_matches, count(min_price) OVER () AS priced_matches
            FROM live_rows
            WHERE event_date BETWEEN DATE '2001-05-20' AND DATE '2001-05-20' + 45
              AND (min_price <= 20 OR min_price IS NULL)
            ORDER BY breakout_score DESC NULLS LAST, event_date, event_id, artist_key LIMIT 50)
      LEFT JOIN live_bills USING (event_id)""",
    ),
    "user_seeds": query(["seeds"], "SELECT * REPLACE (round(weight, 9) AS weight) FROM seeds"),
    "user_library": query(
        ["library"], "SELECT * REPLACE (round(familiarity, 9) AS familiarity) FROM library"
    ),
    "user_tags": query(["utags"], "SELECT * REPLACE (round(weight, 9) AS weight) FROM utags"),
    "similar_scores": query(
        ["sims"],
        """SELECT "user", artist_key, round(sim, 9) AS sim FROM sims""",
    ),
    "affinity": query(
        ["known"], 'SELECT "user", artist_key, plays, affinity FROM known'
    ),
    "taste_profile": query(
        ["seeds", "library", "utags", "tracked", "breaking"],
        """
      SELECT s.user, top_artists, coverage, emerging_share, coalesce(top_tags, '') AS top_tags,
        coalesce(library_tracked, 0) AS library_tracked, coalesce(established, 0) AS established,
        your_artists_breaking
      FROM (SELECT s.user,
              string_agg(concat_ws('=', s.name, s.plays, t.size_band), '|' ORDER BY place)
                FILTER (place <= 10) AS top_artists,
              round_even(round(round(count(s.artist_key) / count(*), 9) * 1000, 6), 0) / 1000 AS coverage,
              round_even(round(round(coalesce(sum(weight) FILTER (size_band IN ('<10k', '10k-50k', '50k-500k')), 0)
                / coalesce(sum(weight) FILTER (s.artist_key IS NOT NULL), 1), 9) * 1000, 6), 0) / 1000 AS emerging_share
            FROM seeds s LEFT JOIN tracked t USING (artist_key) GROUP BY s.user) s
      LEFT JOIN (SELECT "user", array_to_string(list(tag ORDER BY round(weight, 9) DESC, tag)[1:10], '|')
                   AS top_tags FROM utags GROUP BY 1) u USING ("user")
      LEFT JOIN (SELECT "user", count(*) AS library_tracked FROM library GROUP BY 1) USING ("user")
      LEFT JOIN (SELECT "user", count(*) FILTER (rank_score <= 0) AS established FROM breaking
                 GROUP BY 1) USING ("user")
      LEFT JOIN (SELECT "user", string_agg(artist_key || '=' || rank_score, '|'
                   ORDER BY rank_score DESC, artist_key) AS your_artists_breaking
                 FROM (SELECT * FROM breaking WHERE rank_score > 0 QUALIFY row_number() OVER
                   (PARTITION BY "user" ORDER BY rank_score DESC, artist_key) <= 20)
                 GROUP BY 1) USING ("user")""",
    ),
    "discover": query(
        ["found", "tracked"],
        """
      SELECT "user", CAST(row_number() OVER (PARTITION BY "user" ORDER BY rank_score DESC,
               breakout_score DESC, lastfm_listeners DESC, artist_key) AS INTEGER) AS place,
        artist_key, name, breakout_score, size_band, lastfm_listeners, affinity, because,
        your_plays, rank_score
      FROM (SELECT f.user, artist_key, t.name, t.breakout_score, t.size_band, t.lastfm_listeners,
              f.affinity, f.because, f.plays AS your_plays,
              f.affinity * t.breakout_score / 100 * (1 - f.familiarity) ** 2 AS r,
              round_even(round(round(r, 9) * 1000, 6), 0) / 1000 AS rank_score
            FROM found f JOIN tracked t USING (artist_key)
            WHERE t.possible_alias_of IS NULL AND t.breakout_score >= 70 AND t.size_band <> '2M+'
              AND r > 0)
      QUALIFY place <= 10""",
    ),
    "shows_for_users": user_shows({"connection": 0.4, "breakout": 0.4, "emerging": 0.2}),
    "shows_mine_cheap": user_shows(
        {"familiarity": 0.3575, "breakout": 0.1625, "emerging": 0.13, "cheap": 0.35}
    ),
    "shows_new": user_shows({"match": 0.35, "novelty": 0.25, "breakout": 0.25, "emerging": 0.15}),
    "neighbour_votes": query(["votes"], "SELECT * FROM votes"),
    "pool_seeds": query(["seed_entries"], "SELECT * FROM seed_entries"),
    "pool_merge": query(
        ["members", "fresh"],
        """SELECT artist_key, name, mbid, source, added_date, DATE '2001-05-15' AS pool_date
           FROM members UNION ALL
           SELECT artist_key, name, mbid, source, DATE '2001-05-15', DATE '2001-05-15' FROM fresh
           WHERE place <= greatest(700 - (SELECT count(*) FROM members), 0)""",
    ),
    "pool_event_append": query(
        ["members", "bills", "show_events"],
        """
      SELECT artist_key, name, mbid, source, added_date, pool_date FROM members UNION ALL
      SELECT artist_key, name, mbid, source, DATE '2001-05-15', DATE '2001-05-15'
      FROM (
        SELECT 'mbid:' || attraction_id AS artist_key, performer_name AS name,
               attraction_id AS mbid, 'event:' || city AS source, event_id,
               row_number() OVER (PARTITION BY event_id ORDER BY billing_order) AS n
        FROM bills JOIN show_events USING (event_id)
        QUALIFY row_number() OVER (PARTITION BY attraction_id ORDER BY event_id, billing_order) = 1)
      WHERE artist_key NOT IN (SELECT artist_key FROM members)
      QUALIFY row_number() OVER (ORDER BY event_id, n, artist_key)
        <= 500 - (SELECT count(*) FROM members WHERE source LIKE 'event:%')""",
    ),
    "pool_stale": "SELECT DATE '2001-05-01' AS built, true AS stale FROM (SELECT count(*) FROM part)",
    "brief_facts": query(
        ["facts", "show_lists"],
        """SELECT f.artist_key, f.name, f.breakout_score, f.breakout_rank, f.bio_summary, h.shows, h.n_shows
           FROM facts f LEFT JOIN (SELECT artist_key, string_agg(event_date || ' ' || event_id, '|'
             ORDER BY event_date, event_id) FILTER (place <= 5) AS shows, max(n) AS n_shows
             FROM show_lists GROUP BY 1) h USING (artist_key)""",
    ),
    "brief_prompts": query(
        ["facts", "show_lists"],
        f"""
      SELECT f.artist_key, f.name, f.as_of_date,
        array_to_string([
          'Write a brief.', 'FACTS', 'Artist: ' || f.name,
          'Listeners: ' || format('{{:,}}', f.lastfm_listeners) || ', size band ' || f.size_band,
          'Score: ' || f.breakout_score || ' of 100, rank ' || f.breakout_rank,
          'Listener growth, 7 days: ' || {PERCENT.format(c="f.listeners_7d_growth_pct")}
            || ', new listeners ' || format('{{:,}}', f.new_listeners_7d) || ', measured over ' || growth_window_days || CASE WHEN f.is_provisional
            THEN ' days (PROVISIONAL: under a week of history)' ELSE ' days' END,
          'Listener growth, 14 days: ' || {PERCENT.format(c="f.listeners_14d_growth_pct")},
          'Play growth, 7 days: ' || {PERCENT.format(c="f.plays_7d_growth_pct")},
          'Charts today: ' || coalesce(nullif(array_to_string(chart_countries, ', '), ''), 'none'),
          'New charts in 14 days: ' || new_country_charts_14d,
          'Tags: ' || array_to_string(tags, ', '),
          'Similar: ' || CASE WHEN doc_id IS NULL THEN 'none listed'
                              ELSE array_to_string(similar_names, ', ') END,
          'Bio: ' || coalesce(nullif(CASE WHEN length({BIO}) > 900 THEN
            regexp_replace(substr({BIO}, 1, 900), '(?s) [^ ]*$', '') || '...' ELSE {BIO} END, ''),
            'none'),
          'Shows:' || chr(10) || coalesce(h.lines, '- none found')], chr(10)) AS prompt
      FROM facts f LEFT JOIN (
        SELECT artist_key, string_agg('- ' || event_date || ': ' || venue || ', ' || city ||
          coalesce(' (from ' || printf('%.0f', round_even(round(min_price, 9), 0)) || ' ' || currency || ')', ''),
          chr(10) ORDER BY event_date, event_id) FILTER (place <= 100) ||
          CASE WHEN max(n) > 100 THEN chr(10) || '- and ' || (max(n) - 100) || ' more' ELSE '' END AS lines
        FROM show_lists GROUP BY 1) h USING (artist_key)""",
    ),
    "text_sections": query(["briefs"], "SELECT * FROM briefs"),
    "brief_retry_merge": query(["retried"], parsed("retried")),
    "export_briefs": query(
        ["briefs"],
        """SELECT artist_key, name, DATE '2001-05-15' AS as_of_date, brief_md, signing_status,
             label_mentioned, model, prompt_version, generated_at FROM briefs WHERE error IS NULL""",
    ),
    "failed_briefs": query(
        ["briefs"], "SELECT count(*) AS briefs, count(error) AS failed FROM briefs"
    ),
    "brief_labels": query(
        ["briefs", "signals"],
        """SELECT b.artist_key, b.name, b.signing_status, s.size_band, s.breakout_score
           FROM briefs b JOIN signals s USING (artist_key) WHERE label_mentioned""",
    ),
    "entity_brief": query(
        ["briefs", "signals"],
        """SELECT s.artist_key, string_split(s.name, ' ')[1] || ' ' || string_split(s.name, ' ')[2]
             AS name, s.breakout_score, s.size_band, s.lastfm_url, b.brief_md
           FROM signals s LEFT JOIN briefs b USING (artist_key)
           WHERE starts_with(s.name, 'small ring ')""",
    ),
}
