"""Rankings, shows, profiles, quality."""

from __future__ import annotations

from oracle.base import define, query

RANKED = """name, artist_key, breakout_score, size_band, lastfm_listeners, listeners_7d_growth_pct,
  listeners_14d_growth_pct, array_to_string(chart_countries, '|') AS chart_countries, genres,
  is_provisional, lastfm_url"""

define(
    "shows",
    """
  SELECT e.event_id, e.event_name, e.event_date, e.local_time, e.status, e.venue, e.city,
         e.min_price, e.max_price, e.currency, e.ticket_url, e.tm_genre, m.artist_key,
         coalesce(s.name, m.artist_name) AS artist_name, p.billing_order = 0 AS is_headliner,
         m.match_method, s.breakout_score, s.size_band, s.lastfm_listeners, s.genres,
         s.listeners_7d_growth_pct, s.is_provisional
  FROM show_events e JOIN bills p USING (event_id)
  JOIN bill_matches m ON m.attraction_id = p.attraction_id
   AND m.match_method IN ('mbid', 'exact', 'fuzzy')
  LEFT JOIN signals s USING (artist_key)
  WHERE e.event_date >= DATE '2001-05-20' AND e.status NOT IN ('canceled', 'cancelled')""",
    ["show_events", "bills", "bill_matches", "signals"],
)
define(
    "bill_lists",
    """
  SELECT event_id, list(performer_name ORDER BY billing_order) AS bill FROM bills GROUP BY 1""",
    ["bills"],
)


def search(where: str, limit: int) -> str:
    return query(
        ["shows", "bill_lists"],
        f"""
      SELECT * EXCLUDE (bill, match_method, is_provisional, tm_genre),
        CASE WHEN is_headliner THEN 'headliner' ELSE 'support' END AS role,
        bill[1] AS headliner, array_to_string(bill[1:6], '|') AS lineup,
        CAST(len(bill) AS INTEGER) AS lineup_size, min_price IS NOT NULL AS price_known
      FROM (SELECT shows.*, count(*) OVER () AS total_matches,
                   count(min_price) OVER () AS priced_matches
            FROM shows LEFT JOIN (SELECT artist_key AS k, tags FROM signals) ON k = artist_key
            WHERE {where}
            ORDER BY breakout_score DESC NULLS LAST, event_date, event_id, artist_key LIMIT {limit})
      LEFT JOIN bill_lists USING (event_id)""",
    )


STATUS = """CASE WHEN found IS NULL THEN 'unknown'
  WHEN code IN ('onsale') THEN 'on sale' WHEN code IN ('canceled', 'postponed') THEN code
  WHEN TIMESTAMP '1998-01-01' < sale_start THEN 'not on sale yet'
  WHEN TIMESTAMP '1998-01-01' < sale_end THEN 'off sale' ELSE 'sales closed' END"""

define(
    "show_status",
    """
  SELECT * FROM show_events LEFT JOIN (
    SELECT o_orderkey, true AS found,
      CASE WHEN o_orderpriority = '1-URGENT' THEN 'postponed' WHEN o_orderstatus = 'O'
        THEN 'onsale' WHEN o_orderstatus = 'F' THEN 'offsale' ELSE 'canceled' END AS code,
      o_orderdate - INTERVAL 100 DAYS AS sale_start, o_orderdate - INTERVAL 1 DAY AS sale_end,
      CASE WHEN o_totalprice > 200000 THEN CAST(o_orderdate AS DATE) END AS new_date
    FROM orders WHERE o_orderpriority <> '2-HIGH') ON o_orderkey = event_id""",
    ["show_events"],
)

ORACLES = {
    "top_risers": query(
        ["user_signals"],
        """SELECT name, artist_key, breakout_score, breakout_rank, size_band, lastfm_listeners,
             listeners_7d_growth_pct, listeners_14d_growth_pct, plays_7d_growth_pct,
             new_listeners_7d, replace(chart_countries, ', ', '|') AS chart_countries, genres,
             is_provisional, lastfm_url
           FROM user_signals
           WHERE breakout_score IS NOT NULL AND possible_alias_of IS NULL AND size_band <> '80+'
           ORDER BY breakout_score DESC, lastfm_listeners, artist_key LIMIT 20""",
    ),
    "top_risers_country": query(
        ["signals"],
        f"""SELECT {RANKED},
             CASE WHEN list_contains(chart_countries, 'Canada') THEN 'chart' ELSE 'tag' END
               AS country_evidence
           FROM signals WHERE breakout_score IS NOT NULL AND possible_alias_of IS NULL
             AND (list_contains(chart_countries, 'Canada') OR on_tour)
           ORDER BY breakout_score DESC, lastfm_listeners, artist_key LIMIT 50""",
    ),
    "genre_risers": query(
        ["signals"],
        f"""SELECT {RANKED} FROM signals
           WHERE breakout_score IS NOT NULL AND possible_alias_of IS NULL AND size_band <> '2M+'
             AND len(list_filter(tags, lambda t: contains(lower(t), 'rin'))) > 0
           ORDER BY breakout_score DESC, lastfm_listeners, artist_key LIMIT 10""",
    ),
    "whole_tag_risers": query(
        ["signals"],
        f"""SELECT {RANKED} FROM signals
           WHERE breakout_score IS NOT NULL AND possible_alias_of IS NULL
             AND size_band = '10k-50k' AND list_contains(tags, 'ring')
           ORDER BY breakout_score DESC, lastfm_listeners, artist_key LIMIT 10""",
    ),
    "new_on_charts": query(
        ["signals"],
        """SELECT artist_key, name, size_band, breakout_score, new_country_charts_14d,
             array_to_string(chart_countries, '|') AS chart_countries, genres
           FROM signals WHERE list_contains(chart_countries, 'Brazil')
             AND new_country_charts_14d > 0 AND possible_alias_of IS NULL
           ORDER BY breakout_score DESC NULLS LAST, artist_key LIMIT 10""",
    ),
    "country_names": """
      SELECT doc_id, upper(lang) AS place,
        CASE lang WHEN 'fr' THEN 'France' WHEN 'de' THEN 'Germany' WHEN 'es' THEN 'Spain' END
          AS country_name FROM documents""",
    "data_notes": query(
        ["signals"],
        """SELECT max(as_of_date) AS as_of_date,
             median(growth_window_days) FILTER (breakout_score IS NOT NULL) AS median_window_days,
             CAST(5 AS INTEGER) AS age_days,
             'latest day is 2001-05-15, 5 days ago' || CASE WHEN
               median(growth_window_days) FILTER (breakout_score IS NOT NULL) > 7
               THEN '|weekly growth compares with 2001-05-07, 8 days before'
               ELSE '' END AS notes
           FROM signals""",
    ),
    "data_status": " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, count(*) AS row_count, 'files' AS source, DATE '2001-05-15' AS data_as_of,
            CAST(5 AS INTEGER) AS days_since_data FROM {t}"""
        for t in ("part", "orders", "lineitem", "events", "customer", "documents")
    ),
    "upcoming_shows": query(["shows"], "SELECT * FROM shows"),
    "lineups": query(
        ["bill_lists"],
        """SELECT event_id, bill[1] AS headliner, array_to_string(bill[1:3], '|') AS lineup,
             CAST(len(bill) AS INTEGER) AS lineup_size FROM bill_lists""",
    ),
    "show_search": search(
        """event_date BETWEEN DATE '2001-05-20' AND DATE '2001-05-20' + 60
           AND (min_price <= 30 OR min_price IS NULL) AND breakout_score >= 40""",
        50,
    ),
    "show_search_city": search(
        """event_date BETWEEN DATE '2001-05-20' AND DATE '2001-05-20' + 90
           AND lower(city) = 'nation_3'
           AND len(list_filter(tags, lambda t: contains(lower(t), 'ring'))) > 0""",
        50,
    ),
    "show_search_priced": search(
        """event_date BETWEEN DATE '2001-05-20' AND DATE '2001-05-20' + 30
           AND min_price IS NOT NULL AND size_band = '50k-500k'""",
        20,
    ),
    "cheap_shows": query(
        ["shows"],
        """SELECT artist_name, artist_key, event_id, event_date, venue, min_price, currency,
             breakout_score, size_band, genres, ticket_url
           FROM shows WHERE city = 'NATION_3'
             AND event_date BETWEEN DATE '2001-05-20' AND DATE '2001-05-20' + 60
             AND breakout_score >= 70 AND size_band <> '2M+'
             AND (min_price <= 30 OR min_price IS NULL)
           ORDER BY breakout_score DESC, event_date, event_id, artist_key LIMIT 10""",
    ),
    "shows_elsewhere": query(
        ["shows"],
        """SELECT artist_key, event_id, event_date, city,
             CAST(row_number() OVER (PARTITION BY artist_key ORDER BY event_date, event_id)
               AS INTEGER) AS place
           FROM shows WHERE lower(city) <> 'nation_3' QUALIFY place <= 5""",
    ),
    "weekend_shows": """
      SELECT DISTINCT CAST(o_orderdate AS DATE) AS event_date,
        CASE WHEN isodow(o_orderdate) >= 6 THEN CAST(o_orderdate AS DATE)
             ELSE CAST(o_orderdate AS DATE) + CAST(5 - isodow(o_orderdate) AS INTEGER) END
          AS weekend_from,
        CAST(o_orderdate AS DATE) + CAST(7 - isodow(o_orderdate) AS INTEGER) AS weekend_to
      FROM orders""",
    "ticket_recount": query(
        ["show_status"],
        f"""
      SELECT city, count(*) FILTER (NOT gone) AS count, count(*) FILTER (gone) AS canceled,
        'off sale does not confirm sold out' || CASE WHEN count(*) FILTER (gone) > 0
          THEN '|' || count(*) FILTER (gone) || ' canceled since and left out' ELSE '' END AS notes
      FROM (SELECT city, ({STATUS}) = 'canceled' AS gone FROM show_status) GROUP BY city""",
    ),
    "search_window": query(
        ["signals"],
        """SELECT max(as_of_date) AS as_of_date, DATE '2001-05-20' AS first_day,
             DATE '2001-05-20' + 90 AS last_day,
             'shows are known up to ' || (max(as_of_date) + 90) AS note FROM signals""",
    ),
    "ticket_status": query(
        ["show_status"],
        f"""
      SELECT event_id, event_date, city, {STATUS} AS ticket_status,
        CASE WHEN found IS NULL THEN 'Not listed any more (removed or canceled?).'
          WHEN code = 'postponed' THEN 'Listed as postponed' ||
            coalesce('; date now ' || new_date, '') || '.'
          WHEN ({STATUS}) = 'not on sale yet'
            THEN 'Public sale starts ' || CAST(sale_start AS DATE) || '.'
          WHEN ({STATUS}) = 'off sale'
            THEN 'Not selling in its sale window: often sold out, unconfirmed.' END AS ticket_note
      FROM show_status
      WHERE ({STATUS}) <> 'canceled'""",
    ),
    "entity_profile": "",
    "quality_metrics": query(
        ["snapshots", "clean_daily"],
        """
      SELECT *, 'latest day 2024-01-30 is before 2024-02-01'
          || CASE WHEN latest_rows < 0.9 * pool_size THEN '|only ' || latest_rows || ' of '
               || pool_size || ' tracked entities have a row' ELSE '' END
          || CASE WHEN duplicate_rows > 0 THEN '|' || duplicate_rows
               || ' rows repeat an entity and day' ELSE '' END
          || CASE WHEN bronze_latest_distinct_names - latest_rows > 0.01 * bronze_latest_rows
               THEN '|' || bronze_latest_distinct_names - latest_rows || ' of '
               || bronze_latest_rows || ' raw rows did not parse' ELSE '' END
          || CASE WHEN gold_rows <> latest_rows THEN '|' || gold_rows || ' signal rows for '
               || latest_rows || ' entities' ELSE '' END
          || CASE WHEN gold_bad_scores > 0 THEN '|' || gold_bad_scores || ' scores are not within 0 and 100'
               ELSE '' END AS failures
      FROM (SELECT
        (SELECT max(snapshot_date) FROM clean_daily) AS latest_date,
        (SELECT count(DISTINCT user_id) FROM events) AS pool_size,
        (SELECT count(*) FROM clean_daily WHERE snapshot_date =
          (SELECT max(snapshot_date) FROM clean_daily)) AS latest_rows,
        (SELECT count(*) FROM (SELECT 1 FROM clean_daily GROUP BY artist_key, snapshot_date
                               HAVING count(*) > 1)) AS duplicate_rows,
        (SELECT count(*) FROM snapshots WHERE snapshot_date =
          (SELECT max(snapshot_date) FROM clean_daily)) AS bronze_latest_rows,
        (SELECT count(DISTINCT lower(name)) FROM snapshots WHERE snapshot_date =
          (SELECT max(snapshot_date) FROM clean_daily)) AS bronze_latest_distinct_names,
        (SELECT count(*) FROM clean_daily WHERE snapshot_date =
          (SELECT max(snapshot_date) FROM clean_daily)) AS gold_rows,
        (SELECT count(*) FROM clean_daily WHERE snapshot_date =
          (SELECT max(snapshot_date) FROM clean_daily)
          AND (lastfm_listeners * 1.2 - 5 < 0 OR lastfm_listeners * 1.2 - 5 > 100))
          AS gold_bad_scores)""",
    ),
    "duplicate_keys": """SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
      GROUP BY ALL HAVING count(*) > 1""",
    "scalar_numbers": query(
        ["signals"],
        """
      SELECT p_partkey, size_band,
        round(greatest(0, least(1, ln(1000000 / lastfm_listeners) / ln(100))), 9) AS smallness,
        CASE WHEN p_retailprice - 900 <> 0
          THEN round(greatest(0, 1 - (p_retailprice - 900) / 100), 9) ELSE 0 END AS cheapness,
        round(5 * tanh((p_retailprice - 950) / 5 / 5), 9) AS soft_clip,
        round((exp(ln((lastfm_listeners + 10) / lastfm_listeners) / 7 * 7) - 1) * 100, 6)
          AS growth_pct,
        round_even(round((p_size - 25) / 2, 9), 0) AS half_even, genres,
        contains(p_name, 'ring') AS has_ring, 'p' || p_partkey AS mbid
      FROM part JOIN signals ON artist_key = 'mbid:p' || p_partkey""",
    ),
}

define(
    "part_history",
    """
  SELECT artist_key, snapshot_date, lastfm_listeners,
         lastfm_listeners - lag(lastfm_listeners) OVER w AS listeners_change,
         lag(snapshot_date) OVER w AS prev
  FROM (SELECT 'mbid:p' || l_partkey AS artist_key, snapshot_date,
               CAST(sum(q) OVER (PARTITION BY l_partkey ORDER BY snapshot_date) AS BIGINT)
                 AS lastfm_listeners
        FROM (SELECT l_partkey, CAST(l_shipdate AS DATE) AS snapshot_date,
                     sum(CAST(l_quantity AS BIGINT)) AS q FROM lineitem GROUP BY ALL))
  WINDOW w AS (PARTITION BY artist_key ORDER BY snapshot_date)""",
)
ORACLES["entity_profile"] = query(
    ["part_history", "shows", "bill_lists", "signals"],
    """
  SELECT s.artist_key, s.name, s.breakout_score, array_to_string(s.tags[1:10], '|') AS tags,
    t.pattern, t.days, t.total_change, t.largest_one_day_date, t.daily_listeners, b.brief_md,
    h.shows
  FROM signals s
  LEFT JOIN (
    SELECT artist_key, days, daily_listeners,
      CASE WHEN days < 3 THEN 'insufficient_history' WHEN total <= 0 THEN 'flat'
           WHEN round_even(round(top.s, 9), 0) / total > 0.5 OR up < 3 THEN 'concentrated'
           ELSE 'steady' END AS pattern,
      CASE WHEN days >= 3 THEN total END AS total_change,
      CASE WHEN days >= 3 THEN top.d END AS largest_one_day_date
    FROM (
      SELECT artist_key, count(*) AS days, max(lastfm_listeners) - min(lastfm_listeners) AS total,
        max({'s': listeners_change / greatest(snapshot_date - prev, 1), 'd': snapshot_date})
          FILTER (prev IS NOT NULL) AS top,
        coalesce(sum(greatest(snapshot_date - prev, 1)) FILTER (listeners_change > 0), 0) AS up,
        string_agg(snapshot_date || '=' || lastfm_listeners, ' ' ORDER BY snapshot_date)
          AS daily_listeners
      FROM part_history GROUP BY 1)) t USING (artist_key)
  LEFT JOIN (SELECT 'mbid:p' || conv_id AS artist_key, arg_max(text, turn) AS brief_md
             FROM conversations WHERE role = 'assistant' AND text IS NOT NULL GROUP BY 1) b
    USING (artist_key)
  LEFT JOIN (
    SELECT artist_key, string_agg(event_date || ';' || event_id || ';' ||
        CASE WHEN is_headliner THEN 'headliner' ELSE 'support' END || ';' || bill[1] || ';' ||
        array_to_string(bill[1:6], '+') || ';' || len(bill), ' / '
        ORDER BY event_date, event_id) AS shows
    FROM (SELECT * FROM shows QUALIFY row_number() OVER
            (PARTITION BY artist_key ORDER BY event_date, event_id) <= 50)
    JOIN bill_lists USING (event_id) GROUP BY 1) h USING (artist_key)""",
)
