"""Landing, raw JSON, clean tables and exports."""

from __future__ import annotations

from oracle import growth  # noqa: F401  (defines user_history)
from oracle.base import define, query

ROUNDTRIP = """SELECT event_id, user_id, event_type, value, CAST(ts AS DATE) AS snapshot_date,
  true AS from_landing FROM events"""

define(
    "snapshots",
    """
  SELECT CASE WHEN value > 10 THEN 'mbid:u' || user_id ELSE 'name:' || p_name END AS artist_key,
         CASE WHEN value > 20 THEN upper(p_name) ELSE p_name END AS name,
         CAST(user_id AS VARCHAR) AS mbid, CAST(ts AS DATE) AS snapshot_date,
         CASE WHEN event_type <> 'error' THEN CAST(json_extract(props, '$.k') AS BIGINT) END
           AS lastfm_listeners,
         event_id AS lastfm_playcount, value > 50 AS on_tour,
         'https://example.com/' || event_id AS lastfm_url, p_name, ts AS fetched_at
  FROM events JOIN part ON p_partkey = user_id""",
)
define(
    "clean_daily",
    """
  SELECT artist_key, name, mbid, snapshot_date, lastfm_listeners, lastfm_playcount, on_tour
  FROM snapshots WHERE lastfm_listeners IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY lower(name), snapshot_date
    ORDER BY starts_with(artist_key, 'mbid:') DESC, artist_key, fetched_at DESC) = 1""",
    ["snapshots"],
)
define(
    "profile",
    """
  SELECT s.artist_key, s.name, s.mbid, s.on_tour, s.lastfm_url, 'About ' || p_name AS bio_summary,
         s.snapshot_date AS profile_date
  FROM snapshots s JOIN (SELECT artist_key, max(snapshot_date) AS d FROM clean_daily GROUP BY 1) l
    ON l.artist_key = s.artist_key AND l.d = s.snapshot_date
  QUALIFY row_number() OVER (PARTITION BY s.artist_key ORDER BY fetched_at DESC) = 1""",
    ["snapshots", "clean_daily"],
)

ORACLES = {
    "raw_roundtrip": ROUNDTRIP,
    "stream_ingest": ROUNDTRIP,
    "day_replace": """
      SELECT CAST(ts AS DATE) AS snapshot_date, count(*) AS events,
             CAST(sum(user_id) AS BIGINT) AS user_sum,
             dense_rank() OVER (ORDER BY CAST(ts AS DATE) DESC) <= 2 AS reloaded
      FROM events GROUP BY CAST(ts AS DATE)""",
    "landing_contracts": """
      SELECT contract, problem, count(*) AS lines FROM (
        SELECT 'artist' AS contract, CASE p_size % 10 WHEN 0 THEN 'not JSON'
          WHEN 1 THEN 'missing payload.name' END AS problem FROM part
        UNION ALL
        SELECT 'chart', CASE WHEN o_orderkey % 7 = 0 THEN 'wrong type'
          WHEN o_orderstatus = 'P' THEN 'missing country' END FROM orders
        UNION ALL
        SELECT 'edge', CASE WHEN l_returnflag = 'R' THEN 'missing to_key' END FROM lineitem
        UNION ALL
        SELECT 'event', CASE WHEN user_id % 5 = 0 THEN 'wrong type'
          WHEN user_id % 3 = 0 THEN 'missing payload.id' END FROM events)
      GROUP BY ALL""",
    "landing_kept": """
      SELECT o_orderpriority AS country, CAST(o_orderkey AS INTEGER) AS rank,
        'customer ' || o_custkey AS name, CAST(o_custkey AS BIGINT) AS listeners
      FROM orders WHERE o_orderkey % 7 <> 0 AND o_orderstatus <> 'P'""",
    "dataset_replace": """
      SELECT s_name AS name, CAST(s_nationkey AS BIGINT) AS nation, 'supplier' AS source FROM supplier""",
    "typed_landing": """SELECT 'name:' || p_name AS artist_key, p_name AS name,
      CAST(p_size AS BIGINT) AS listeners, p_partkey AS playcount FROM part""",
    "days_to_load": """
      SELECT day FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders)
      WHERE day NOT IN (SELECT CAST(l_shipdate AS DATE) FROM lineitem)
      UNION
      (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders ORDER BY day DESC LIMIT 2)""",
    "variant_extract": """
      SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
             CAST(json_extract(props, '$.k') AS BIGINT) AS k_from_text,
             CAST(NULL AS VARCHAR) AS missing, CAST(NULL AS DATE) AS not_a_date
      FROM events""",
    "variant_array_shapes": """
      SELECT p_partkey,
        CASE WHEN p_size > 30 THEN p_type || '|' || p_brand || '|' || replace(p_name, ' ', '|')
             WHEN p_size > 10 THEN p_brand ELSE '' END AS tags,
        CAST(CASE WHEN p_size > 30 THEN 2 + len(string_split(p_name, ' '))
                  WHEN p_size > 10 THEN 1 ELSE 0 END AS INTEGER) AS n_tags
      FROM part""",
    "variant_events": query(
        ["show_events"],
        """SELECT event_id, event_name, event_date, status,
             CASE WHEN tm_genre <> '2-HIGH' THEN venue ELSE '1 Main St' END AS venue, city,
             min_price, max_price, currency
           FROM show_events WHERE status <> 'canceled' AND tm_genre <> '5-LOW'""",
    ),
    "variant_explode_bill": query(
        ["bills"],
        """SELECT event_id,
             CAST(row_number() OVER (PARTITION BY event_id ORDER BY billing_order) - 1 AS INTEGER)
               AS billing_order,
             attraction_id, performer_name, CAST(NULL AS VARCHAR) AS performer_mbid
           FROM bills WHERE event_id IN (SELECT o_orderkey FROM orders)""",
    ),
    "dedupe_latest": query(["clean_daily"], "SELECT * FROM clean_daily"),
    "profile_latest": query(["profile"], "SELECT * FROM profile"),
    "resolve_chart_names": query(
        ["user_charts", "profile"],
        """
      SELECT c.snapshot_date, c.country, c.rank, coalesce(n.artist_key, c.artist_key) AS artist_key,
             n.artist_key IS NOT NULL AS in_pool, c.name, c.country_listeners
      FROM (SELECT u.*, CASE WHEN p_size > 40 THEN p_name || ' live' ELSE
              array_to_string(list_transform(string_split(p_name, ' '),
                lambda w: upper(w[1]) || w[2:]), ' ') END AS name
            FROM user_charts u JOIN part ON artist_key = 'user:' || p_partkey) c
      LEFT JOIN (SELECT lower(name) AS lname, min(artist_key) AS artist_key FROM profile GROUP BY 1)
        n ON lower(c.name) = lname""",
    ),
    "latest_day_rows": """
      SELECT event_id, CAST(ts AS DATE) AS snapshot_date FROM events
      WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)""",
    "export_last_n_days": """
      SELECT CAST(l_shipdate AS DATE) AS snapshot_date, count(*) AS lines FROM lineitem
      GROUP BY 1 QUALIFY dense_rank() OVER (ORDER BY snapshot_date DESC) <= 30""",
    "export_meta": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count, 'files' AS source FROM {t}"
        for t in ("part", "orders", "events", "customer")
    ),
    "csv_array_reload": query(
        ["signals"],
        """SELECT artist_key, name, breakout_score, tags[2] AS second_tag,
             CAST(len(tags) AS INTEGER) AS n_tags,
             array_to_string(chart_countries, '|') AS chart_countries FROM signals""",
    ),
    "utc_export": "SELECT event_id, ts AS exported_at FROM events",
    "error_rate": """
      SELECT count(*) AS lookups, count(*) FILTER (event_type = 'error') AS errors,
             round(count(*) FILTER (event_type = 'error') / count(*), 6) AS error_rate,
             count(*) FILTER (event_type = 'error') / count(*) > 0.10 AS incomplete
      FROM events""",
    "update_matched": """
      SELECT o_orderkey, coalesce(s, o_orderstatus) AS o_orderstatus,
             coalesce(p, o_totalprice) AS o_totalprice
      FROM orders LEFT JOIN (SELECT l_orderkey, max(l_linestatus) AS s, max(l_extendedprice) AS p
                             FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""",
}

ORACLES |= {
    "rebuild_table": "SELECT p_partkey, p_name, p_size FROM part",
    "table_comments": """
      SELECT * FROM (VALUES ('p_partkey', 'bigint', 'The part''s number'), ('p_name', 'string', NULL),
                            ('p_size', 'int', 'Size, 1 to 50')) t(col_name, data_type, comment)""",
    "saved_view": "SELECT p_name, count(*) AS parts FROM part GROUP BY p_name",
    "export_history": query(
        ["user_history"],
        """SELECT * FROM user_history WHERE snapshot_date IN
             (SELECT DISTINCT snapshot_date FROM user_daily ORDER BY 1 DESC LIMIT 10)""",
    ),
    "missing_days": """
      SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders
      WHERE CAST(o_orderdate AS DATE) NOT IN (SELECT CAST(l_shipdate AS DATE) FROM lineitem)""",
}
