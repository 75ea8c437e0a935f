"""Common table expressions over the supplied tables, mirrored from ``upswell.views``."""

from __future__ import annotations

CTES: dict[str, str] = {
    "user_daily": """
      SELECT 'user:' || user_id AS artist_key, coalesce(p_name, 'user ' || user_id) AS name,
             snapshot_date,
             CAST(sum(n) OVER w AS BIGINT) AS lastfm_listeners,
             CAST(sum(cents) OVER w AS BIGINT) AS lastfm_playcount
      FROM (SELECT user_id, CAST(ts AS DATE) AS snapshot_date, count(*) AS n,
                   sum(CAST(round(value * 100) AS BIGINT)) AS cents
            FROM events GROUP BY ALL)
      LEFT JOIN part ON p_partkey = user_id
      WINDOW w AS (PARTITION BY user_id ORDER BY snapshot_date)""",
    "user_charts": """
      SELECT snapshot_date, country, rank, 'user:' || user_id AS artist_key,
             n AS country_listeners
      FROM (SELECT *, CAST(row_number() OVER (PARTITION BY snapshot_date, country
                                         ORDER BY n DESC, user_id) AS INTEGER) AS rank
            FROM (SELECT CAST(ts AS DATE) AS snapshot_date, event_type AS country, user_id,
                         count(*) AS n FROM events GROUP BY ALL))
      WHERE rank <= 10""",
    "user_profile": """
      SELECT 'user:' || p_partkey AS artist_key, p_name AS name,
             [p_type, p_brand] || string_split(p_name, ' ') AS tags, p_size > 25 AS on_tour,
             'https://example.com/' || p_partkey AS lastfm_url,
             CASE WHEN p_brand = 'Brand#13' AND contains(p_name, 'e') THEN
               array_to_string(list_transform(string_split(replace(p_name, 'e', 'é'), ' '),
                 lambda w: upper(w[1]) || w[2:]), ' ')
               WHEN p_brand = 'Brand#13' THEN
               array_to_string(list_transform(string_split(p_name, ' '),
                 lambda w: upper(w[1]) || w[2:]), ' ') END AS alias_name
      FROM part""",
    "part_polled": """
      SELECT 'part:' || p_partkey AS artist_key, p_name AS name, snapshot_date,
             CAST(sum(coalesce(returned_q, 0)) OVER w AS BIGINT) AS lastfm_listeners,
             CAST(sum(coalesce(q, 0)) OVER w AS BIGINT) AS lastfm_playcount
      FROM (SELECT p_partkey, p_name, CAST(d AS DATE) AS snapshot_date
            FROM part, (SELECT unnest(generate_series(max(CAST(l_shipdate AS DATE)) - 29,
                          max(CAST(l_shipdate AS DATE)), INTERVAL 1 DAY)) AS d FROM lineitem))
      LEFT JOIN (
        SELECT l_partkey, greatest(CAST(l_shipdate AS DATE),
                 (SELECT max(CAST(l_shipdate AS DATE)) - 29 FROM lineitem)) AS day,
               sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS BIGINT) ELSE 0 END)
                 AS returned_q,
               sum(CAST(l_quantity AS BIGINT)) AS q
        FROM lineitem GROUP BY ALL) ON l_partkey = p_partkey AND day = snapshot_date
      WINDOW w AS (PARTITION BY p_partkey ORDER BY snapshot_date)""",
    "supplier_charts": """
      SELECT snapshot_date, country, rank, 'part:' || l_partkey AS artist_key
      FROM (SELECT *, row_number() OVER (PARTITION BY snapshot_date, country
                                         ORDER BY q DESC, l_partkey) AS rank
            FROM (SELECT CAST(l_shipdate AS DATE) AS snapshot_date, l_returnflag AS country,
                         l_partkey, sum(CAST(l_quantity AS BIGINT)) AS q
                  FROM lineitem
                  WHERE CAST(l_shipdate AS DATE) >=
                        (SELECT max(CAST(l_shipdate AS DATE)) - 29 FROM lineitem)
                  GROUP BY ALL))
      WHERE rank <= 100""",
    "signals": """
      SELECT 'mbid:p' || p_partkey AS artist_key,
             p_name || ' ' || p_brand || ' ' || p_size AS name,
             DATE '2001-05-15' AS as_of_date,
             [p_type, p_brand] || string_split(p_name, ' ') AS tags,
             p_type || ', ' || p_brand || ', ' || string_split(p_name, ' ')[1] AS genres,
             CAST(p_size AS BIGINT) * p_size * p_size * p_size AS lastfm_listeners,
             CAST(p_size AS BIGINT) * p_size * p_size * p_size * 7 AS lastfm_playcount,
             CASE WHEN p_size ** 4 >= 2000000 THEN '2M+' WHEN p_size ** 4 >= 500000 THEN '500k-2M'
                  WHEN p_size ** 4 >= 50000 THEN '50k-500k' WHEN p_size ** 4 >= 10000 THEN '10k-50k'
                  ELSE '<10k' END AS size_band,
             CASE WHEN p_type <> 'PROMO' THEN round(p_retailprice - 900, 1) END AS breakout_score,
             round((p_retailprice - 940) / 7, 3) AS listeners_7d_growth_pct,
             round((p_retailprice - 930) / 5, 3) AS listeners_14d_growth_pct,
             p_size % 9 AS growth_window_days, p_size % 9 < 7 AS is_provisional,
             p_size % 3 AS new_country_charts_14d,
             CASE WHEN p_size < 20 THEN ['Brazil', 'Canada'] WHEN p_size < 30 THEN ['Canada']
                  ELSE CAST([] AS VARCHAR[]) END AS chart_countries,
             p_size > 25 AS on_tour, 'https://example.com/' || p_partkey AS lastfm_url,
             CASE WHEN p_brand = 'Brand#13' THEN p_name END AS possible_alias_of
      FROM part""",
    "show_events": """
      SELECT o_orderkey AS event_id, 'Order ' || o_orderkey AS event_name,
             CAST(o_orderdate AS DATE) AS event_date, '20:00:00' AS local_time,
             CASE o_orderstatus WHEN 'O' THEN 'onsale' WHEN 'F' THEN 'offsale' ELSE 'canceled' END
               AS status,
             'Venue ' || o_custkey AS venue,
             CASE WHEN o_orderpriority = '1-URGENT' THEN lower(n_name) ELSE n_name END AS city,
             CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN round(o_totalprice / 10000, 2) END
               AS min_price,
             CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN round(o_totalprice / 10000, 2) * 2
               END AS max_price,
             CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN 'CAD' END AS currency,
             'https://example.com/o/' || o_orderkey AS ticket_url, o_orderpriority AS tm_genre
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "bills": """
      SELECT l_orderkey AS event_id, CAST(row_number() OVER (PARTITION BY l_orderkey
               ORDER BY l_linenumber, l_partkey, l_shipdate, l_extendedprice) - 1 AS INTEGER) AS billing_order,
             'p' || l_partkey AS attraction_id, 'Part ' || l_partkey AS performer_name
      FROM lineitem""",
    "bill_matches": """
      SELECT 'p' || p_partkey AS attraction_id, 'Part ' || p_partkey AS performer_name,
             'mbid:p' || p_partkey AS artist_key,
             p_name || ' ' || p_brand || ' ' || p_size AS artist_name, 100.0 AS match_score,
             CASE p_type WHEN 'STANDARD' THEN 'review' WHEN 'SMALL' THEN 'fuzzy'
                         WHEN 'ECONOMY' THEN 'exact' ELSE 'mbid' END AS match_method
      FROM part""",
    "listening": """
      SELECT * FROM (
        SELECT o_custkey AS user, 'overall' AS period, p_name || ' ' || p_brand || ' ' || p_size AS name,
               CASE WHEN p_type <> 'LARGE' THEN 'p' || p_partkey END AS mbid,
               CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS playcount, p_partkey
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
        GROUP BY ALL
        UNION ALL
        SELECT o_custkey, '3month', p_name || ' ' || p_brand || ' ' || p_size,
               CASE WHEN p_type <> 'LARGE' THEN 'p' || p_partkey END,
               CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT), p_partkey
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
        WHERE CAST(o_orderdate AS DATE) > (SELECT CAST(max(o_orderdate) AS DATE) - 90 FROM orders)
        GROUP BY ALL)""",
    "edges": """
      SELECT 'mbid:p' || l_partkey AS from_key, 'mbid:p' || l_suppkey AS to_key, p_name AS to_name,
             least(q / 128.0::DOUBLE, 1.0::DOUBLE) AS match
      FROM (SELECT l_partkey, l_suppkey, sum(CAST(l_quantity AS BIGINT)) AS q FROM lineitem
            WHERE l_partkey <> l_suppkey GROUP BY ALL)
      JOIN part ON p_partkey = l_suppkey""",
}
# Which expressions each one reads.
NEEDS: dict[str, list[str]] = {}


def define(name: str, sql: str, needs: list[str] | None = None) -> None:
    CTES[name], NEEDS[name] = sql, needs or []


def query(names: list[str], body: str) -> str:
    """``body`` behind the named expressions and all they need, in dependency order."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for other in NEEDS.get(name, []):
            visit(other)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    clauses = ",\n".join(f"{n} AS MATERIALIZED ({CTES[n]})" for n in ordered)
    return f"WITH {clauses}\n{body}"
