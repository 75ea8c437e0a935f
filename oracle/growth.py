"""Growth signals, history, trend and charts."""

from __future__ import annotations

from oracle.base import define, query


def signals_sql(prefix: str, daily: str, charts: str, bands: list[tuple[int, str]]) -> str:
    """Define the scoring steps for one daily source; returns the name of the final one."""
    band = "CASE " + " ".join(
        f"WHEN lastfm_listeners >= {low} THEN '{name}'" for low, name in reversed(bands)
    )
    define(
        f"{prefix}_points",
        f"""
      SELECT d.artist_key, a.as_of_date,
        max(CASE WHEN snapshot_date = as_of_date THEN name END) AS name,
        max(lastfm_listeners) FILTER (snapshot_date = as_of_date) AS l_now,
        max(lastfm_playcount) FILTER (snapshot_date = as_of_date) AS p_now,
        min(snapshot_date) AS first_seen,
        coalesce(max(snapshot_date) FILTER (snapshot_date <= as_of_date - 7),
                 min(snapshot_date) FILTER (snapshot_date < as_of_date)) AS base7,
        coalesce(max(snapshot_date) FILTER (snapshot_date <= as_of_date - 14),
                 min(snapshot_date) FILTER (snapshot_date < as_of_date)) AS base14
      FROM {daily} d, (SELECT max(snapshot_date) AS as_of_date FROM {daily}) a
      GROUP BY ALL
      HAVING bool_or(snapshot_date = as_of_date)""",
        [daily],
    )
    define(
        f"{prefix}_changed",
        f"""
      SELECT artist_key, max(snapshot_date) AS stats_last_changed
      FROM (SELECT *, lag(lastfm_listeners) OVER w AS pl, lag(lastfm_playcount) OVER w AS pp,
                   row_number() OVER w AS n
            FROM {daily} WINDOW w AS (PARTITION BY artist_key ORDER BY snapshot_date))
      WHERE n > 1 AND (lastfm_listeners <> pl OR lastfm_playcount <> pp)
      GROUP BY 1""",
        [daily],
    )
    define(
        f"{prefix}_rates",
        f"""
      SELECT *,
        CASE WHEN l_now = l_then AND p_now = p_then THEN NULL
             WHEN l_now > 0 AND l_then > 0 AND span >= 1 THEN ln(l_now / l_then) / span END AS lr,
        CASE WHEN l_now = l_then14 THEN NULL
             WHEN l_now > 0 AND l_then14 > 0 AND span14 >= 1 THEN ln(l_now / l_then14) / span14
             END AS lr14,
        CASE WHEN l_now = l_then AND p_now = p_then THEN NULL
             WHEN p_now > 0 AND p_then > 0 AND span >= 1 THEN ln(p_now / p_then) / span END AS pr
      FROM (
        SELECT p.*, {band.replace("lastfm_listeners", "l_now")} END AS size_band,
               b7.lastfm_listeners AS l_then, b7.lastfm_playcount AS p_then,
               b14.lastfm_listeners AS l_then14,
               as_of_date - base7 AS span, as_of_date - base14 AS span14
        FROM {prefix}_points p
        LEFT JOIN {daily} b7 ON b7.artist_key = p.artist_key AND b7.snapshot_date = base7
        LEFT JOIN {daily} b14 ON b14.artist_key = p.artist_key AND b14.snapshot_date = base14)""",
        [f"{prefix}_points"],
    )
    stats = []
    for m in ("lr", "pr"):
        stats.append(
            f"""SELECT '{m}' AS metric, size_band AS scope, median({m}) AS med,
                  1.4826 * median(abs({m} - m0)) AS scale, count({m}) AS members
                FROM (SELECT size_band, {m}, median({m}) OVER (PARTITION BY size_band) AS m0
                      FROM {prefix}_rates WHERE size_band IS NOT NULL) GROUP BY 2
                UNION ALL
                SELECT '{m}', '*', median({m}), 1.4826 * median(abs({m} - m0)), count({m})
                FROM (SELECT {m}, median({m}) OVER () AS m0 FROM {prefix}_rates)"""
        )
    define(f"{prefix}_stats", "\nUNION ALL\n".join(stats), [f"{prefix}_rates"])

    def z(m: str) -> str:
        return f"""(SELECT CASE WHEN r.{m} IS NULL OR r.size_band IS NULL THEN NULL
               WHEN own.members >= 10 AND own.scale > 0
                 THEN tanh((r.{m} - own.med) / own.scale / 5.0) * 5.0
               WHEN a.scale > 0 THEN tanh((r.{m} - a.med) / a.scale / 5.0) * 5.0
               ELSE 0.0 END
             FROM (SELECT * FROM {prefix}_stats WHERE metric = '{m}' AND scope = '*') a
             LEFT JOIN (SELECT * FROM {prefix}_stats WHERE metric = '{m}') own
               ON own.scope = r.size_band)"""

    define(
        f"{prefix}_entries",
        f"""
      SELECT artist_key,
        count(*) FILTER (first > base AND first >= as_of_date - 13) AS new_charts,
        coalesce(string_agg(country, ', ' ORDER BY country) FILTER (today > 0), '') AS here
      FROM (SELECT artist_key, country, min(snapshot_date) AS first,
                   count(*) FILTER (snapshot_date = as_of_date) AS today,
                   any_value(as_of_date) AS as_of_date, any_value(base) AS base
            FROM {charts}, (SELECT max(snapshot_date) AS as_of_date FROM {daily}),
                 (SELECT min(snapshot_date) AS base FROM {charts})
            WHERE snapshot_date <= as_of_date
            GROUP BY artist_key, country)
      GROUP BY 1""",
        [daily, charts],
    )
    define(
        f"{prefix}_scored",
        f"""
      SELECT *, CASE WHEN lz IS NOT NULL THEN
          (0.0 + coalesce(lz, 0) * 0.45 + coalesce(pz, 0) * 0.25
           + least(new_charts, 3) * 0.15 + 0.0 * 0.15)
          / (0.0 + 0.45 + CASE WHEN pz IS NULL THEN 0.0 ELSE 0.25 END + 0.15 + 0.0) END AS bz
      FROM (SELECT r.*, {z("lr")} AS lz, {z("pr")} AS pz,
                   coalesce(e.new_charts, 0) AS new_charts, coalesce(e.here, '') AS here,
                   c.stats_last_changed
            FROM {prefix}_rates r
            LEFT JOIN {prefix}_entries e USING (artist_key)
            LEFT JOIN {prefix}_changed c USING (artist_key))""",
        [f"{prefix}_rates", f"{prefix}_stats", f"{prefix}_entries", f"{prefix}_changed"],
    )
    define(
        f"{prefix}_signals",
        f"""
      SELECT artist_key, name, as_of_date, l_now AS lastfm_listeners, p_now AS lastfm_playcount,
        size_band,
        CASE WHEN bz IS NOT NULL THEN round_even(round(round(
          (rank() OVER (PARTITION BY bz IS NULL ORDER BY bz)
           + (count(*) OVER (PARTITION BY bz) - 1) / 2.0::DOUBLE)
          / count(bz) OVER () * 100, 9) * 10, 6), 0) / 10 END AS breakout_score,
        CASE WHEN bz IS NOT NULL THEN
          CAST(rank() OVER (ORDER BY bz DESC NULLS LAST) AS INTEGER) END AS breakout_rank,
        round(bz, 6) AS breakout_z,
        round((exp(lr * 7) - 1) * 100, 6) AS listeners_7d_growth_pct,
        round((exp(lr14 * 14) - 1) * 100, 6) AS listeners_14d_growth_pct,
        round((exp(pr * 7) - 1) * 100, 6) AS plays_7d_growth_pct,
        CASE WHEN lr IS NOT NULL THEN
          CAST(round_even(round((l_now - l_then) * 7 / span, 9), 0) AS BIGINT) END AS new_listeners_7d,
        CAST(new_charts AS INTEGER) AS new_country_charts_14d, here AS chart_countries,
        round(lz, 6) AS listener_growth_z, round(pz, 6) AS play_growth_z,
        CASE WHEN lr IS NOT NULL THEN CAST(span AS INTEGER) END AS growth_window_days,
        NOT (lr IS NOT NULL AND span >= 7) AS is_provisional,
        CAST(as_of_date - first_seen + 1 AS INTEGER) AS history_days, stats_last_changed
      FROM {prefix}_scored""",
        [f"{prefix}_scored"],
    )
    return f"{prefix}_signals"


USERS = signals_sql(
    "u", "user_daily", "user_charts", [(0, "<60"), (60, "60-70"), (70, "70-80"), (80, "80+")]
)
PARTS = signals_sql(
    "p",
    "part_polled",
    "supplier_charts",
    [(0, "<100"), (100, "100-250"), (250, "250-400"), (400, "400+")],
)

define(
    "user_signals",
    """
      SELECT s.*, coalesce(p.tags, CAST([] AS VARCHAR[])) AS tags,
        coalesce(array_to_string(p.tags[1:3], ', '), '') AS genres,
        p.on_tour, p.lastfm_url, p.alias_name AS possible_alias_of
      FROM u_signals s LEFT JOIN user_profile p USING (artist_key)""",
    ["u_signals", "user_profile"],
)

HISTORY = """
  SELECT artist_key, name, snapshot_date, lastfm_listeners, lastfm_playcount,
         lastfm_listeners - lag(lastfm_listeners) OVER w AS listeners_change,
         lastfm_playcount - lag(lastfm_playcount) OVER w AS playcount_change
  FROM user_daily WINDOW w AS (PARTITION BY artist_key ORDER BY snapshot_date)"""
define("user_history", HISTORY, ["user_daily"])

define(
    "user_trend",
    """
  SELECT artist_key,
    CASE WHEN days < 3 THEN 'insufficient_history' WHEN total <= 0 THEN 'flat'
         WHEN biggest / total > 0.5 OR up < 3 THEN 'concentrated' ELSE 'steady' END AS pattern,
    days,
    CASE WHEN days >= 3 THEN f.d END AS "from", CASE WHEN days >= 3 THEN l.d END AS "to",
    CASE WHEN days >= 3 THEN f.v END AS listeners_start,
    CASE WHEN days >= 3 THEN l.v END AS listeners_end,
    CASE WHEN days >= 3 THEN total END AS total_change,
    CASE WHEN days >= 3 THEN up END AS days_with_increase,
    CASE WHEN days >= 3 THEN biggest END AS largest_one_day_change,
    CASE WHEN days >= 3 THEN top.d END AS largest_one_day_date,
    CASE WHEN days >= 3 AND total > 0 THEN round_even(round(round(biggest / total, 9) * 1000, 6), 0) / 1000 END
      AS largest_one_day_share,
    CASE WHEN days >= 3 THEN gaps END AS gaps
  FROM (
   SELECT *, l.v - f.v AS total, CAST(round_even(round(top.s, 9), 0) AS BIGINT) AS biggest FROM (
    SELECT artist_key, count(*) AS days,
      min({'d': snapshot_date, 'v': lastfm_listeners}) AS f,
      max({'d': snapshot_date, 'v': lastfm_listeners}) AS l,
      max({'s': step, 'd': snapshot_date}) FILTER (step IS NOT NULL) AS top,
      CAST(coalesce(sum(gap) FILTER (step > 0), 0) AS BIGINT) AS up,
      coalesce(string_agg(prev || '>' || snapshot_date || ':' || gap, ' ' ORDER BY snapshot_date)
               FILTER (gap > 1), '') AS gaps
    FROM (SELECT *, greatest(snapshot_date - prev, 1) AS gap,
                 CASE WHEN prev IS NOT NULL THEN coalesce(listeners_change, 0) /
                      greatest(snapshot_date - prev, 1) END AS step
          FROM (SELECT *, lag(snapshot_date) OVER (PARTITION BY artist_key
                                                   ORDER BY snapshot_date) AS prev
                FROM user_history))
    GROUP BY artist_key))""",
    ["user_history"],
)

ORACLES = {
    "growth_signals": query(["user_signals"], "SELECT * REPLACE (array_to_string(tags, '|') AS tags) FROM user_signals"),
    "growth_signals_dense": query([PARTS], f"SELECT * FROM {PARTS}"),
    "growth_history": query(["user_history"], "SELECT * FROM user_history"),
    "trend_summary": query(["user_trend"], "SELECT * FROM user_trend"),
    "history_runs": query(
        ["user_daily"],
        """
      SELECT artist_key, snapshot_date, lastfm_listeners,
             CASE WHEN gap > 3 THEN prev END AS pause_from,
             CAST(sum(CASE WHEN gap > 3 THEN 1 ELSE 0 END) OVER
               (PARTITION BY artist_key ORDER BY snapshot_date) AS BIGINT) AS run
      FROM (SELECT *, lag(snapshot_date) OVER w AS prev,
                   coalesce(snapshot_date - lag(snapshot_date) OVER w, 0) AS gap
            FROM user_daily WINDOW w AS (PARTITION BY artist_key ORDER BY snapshot_date))""",
    ),
    "chart_positions": query(["user_charts"], "SELECT * FROM user_charts"),
    "chart_entries": query(
        ["u_entries"],
        """SELECT artist_key, CAST(new_charts AS INTEGER) AS new_country_charts,
                  here AS chart_countries FROM u_entries""",
    ),
    "robust_scales": query(
        ["u_stats"],
        "SELECT metric, scope, round(med, 9) AS median, round(scale, 9) AS scale, members "
        "FROM u_stats",
    ),
}
ORACLES["growth_signals_compacted"] = ORACLES["growth_signals"]
