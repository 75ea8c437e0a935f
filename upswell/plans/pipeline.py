"""The daily run: landing files -> raw -> clean -> scored tables -> checks.

Tables are Parquet folders under one lake root. Raw, parsed, chart, history and count tables are
kept per day, so a run touches the days it loads. What older days say about an entity is kept as
of a day (``until=`` folders): a run goes on from the newest such table before its first changed
day. Tables of one row per entity are replaced as a new version, which is read once it is whole."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from upswell import folders, settings
from upswell.operators import latest
from upswell.operators.growth import compact_history, growth_history, history_after, with_compacted
from upswell.plans import quality, resolve, shows, signals
from upswell.sources import landing
from upswell.staging import cleared_after

# --- fixed values: raw table -> landing dataset ---
DATASETS = {
    "lastfm_artist_info_raw": "lastfm/artist_info",
    "lastfm_geo_top_raw": "lastfm/geo_top",
    "lastfm_similar_raw": "lastfm/similar",
    "tm_events_raw": "ticketmaster/events",
}
POOL_FILE = "candidates/pool.jsonl"


@dataclass(frozen=True)
class Lake:
    """Where each layer's tables live."""

    spark: SparkSession
    root: str

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def read(self, layer: str, table: str) -> DataFrame:
        path = self.path(layer, table)
        versions = self.versions(path)
        return self.spark.read.parquet(f"{path}/version={versions[-1]}" if versions else path)

    def versions(self, path: str) -> list[int]:
        return sorted(map(int, folders.finished(self.spark, path, "version")))

    def raw(self, table: str) -> DataFrame:
        return landing.read_raw(self.spark, self.path("bronze", table))

    def rebuild(self, df: DataFrame, layer: str, table: str) -> DataFrame:
        """Replace a whole table and go on from what was written. The rows go to a new version,
        which counts from the moment its write has ended; until then, and if the run is lost,
        the one before is read. That one stays for readers under way, older ones go."""
        path = self.path(layer, table)
        started = sorted(map(int, folders.values(self.spark, path, "version")))
        new = started[-1] + 1 if started else 1
        df.write.parquet(f"{path}/version={new}")
        before = [v for v in self.versions(path) if v < new]
        for old in started:
            if old not in before[-1:]:
                folders.delete(self.spark, f"{path}/version={old}")
        return self.read(layer, table)

    def days(self, layer: str, table: str) -> list[str]:
        return landing.loaded_days(self.spark, self.path(layer, table))

    def of_days(self, layer: str, table: str, days: Sequence[str]) -> DataFrame:
        """Rows of some days; those without a folder have none. Names the folders, so neither the
        files nor the folders of other days are looked at."""
        path, there = self.path(layer, table), set(self.days(layer, table))
        wanted = [f"{path}/snapshot_date={d}" for d in days if d in there]
        if not wanted:
            return (self.raw(table) if layer == "bronze" else self.read(layer, table)).limit(0)
        return self.spark.read.option("basePath", path).parquet(*wanted)

    def until(self, table: str) -> str | None:
        """The newest day as of which ``table`` is kept."""
        done = folders.finished(self.spark, self.path("silver", table), "until")
        return done[-1] if done else None

    def as_of(self, table: str, day: str) -> DataFrame:
        return self.spark.read.parquet(self.path("silver", f"{table}/until={day}"))

    def keep_as_of(self, df: DataFrame, table: str, day: str) -> None:
        """Keep ``df`` as the state after ``day`` and drop the states before it."""
        path = self.path("silver", table)
        df.write.mode("overwrite").parquet(f"{path}/until={day}")
        for old in folders.values(self.spark, path, "until"):
            if old < day:
                folders.delete(self.spark, f"{path}/until={old}")

    def forget_from(self, table: str, day: str) -> None:
        """Drop the states that a change of ``day`` makes wrong."""
        path = self.path("silver", table)
        for kept in folders.values(self.spark, path, "until"):
            if kept >= day:
                folders.delete(self.spark, f"{path}/until={kept}")


PROFILES, TOTALS_KEPT, COMPACTED = "artist_profile_until", "artist_totals_until", "artist_compacted"


def settled_day(days: Sequence[str]) -> str | None:
    """The last of ``days`` that the next day's run will not load again."""
    back = max(settings.RELOAD_RECENT_DAYS, 1)
    return days[-back] if len(days) >= back else None


def run_bronze(lake: Lake, landing_root: str) -> dict[str, list[str]]:
    """Load new and recent days of every dataset that has landed; returns the days loaded."""
    loaded = {
        table: landing.ingest(lake.spark, landing_root, dataset, lake.path("bronze", table))
        for table, dataset in DATASETS.items()
    }
    lake.rebuild(
        landing.read_pool(lake.spark, f"{landing_root}/{POOL_FILE}"), "bronze", "candidate_pool"
    )
    return loaded


def due_days(lake: Lake, raw: str, table: str, loaded: Sequence[str]) -> list[str]:
    """Days ``table`` has to take from ``raw``: those loaded, and any an earlier run left out."""
    left_out = set(lake.days("bronze", raw)) - set(lake.days("silver", table))
    return sorted(left_out | set(loaded))


def run_artists(lake: Lake, loaded: Sequence[str]) -> DataFrame:
    """Parsed lines, one row per name and day, and the counts of a day depend on that day alone
    and are replaced for the days loaded. The profile is the newest kept one and the days since."""
    days = due_days(lake, "lastfm_artist_info_raw", "artist_counts", loaded)
    if days:
        for table in (PROFILES, TOTALS_KEPT, COMPACTED):
            lake.forget_from(table, days[0])
        raw = lake.of_days("bronze", "lastfm_artist_info_raw", days)
        rows = landing.parse_artists(landing.only_parsed(raw))
        landing.replace_days(rows, lake.path("silver", "artist_parsed"), days=days)
        fresh = lake.of_days("silver", "artist_parsed", days)
        landing.replace_days(latest.artist_daily(fresh), lake.path("silver", "artist_daily"), days=days)
        named = raw.select(
            "snapshot_date", F.try_variant_get("raw", "$.payload.name", "string").alias("name")
        )
        counts = quality.day_counts(lake.of_days("silver", "artist_daily", days), named)
        landing.replace_days(counts, lake.path("silver", "artist_counts"), days=days)
    base, all_days = lake.until(PROFILES), lake.days("silver", "artist_daily")
    profile = lake.rebuild(profile_since(lake, base, all_days), "silver", "artist_profile")
    settled = settled_day(all_days)
    if settled is not None and (base is None or settled > base):
        kept = profile_since(lake, base, [d for d in all_days if d <= settled])
        lake.keep_as_of(kept, PROFILES, settled)
    return profile


def profile_since(lake: Lake, base: str | None, days: Sequence[str]) -> DataFrame:
    """The profile after ``days``; those up to ``base`` are taken from the kept one."""
    days = [d for d in days if base is None or d > base]
    fresh = latest.artist_profile(
        lake.of_days("silver", "artist_parsed", days), lake.of_days("silver", "artist_daily", days)
    )
    if base is None:
        return fresh
    return latest.newer_rows(lake.as_of(PROFILES, base), fresh, "artist_key", "profile_date")


def run_charts(lake: Lake, profile: DataFrame, loaded: Sequence[str]) -> None:
    """Chart rows are parsed for the days loaded. Earlier days are resolved again only where a
    name on them has come to stand for another entity since, which the names kept tell."""
    days = due_days(lake, "lastfm_geo_top_raw", "chart_rows", loaded)
    raw = lake.of_days("bronze", "lastfm_geo_top_raw", days)
    newest = latest.newest_chart_rows(landing.parse_charts(landing.only_parsed(raw)))
    landing.replace_days(newest, lake.path("silver", "chart_rows"), days=days)
    if not lake.days("silver", "chart_rows"):
        return
    names = latest.tracked_names(profile)
    if not lake.versions(lake.path("silver", "chart_names")):
        days = lake.days("silver", "chart_rows")
    else:
        moved = latest.renamed(lake.read("silver", "chart_names"), names)
        if not moved.isEmpty():
            touched = lake.read("silver", "chart_rows").join(moved, F.lower("name") == F.col("lname"), "left_semi")
            again = touched.select(F.col("snapshot_date").cast("string")).distinct().collect()
            days = sorted(set(days) | {r[0] for r in again})
    resolved = latest.with_tracked(lake.of_days("silver", "chart_rows", days), names)
    landing.replace_days(resolved, lake.path("silver", "chart_daily"), days=days)
    lake.rebuild(names, "silver", "chart_names")


def charts(lake: Lake) -> DataFrame:
    """Resolved chart rows of all days; empty while no chart has landed."""
    if lake.days("silver", "chart_daily"):
        return lake.read("silver", "chart_daily")
    nothing = landing.parse_charts(lake.raw("lastfm_geo_top_raw")).limit(0)
    return latest.resolve_chart_names(nothing, lake.read("silver", "artist_profile"))


def run_silver(lake: Lake, loaded: dict[str, list[str]]) -> None:
    """Clean tables."""
    profile = run_artists(lake, loaded["lastfm_artist_info_raw"])
    run_charts(lake, profile, loaded["lastfm_geo_top_raw"])
    # The newest day is looked for among folder names, before any column is.
    edges = latest.on_latest_day(lake.raw("lastfm_similar_raw"))
    lake.rebuild(landing.parse_edges(landing.only_parsed(edges)), "silver", "artist_similar")

    pulled = latest.on_latest_day(lake.raw("tm_events_raw"))
    lines = landing.latest_events(landing.only_parsed(pulled))
    lake.rebuild(landing.parse_events(lines), "silver", "events")
    bill = lake.rebuild(landing.parse_bills(lines), "silver", "event_performers")
    lake.rebuild(
        resolve.match_performers(bill, profile.select("artist_key", "name", "mbid")),
        "silver",
        "event_artist_match",
    )


def review_queue(lake: Lake) -> DataFrame:
    return resolve.review_queue(
        lake.read("silver", "event_artist_match"),
        lake.read("silver", "event_performers"),
        lake.read("silver", "events"),
    )


TOTALS = ["artist_key", "name", "snapshot_date", "lastfm_listeners", "lastfm_playcount"]
CHANGES = {"lastfm_listeners": "listeners_change", "lastfm_playcount": "playcount_change"}


def compacted_days(lake: Lake) -> list[str]:
    return folders.finished(lake.spark, lake.path("silver", COMPACTED), "until")


def compact(lake: Lake, until: str) -> None:
    """Fold the history up to a day, at least two weeks back, into a few rows per entity; later
    runs of :func:`run_gold` read those and the days since."""
    metrics = ["lastfm_listeners", "lastfm_playcount"]
    rows = compact_history(scoring_rows(lake), F.lit(until).cast("date"), metrics)
    lake.keep_as_of(rows, COMPACTED, until)


def scoring_rows(lake: Lake) -> DataFrame:
    """All daily totals, or the latest compacted ones and the days after."""
    daily, done = lake.read("silver", "artist_daily").select(*TOTALS), compacted_days(lake)
    if not done:
        return daily
    return with_compacted(lake.as_of(COMPACTED, done[-1]), daily.filter(F.col("snapshot_date") > F.lit(done[-1]).cast("date")))


def run_history(lake: Lake) -> None:
    """Growth history of the days after the newest kept totals, which hold the one earlier row
    an entity's first change needs. The totals are carried on after the history is written, so a
    run that was lost is made up for by the next."""
    base, all_days = lake.until(TOTALS_KEPT), lake.days("silver", "artist_daily")
    days = [d for d in all_days if base is None or d > base]
    rows = lake.of_days("silver", "artist_daily", days).select(*TOTALS)
    if base is None:
        history = growth_history(rows, CHANGES)
    else:
        history = history_after(lake.as_of(TOTALS_KEPT, base), rows, CHANGES)
    written = [d for d in lake.days("gold", "artist_growth_history") if base is None or d > base]
    landing.replace_days(
        history, lake.path("gold", "artist_growth_history"), days=sorted({*days, *written})
    )
    settled = settled_day(all_days)
    if settled is not None and (base is None or settled > base):
        older = rows.filter(F.col("snapshot_date") <= F.lit(settled).cast("date"))
        last = latest.one_per(older, ["artist_key"], [F.col("snapshot_date").desc()])
        if base is not None:
            last = latest.newer_rows(lake.as_of(TOTALS_KEPT, base), last, "artist_key", "snapshot_date")
        lake.keep_as_of(last, TOTALS_KEPT, settled)


def run_gold(lake: Lake, today: Column) -> None:
    """Signals, growth history and upcoming shows."""
    scored = lake.rebuild(
        signals.growth_signals(
            scoring_rows(lake),
            charts(lake),
            profile=lake.read("silver", "artist_profile"),
        ),
        "gold",
        "artist_signals",
    )
    run_history(lake)
    lake.rebuild(
        shows.upcoming_shows(
            lake.read("silver", "events"),
            lake.read("silver", "event_performers"),
            lake.read("silver", "event_artist_match"),
            scored,
            today,
        ),
        "gold",
        "upcoming_shows",
    )


def run_quality(lake: Lake, today: Column) -> DataFrame:
    """The metrics row, from the counts kept per day; raises when a rule is broken."""
    metrics = quality.metrics_of_days(
        lake.read("silver", "artist_counts"),
        lake.read("bronze", "candidate_pool"),
        lake.read("gold", "artist_signals"),
    )
    return quality.require_quality(metrics, today)


def run_all(lake: Lake, landing_root: str, today: Column) -> DataFrame:
    with cleared_after(lake.spark):
        run_silver(lake, run_bronze(lake, landing_root))
        run_gold(lake, today)
    return run_quality(lake, today)
