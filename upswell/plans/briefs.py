"""Facts and prompts for one-page briefs, and what is read out of the texts that come back.

Calling a text model is left to the caller, who stores the responses before deriving columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from upswell import settings
from upswell.functions import text
from upswell.sources.catalog import update_matched

INSTRUCTIONS = """Write a one-page brief in Markdown from the facts below and nothing else.
Say so where a fact is missing. Use the headings Who they are, Signing status, What's growing,
Where, Sounds like, Live and Caveats, each after three hash signs. Under Signing status quote the
bio if it names a label; otherwise write "No label mentioned in the Last.fm bio (not confirmed
unsigned)." """


def brief_facts(
    signals: DataFrame,
    profile: DataFrame,
    shows: DataFrame,
    top_n: int = settings.BRIEF_TOP_N,
    exclude_bands: Sequence[str] = (settings.SUPERSTAR_BAND,),
    first_shows: int = settings.BRIEF_SHOWS,
) -> DataFrame:
    """The top scored entities with their profile texts, the first ``first_shows`` of their coming
    shows in date order and the number of all. Only those shows are ever gathered."""
    scored = signals.filter("breakout_score IS NOT NULL AND possible_alias_of IS NULL")
    if exclude_bands:
        scored = scored.filter(~F.col("size_band").isin(*exclude_bands))
    top = scored.orderBy(F.col("breakout_score").desc(), "artist_key").limit(top_n)
    theirs = Window.partitionBy("artist_key")
    place = F.row_number().over(theirs.orderBy("event_date", "event_id"))
    # The count and the cut share the rows' one partitioning by entity.
    leading = (
        shows.join(top.select("artist_key"), "artist_key", "left_semi")
        .withColumn("_place", place)
        .withColumn("n_shows", F.count("*").over(theirs))
        .filter(F.col("_place") <= first_shows)
    )
    listed = leading.groupBy("artist_key").agg(
        F.array_sort(
            F.collect_list(
                F.struct("event_date", "event_id", "venue", "city", "min_price", "currency")
            )
        ).alias("shows"),
        F.max("n_shows").alias("n_shows"),
    )
    texts = profile.select("artist_key", "bio_summary", "similar_names")
    return top.join(texts, "artist_key", "left").join(listed, "artist_key", "left")


def listed_or(items: Column, otherwise: str) -> Column:
    return F.coalesce(F.nullif(F.array_join(items, ", "), F.lit("")), F.lit(otherwise))


def show_line(show: Column) -> Column:
    price = F.when(
        show["min_price"] != 0,
        F.concat(
            F.lit(" (from "), F.format_string("%.0f", F.bround(show["min_price"], 0)), F.lit(" "), show["currency"], F.lit(")")
        ),
    )
    return F.concat(
        F.lit("- "),
        show["event_date"].cast("string"),
        F.lit(": "),
        show["venue"],
        F.lit(", "),
        show["city"],
        F.coalesce(price, F.lit("")),
    )


def prompts(facts: DataFrame, instructions: str = INSTRUCTIONS) -> DataFrame:
    """One prompt per entity, holding every fact the brief may use. A fact whose column is
    missing reads as one that is not known."""

    def known(column: str, kind: str) -> Column:
        return F.col(column) if column in facts.columns else F.lit(None).cast(kind)

    provisional = F.format_string(
        "%s days (PROVISIONAL: under a week of history)", F.col("growth_window_days").cast("string")
    )
    days = F.format_string("%s days", F.col("growth_window_days").cast("string"))
    bio = text.truncate_words(text.strip(F.coalesce("bio_summary", F.lit(""))))
    lines = [
        F.concat(F.lit("Artist: "), "name"),
        F.concat(
            F.lit("Listeners: "),
            text.grouped_number(F.col("lastfm_listeners")),
            F.lit(", size band "),
            F.coalesce("size_band", F.lit("n/a")),
        ),
        F.concat(
            F.lit("Score: "),
            F.col("breakout_score").cast("string"),
            F.lit(" of 100, rank "),
            F.coalesce(known("breakout_rank", "int").cast("string"), F.lit("n/a")),
        ),
        F.concat(
            F.lit("Listener growth, 7 days: "),
            text.signed_percent(F.col("listeners_7d_growth_pct")),
            F.lit(", new listeners "),
            text.grouped_number(known("new_listeners_7d", "bigint")),
            F.lit(", measured over "),
            F.when(F.col("is_provisional"), provisional).otherwise(days),
        ),
        F.concat(
            F.lit("Listener growth, 14 days: "),
            text.signed_percent(F.col("listeners_14d_growth_pct")),
        ),
        F.concat(
            F.lit("Play growth, 7 days: "),
            text.signed_percent(known("plays_7d_growth_pct", "double")),
        ),
        F.concat(F.lit("Charts today: "), listed_or(F.col("chart_countries"), "none")),
        F.concat(
            F.lit("New charts in 14 days: "),
            F.coalesce("new_country_charts_14d", F.lit(0)).cast("string"),
        ),
        F.concat(F.lit("Tags: "), listed_or(F.col("tags"), "none")),
        F.concat(F.lit("Similar: "), listed_or(F.col("similar_names"), "none listed")),
        F.concat(F.lit("Bio: "), F.coalesce(F.nullif(bio, F.lit("")), F.lit("none"))),
        F.concat(
            F.lit("Shows:\n"),
            F.coalesce(
                F.nullif(F.array_join(F.transform("shows", show_line), "\n"), F.lit("")),
                F.lit("- none found"),
            ),
            F.when(
                known("n_shows", "bigint") > F.size("shows"),
                F.format_string("\n- and %d more", known("n_shows", "bigint") - F.size("shows")),
            ).otherwise(""),
        ),
    ]
    body = F.concat_ws("\n", F.lit(instructions), F.lit("FACTS"), *lines)
    return facts.select("artist_key", "name", "as_of_date", body.alias("prompt"))


def is_blank(response: str = "response") -> Column:
    return F.coalesce(F.trim(F.col(f"{response}.result")), F.lit("")) == ""


def merge_retries(raw: DataFrame, retried: DataFrame) -> DataFrame:
    """Stored responses where blank ones are replaced by a second attempt. ``retried``:
    artist_key, response, model, generated_at; rows that had text are left alone."""
    blank = raw.filter(is_blank()).select("artist_key")
    return update_matched(
        raw,
        retried.join(blank, "artist_key", "left_semi"),
        "artist_key",
        ["response", "model", "generated_at"],
    )


def parse_briefs(raw: DataFrame, prompt_version: str) -> DataFrame:
    """Columns read out of stored responses: cleaned text or error, the signing status section
    and whether it names a label (NULL without that section)."""
    blank = is_blank()
    brief = F.when(~blank, F.trim(text.ascii_punctuation(F.col("response.result"))))
    error = F.when(blank, F.coalesce("response.errorMessage", F.lit("empty response")))
    return (
        raw.withColumn("brief_md", brief)
        .withColumn("error", error)
        .withColumn("prompt_version", F.lit(prompt_version))
        .withColumn("signing_status", text.markdown_section(F.col("brief_md"), "Signing status"))
        .withColumn(
            "label_mentioned", text.lacks_prefix(F.col("signing_status"), settings.NO_LABEL)
        )
        .drop("response")
    )


def failed_briefs(briefs: DataFrame) -> DataFrame:
    return briefs.agg(
        F.count("*").alias("briefs"), F.count_if(F.col("error").isNotNull()).alias("failed")
    )


def label_briefs(briefs: DataFrame, signals: DataFrame) -> DataFrame:
    """Briefs whose bio names a label, with the entity's score, best first when ordered."""
    return (
        briefs.filter("label_mentioned")
        .select("artist_key", "name", "signing_status")
        .join(signals.select("artist_key", "size_band", "breakout_score"), "artist_key")
    )


def entity_brief(signals: DataFrame, briefs: DataFrame, name: str) -> DataFrame:
    """One entity by name, ignoring case, with its brief if it has one."""
    return (
        signals.filter(F.lower("name") == F.lower(F.lit(name)))
        .select("artist_key", "name", "breakout_score", "size_band", "lastfm_url")
        .join(briefs.select("artist_key", "brief_md"), "artist_key", "left")
    )
