"""Which tracked entity is this performer? By ID, then exact name, then similar name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from upswell import settings
from upswell.functions.text import entity_key, is_tribute, key_to_mbid, match_form
from upswell.operators.fuzzy import closest, most_similar, sorted_tokens
from upswell.operators.latest import one_per
from upswell.staging import staged

MATCH_COLUMNS = (
    "attraction_id performer_name artist_key artist_name match_score match_method".split()
)


def names_by_form(artists: DataFrame, order: list[Column]) -> DataFrame:
    """One entity per match form: columns ``form``, ``artist_key``, ``artist_name``."""
    forms = artists.withColumn("form", match_form(F.col("name")))
    return one_per(forms, ["form"], order).select(
        "form", "artist_key", F.col("name").alias("artist_name")
    )


def match_performers(
    performers: DataFrame, artists: DataFrame, order: list[Column] | None = None
) -> DataFrame:
    """One row per distinct performer with the entity found, a 0-100 score and the method.

    performers: attraction_id, performer_name, performer_mbid; artists: artist_key, name, mbid.
    ``order`` decides among entities sharing an ID or a name (default: the smallest key).
    Tribute acts are never given to the act they cover. Similar names below the trust threshold,
    or short ones, are marked for review."""
    order = order or [F.col("artist_key")]
    acts = performers.select("attraction_id", "performer_name", "performer_mbid").distinct()
    # Acts without an ID must not meet in one join partition: give each its own key that
    # matches nothing.
    no_id = F.concat(F.lit("\u0000"), F.col("attraction_id"))
    acts = acts.withColumn("tribute", is_tribute(F.col("performer_name"))).withColumn(
        "_id", F.coalesce(F.lower(F.nullif("performer_mbid", F.lit(""))), no_id)
    )
    ids = one_per(
        artists.filter("mbid <> ''").withColumn("_id", F.lower("mbid")), ["_id"], order
    ).select("_id", F.col("artist_key").alias("_id_key"), F.col("name").alias("_id_name"))
    acts = acts.join(ids, "_id", "left")

    # Folded names are read by several joins below: work them out once.
    by_form = staged(names_by_form(artists, order))
    open_names = (
        acts.filter("NOT tribute AND _id_key IS NULL")
        .select("performer_name")
        .distinct()
        .withColumn("form", match_form(F.col("performer_name")))
    )
    exact = staged(open_names.join(by_form, "form", "left"))
    unmatched = exact.filter("artist_key IS NULL AND form <> ''").select("form").distinct()
    similar = best_similar(unmatched, by_form, order)
    named = (
        exact.join(similar, "form", "left")
        .select(
            "performer_name",
            F.coalesce("artist_key", "similar_key").alias("_name_key"),
            F.coalesce("artist_name", "similar_name").alias("_name_name"),
            F.when(F.col("artist_key").isNotNull(), 100.0).otherwise(F.col("score")).alias("_score"),
            F.when(F.col("artist_key").isNotNull(), "exact")
            .when(F.col("score").isNull(), "none")
            .when(
                (F.col("score") >= settings.AUTO_THRESHOLD)
                & (F.length("form") >= settings.MIN_FUZZY_LEN),
                "fuzzy",
            )
            .otherwise("review")
            .alias("_method"),
        )
    )
    by_id = F.col("_id_key").isNotNull()
    found = acts.join(named, "performer_name", "left")
    return found.select(
        "attraction_id",
        "performer_name",
        F.when(F.col("tribute"), None)
        .otherwise(F.coalesce("_id_key", "_name_key"))
        .alias("artist_key"),
        F.when(F.col("tribute"), None)
        .otherwise(F.when(by_id, F.col("_id_name")).otherwise(F.col("_name_name")))
        .alias("artist_name"),
        F.when(F.col("tribute"), 0.0)
        .when(by_id, 100.0)
        .otherwise(F.coalesce("_score", F.lit(0.0)))
        .alias("match_score"),
        F.when(F.col("tribute"), "tribute")
        .when(by_id, "mbid")
        .otherwise(F.coalesce("_method", F.lit("none")))
        .alias("match_method"),
    )


def best_similar(forms: DataFrame, by_form: DataFrame, order: list[Column]) -> DataFrame:
    """The most similar entity for each form: ``form``, ``similar_key``, ``similar_name``,
    ``score``. Equal scores go to the smaller key."""
    left = forms.select("form", sorted_tokens(F.col("form")).alias("left_text"))
    right = by_form.select(
        "artist_key", "artist_name", sorted_tokens(F.col("form")).alias("right_text")
    )
    entities = staged(
        one_per(right, ["right_text"], [F.col("artist_key")]).select(
            F.col("right_text").alias("text"), F.col("artist_key").alias("label"), "artist_key", "artist_name"
        )
    )
    best = most_similar(left.select(F.col("left_text").alias("text")).distinct(), entities).join(
        entities.withColumnRenamed("text", "right_text"), "right_text"
    )
    return left.join(best, "left_text").select(
        "form",
        F.col("artist_key").alias("similar_key"),
        F.col("artist_name").alias("similar_name"),
        "score",
    )


def match_counts(matches: DataFrame) -> DataFrame:
    return matches.groupBy("match_method").agg(F.count("*").alias("performers"))


def review_queue(matches: DataFrame, performers: DataFrame, events: DataFrame) -> DataFrame:
    """Uncertain matches with the events they are billed on, for a person to decide."""
    return (
        matches.filter("match_method = 'review'")
        .join(performers.select("attraction_id", "event_id"), "attraction_id")
        .join(events.select("event_id", "event_name", "event_date", "venue"), "event_id")
        .select(*MATCH_COLUMNS, "event_id", "event_name", "event_date", "venue")
    )


def trusted_bill(bill: DataFrame, matches: DataFrame) -> DataFrame:
    """Billed acts with a trusted match: event_id, billing_order, artist_key, artist_name."""
    found = matches.filter(F.col("match_method").isin(*settings.MATCHED_METHODS))
    return bill.join(
        found.select("attraction_id", "artist_key", "artist_name"), "attraction_id"
    ).select("event_id", "billing_order", "artist_key", "artist_name")


def pool_as_artists(signals: DataFrame) -> DataFrame:
    """Tracked entities with the ID taken back out of their key."""
    return signals.select("artist_key", "name", key_to_mbid(F.col("artist_key")).alias("mbid"))


def performers_of(bill: DataFrame, order: list[Column]) -> DataFrame:
    """One (ID, name, mbid) per act; the last billing in ``order`` wins."""
    return one_per(bill, ["attraction_id"], order).select(
        "attraction_id", "performer_name", "performer_mbid"
    )


def find_entities(signals: DataFrame, names: list[str] | DataFrame) -> DataFrame:
    """Look up names as a person types them, a list or a table with a ``query`` column of any length.
    One row per name asked: whether and how it matched, the
    entity, and up to three alternatives "name (score)". An exact name wins; otherwise only a
    clear, close and long enough name is taken, else the asker must choose.

    signals: artist_key, name, size_band, lastfm_listeners, possible_alias_of."""
    if not isinstance(names, DataFrame):
        names = signals.sparkSession.createDataFrame([(n,) for n in names], "query STRING")
    # Names are folded once, as is what they are looked up in.
    asked = staged(names.select("query").withColumn("query_form", match_form(F.col("query"))))
    entities = staged(
        one_per(
            signals.withColumn("form", match_form(F.col("name"))),
            ["form"],
            [
                F.col("possible_alias_of").isNotNull(),
                F.col("lastfm_listeners").desc_nulls_last(),
                F.col("artist_key"),
            ],
        ).select("form", "artist_key", "name", "size_band", sorted_tokens(F.col("form")).alias("text"))
    )
    forms = asked.select("query_form", sorted_tokens(F.col("query_form")).alias("asked")).distinct()
    near = closest(forms.select(F.col("asked").alias("text")), entities.select("text", F.col("form").alias("label")))
    nearest = (
        forms.join(near.select("asked", F.col("label").alias("form"), "score", "place"), "asked")
        .join(entities.drop("text"), "form")
    )
    entry = F.struct("place", "score", "form", "artist_key", "name", "size_band")
    per_form = nearest.groupBy("query_form").agg(F.array_sort(F.collect_list(entry)).alias("near"))
    exact = F.filter("near", lambda c: c["form"] == F.col("query_form"))
    others = F.slice(F.filter("near", lambda c: c["form"] != F.col("query_form")), 1, 3)
    runner_up = F.when(F.size("near") > 1, F.col("near")[1]["score"]).otherwise(0.0)
    clear = (
        (F.col("near")[0]["score"] >= settings.AUTO_THRESHOLD)
        & (F.length("query_form") >= settings.MIN_FUZZY_LEN)
        & (runner_up < settings.AUTO_THRESHOLD)
    )
    method = F.when(F.size(exact) > 0, "exact").when(clear, "fuzzy")
    chosen = F.when(F.col("method") == "exact", exact[0]).when(
        F.col("method") == "fuzzy", F.col("near")[0]
    )
    left_over = F.when(F.col("method") == "fuzzy", F.slice(others, 2, 3)).otherwise(others)
    return (
        asked.join(per_form, "query_form", "left")
        .withColumn("method", method)
        .select(
            "query",
            F.col("method").isNotNull().alias("matched"),
            "method",
            F.when(F.col("method") == "fuzzy", F.round(chosen["score"], 1)).alias("score"),
            chosen["artist_key"].alias("artist_key"),
            chosen["name"].alias("name"),
            F.transform(
                left_over,
                lambda c: F.struct(
                    c["name"].alias("name"),
                    F.round(c["score"], 1).alias("score"),
                    c["size_band"].alias("size_band"),
                ),
            ).alias("alternatives"),
        )
    )


def map_names(listed: DataFrame, signals: DataFrame) -> DataFrame:
    """Map (name, mbid) rows to tracked entities by key, then by exact match form; never by a
    similar name, since a wrong merge would become a confident wrong answer. Adds
    ``artist_key`` (NULL where untracked) and ``own_key``, the key the row itself would have.

    Distinct (name, mbid) pairs are mapped once, however many rows carry them."""

    blank = F.lit("")
    listed = listed.withColumn("_id", F.coalesce("mbid", blank))
    by_form = one_per(
        signals.withColumn("form", match_form(F.col("name"))),
        ["form"],
        [
            F.col("possible_alias_of").asc_nulls_first(),
            F.col("lastfm_listeners").desc_nulls_last(),
            F.col("artist_key"),
        ],
    ).select("form", F.col("artist_key").alias("_by_name"))
    by_key = signals.select(F.col("artist_key").alias("own_key"), F.col("artist_key").alias("_by_key"))
    mapped = (
        listed.select("name", "_id")
        .distinct()
        .withColumn("own_key", entity_key(F.col("name"), F.col("_id")))
        .withColumn("form", match_form(F.col("name")))
        .join(by_key, "own_key", "left")
        .join(by_form, "form", "left")
        .select("name", "_id", "own_key", F.coalesce("_by_key", "_by_name").alias("artist_key"))
    )
    return listed.join(mapped, ["name", "_id"], "left").drop("_id")
