"""The same landing folders as a file stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from upswell.sources.landing import read_landed, replace_days


def follow_landing(
    spark: SparkSession, root: str, dataset: str, path: str, progress: str
) -> StreamingQuery:
    """Drain every file that landed since the last run into the raw table, then stop.

    The stream only tells which days have new files; each of those days is then read whole and
    replaced, so files that came earlier on a day are kept and a repeated batch changes nothing.
    The day list is as long as the calendar, not the data."""
    lines = (
        spark.readStream.schema("value STRING, dt DATE")
        .option("basePath", f"{root}/{dataset}")
        .text(f"{root}/{dataset}")
    )

    def load(batch: DataFrame, batch_id: int) -> None:
        days = [str(r.dt) for r in batch.select("dt").distinct().collect()]
        if days:
            replace_days(read_landed(batch.sparkSession, root, dataset, sorted(days)), path, days=sorted(days))

    return (
        lines.select("dt")
        .writeStream.option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .foreachBatch(load)
        .start()
    )
