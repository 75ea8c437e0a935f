"""Where intermediate results live: the shared checkpoint folder the cluster names."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from upswell import folders

_owned: ContextVar[list[str] | None] = ContextVar("staged paths of the run", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``. Unset is accepted on a local master only, where
    this machine is the whole cluster; the folder is made once and kept for the session."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if named:
        if current is None:
            sc.setCheckpointDir(named)
        return named
    if current is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="upswell-"))
        current = sc.getCheckpointDir()
    return current


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder for a landing area or a table written on the way."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame) -> DataFrame:
    """Write a frame that several branches read to the shared folder once, and go on from the
    written table. That cuts its lineage: losing an executor costs no recompute, every branch
    sees the same rows, reads only its columns, and Spark plans joins on the real size."""
    path = scratch_path(df.sparkSession, "staged")
    df.write.parquet(path)
    owned = _owned.get()
    if owned is not None:
        owned.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash rows over all shuffle partitions. For small inputs of steps that do much work per
    row: adaptive execution would fold them into one task by their size."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


@contextmanager
def cleared_after(spark: SparkSession) -> Iterator[None]:
    """Deletes what is staged inside the block when it ends; frames that read it stop working then.
    For runs that write their results themselves. Blocks may be nested, and each thread has its own."""
    paths: list[str] = []
    token = _owned.set(paths)
    try:
        yield
    finally:
        _owned.reset(token)
        for path in paths:
            folders.delete(spark, path)
