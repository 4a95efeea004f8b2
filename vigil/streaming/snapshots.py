"""Snapshots that arrive in many files: staged by micro-batch, compared once they are complete.

An export lies in a folder ``snapshot=<id>/`` (ids grow in time order, as text) beside a file
``manifest.json`` with one line ``{"records": n}``, which may come first, last or in between. A snapshot is complete
when as many lines as its manifest says have been staged. Until then no key can be missed for lines
that are still on their way. Of several complete snapshots the newest is compared; older ones that
were never compared are superseded.

    <staged>/batch=<n>/snapshot=<id>/     lines of a micro-batch; a replay rewrites its own folder
    <compared>/snapshot=<id>/             one row once the snapshot's events were handed over
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import paths

STAGED_DDL = "value string, is_manifest boolean, batch bigint, snapshot string"


def stage(batch: DataFrame, staged: str, batch_id: int) -> None:
    """Keep a micro-batch of (value, file) lines; blank lines are none."""
    rows = batch.filter(F.trim("value") != "").select(
        "value", F.col("file").rlike("/manifest[.]json$").alias("is_manifest"),
        F.regexp_extract("file", "/snapshot=([^/]+)/", 1).alias("snapshot"))
    rows.filter("snapshot != ''").write.mode("overwrite").partitionBy("snapshot").parquet(f"{staged}/batch={batch_id}")


def _rows(spark: SparkSession, staged: str, upto: int) -> DataFrame:
    return spark.read.schema(STAGED_DDL).parquet(staged).filter(F.col("batch") <= upto)


def progress(spark: SparkSession, staged: str, upto: int) -> DataFrame:
    """(snapshot, expected, arrived) of all staged snapshots; ``expected`` is null without a manifest."""
    rows = _rows(spark, staged, upto)
    # the lines themselves are read of manifests only
    arrived = rows.select("snapshot", F.lit(None).cast("bigint").alias("expected"), (~F.col("is_manifest")).alias("line"))
    told = rows.filter("is_manifest").select("snapshot", F.get_json_object("value", "$.records").cast("bigint"), F.lit(False))
    return arrived.union(told).groupBy("snapshot").agg(F.max("expected").alias("expected"), F.count_if("line").alias("arrived"))


def newest_complete(spark: SparkSession, staged: str, compared: str, upto: int) -> str | None:
    """The newest complete snapshot that is newer than the last one compared."""
    done = progress(spark, staged, upto).filter(F.col("arrived") >= F.col("expected"))
    last = max((n.partition("=")[2] for n in paths.names(spark, compared) if n.startswith("snapshot=")), default="")
    return done.filter(F.col("snapshot") > last).agg(F.max("snapshot")).first()[0]


def lines_of(spark: SparkSession, staged: str, snapshot: str, upto: int) -> DataFrame:
    return _rows(spark, staged, upto).filter((F.col("snapshot") == snapshot) & ~F.col("is_manifest")).select("value")


def settle(spark: SparkSession, staged: str, compared: str, snapshot: str) -> None:
    """Note that a snapshot was compared, then drop the lines of it and of older ones."""
    spark.range(1).write.mode("overwrite").parquet(f"{compared}/snapshot={snapshot}")
    for batch in paths.names(spark, staged):
        for name in paths.names(spark, f"{staged}/{batch}") if batch.startswith("batch=") else []:
            if name.startswith("snapshot=") and name.partition("=")[2] <= snapshot:
                paths.delete(spark, f"{staged}/{batch}/{name}")
