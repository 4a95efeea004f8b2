"""Incremental landing: export files are parsed once, when they are new.

    <table>/ledger/batch=<n>/                     path, time and length of the files of batch n; written last
    <table>/data/batch=<n>/ingest_date=<day>/     their lines, parsed into typed columns

``land_new`` lists the export (names only), drops the files that the ledger knows by an anti-join,
parses the others and appends them as one batch. A batch counts once its ledger is written, so a run that
went down half-way is done again under the same number. A file that was rewritten in place (other time or length) is
new, and the lines of its earlier version no longer count.
The day is that of the file's ``ingest_date=`` folder, or else of its last change; predicates on it prune folders.
A day's files are read on their own, so their lines go into its folder without being sent between tasks.
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from . import paths, readers

LEDGER_DDL = "path string, modificationTime timestamp, length bigint"
FILE_KEY = ["path", "modificationTime", "length"]
DAYS_AT_ONCE = 8                            # days of one batch that are written side by side
TASK_BYTES = (4 << 20, 32 << 20)            # bytes of export files that a task takes, least and most


def ledger(spark: SparkSession, table: str) -> DataFrame:
    """(path, modificationTime, length, batch) of all files that have been taken in."""
    folder = f"{table.rstrip('/')}/ledger"
    if not paths.exists(spark, folder):
        return spark.createDataFrame([], f"{LEDGER_DDL}, batch bigint")
    return spark.read.schema(f"{LEDGER_DDL}, batch bigint").parquet(folder)


def new_files(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Files of the export that the ledger does not know. Only names, times and lengths are listed."""
    there = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(*FILE_KEY)
    return there.filter("length > 0").join(ledger(spark, table).select(*FILE_KEY), FILE_KEY, "left_anti")


def day_of(file_path, changed):
    """Day of a file: its ``ingest_date=`` folder, or else its last change."""
    named = F.regexp_extract(file_path, r"/ingest_date=(\d{4}-\d{2}-\d{2})/", 1)
    return F.coalesce(F.try_to_date(named), F.to_date(changed))


def _path_of(uri):
    """A ``_metadata.file_path`` as listings write it: decoded, with one slash after ``file:``."""
    return F.url_decode(F.replace(F.regexp_replace(uri, "^file:/+", "file:/"), F.lit("+"), F.lit("%2B")))


def replaced(spark: SparkSession, table: str) -> DataFrame:
    """(file, batch) of file versions that a later batch has read anew."""
    known = ledger(spark, table).select(F.col("path").alias("file"), "batch")
    newest = known.groupBy("file").agg(F.max("batch").alias("newest"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return known.join(newest, "file").filter("batch < newest").select("file", "batch")


def last_batch(spark: SparkSession, table: str) -> int | None:
    return ledger(spark, table).agg(F.max("batch")).first()[0]


def landed(spark: SparkSession, source: str, table: str) -> DataFrame:
    """The typed table: good lines of all batches in the ledger, with ``ingest_date`` and ``batch``."""
    last = last_batch(spark, table)
    parsed = readers.PARSERS[source](spark.createDataFrame([], "value string, file string, ingest_date date"))
    if last is None:
        return readers.good(parsed).withColumn("batch", F.lit(None).cast("bigint")).drop("file")
    schema = parsed.withColumn("batch", F.lit(0).cast("bigint")).schema
    data = spark.read.schema(schema).parquet(f"{table.rstrip('/')}/data")
    data = readers.good(data.filter(F.col("batch") <= last))
    old = replaced(spark, table)
    if old.limit(1).count():        # most exports only ever add files
        data = data.join(old, ["file", "batch"], "left_anti")
    return data.drop("file")


def _write_day(spark: SparkSession, source: str, files: list[Row], folder: str) -> None:
    """Parse the files of one day into its folder, few files for many small ones."""
    lines = spark.read.text([r["path"] for r in files]).select(
        "value", _path_of(F.col("_metadata.file_path")).alias("file"))
    size, (least, most) = sum(r["length"] for r in files), TASK_BYTES
    tasks = math.ceil(size / min(most, max(least, size / spark.sparkContext.defaultParallelism)))
    readers.PARSERS[source](lines).coalesce(tasks).write.option("compression", "zstd").parquet(folder)


def land_new(spark: SparkSession, source: str, path: str, table: str, reject_path: str | None = None) -> DataFrame:
    """Take in the new files of an export and return the typed table.

    Lines that are no JSON object stay in the table, marked, and those of this batch are put
    to ``reject_path``, whole. Without new files nothing is read or written.
    """
    root = table.rstrip("/")
    # names of the files that have come since the last run
    fresh = new_files(spark, path, root).withColumn("day", day_of(F.col("path"), F.col("modificationTime"))).collect()
    if fresh:
        batch = (last_batch(spark, root) or 0) + 1
        folder = f"{root}/data/batch={batch}"
        paths.delete(spark, folder)         # what a run that went down has left
        days: dict = {}
        for r in fresh:
            days.setdefault(r["day"], []).append(r)
        with ThreadPoolExecutor(min(len(days), DAYS_AT_ONCE)) as pool:
            list(pool.map(inheritable_thread_target(spark)(lambda day: _write_day(
                spark, source, days[day], f"{folder}/ingest_date={day}")), days))
        if reject_path:
            bad = readers.rejects(spark.read.parquet(folder))
            if bad.limit(1).count():
                bad.write.mode("overwrite").parquet(reject_path)
        spark.createDataFrame([tuple(r[k] for k in FILE_KEY) for r in fresh], LEDGER_DDL).write.mode("overwrite").parquet(
            f"{root}/ledger/batch={batch}")
    return landed(spark, source, root)
