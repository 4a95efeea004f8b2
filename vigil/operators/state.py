"""Keyed delivery state: ``feed STRING, item_id STRING, seen_at TIMESTAMP``.

One row per delivered key, so state joins and scales like any other table
(never a map column, never collected to the driver).

A commit writes the whole state of the feeds it names as Parquet, the marks last::

    keys/v=<version>/feed=<feed>/     the feed's keys as of this version, optionally in hash buckets
    marks/v=<version>/feed=<feed>/    its one row of marks, written once the keys are whole

A version counts for a feed once its marks row is there, so keys and marks move together and
a torn commit is not seen. The newest one is read; a few older ones stay for readers at work.
Keys without any marks, or marks whose keys are gone, raise ``StateDamaged``.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from ..functions import exprs as X
from ..session import no_rows, shuffles_dropped
from ..sources import paths
from .ordinal import with_ordinal

STATE_SCHEMA = StructType([
    StructField("feed", StringType(), False),
    StructField("item_id", StringType(), True),
    StructField("seen_at", TimestampType(), True),
])

WATERMARK_SCHEMA = StructType([
    StructField("feed", StringType(), False),
    StructField("last_timestamp", LongType(), True),
    StructField("last_full_scan", LongType(), True),
    StructField("last_cleanup", LongType(), True),
])

# ---- fixed values: reference defaults -------------------------------------------
DEFAULT_RETENTION_DAYS = 7
# -----------------------------------------------------------------------------------

DEFAULT_MAX_IDS = 0         # no cap: a trimmed key would be sent again, so a cap is asked for by name
KEEP_VERSIONS = 3           # snapshots of a feed that stay


def normalize(state: DataFrame) -> DataFrame:
    """Keys are compared as strings on both sides (``str(item_id)``)."""
    return state.select(F.col("feed").cast("string").alias("feed"),
                        F.col("item_id").cast("string").alias("item_id"),
                        F.col("seen_at").cast("timestamp").alias("seen_at"))


def empty_state(spark: SparkSession) -> DataFrame:
    return no_rows(spark, STATE_SCHEMA)


def cutoff_ts(now: int, retention_days: int) -> Column:
    return F.timestamp_seconds(F.lit(X.retention_cutoff(now, retention_days)))


def active(state: DataFrame, now: int, retention_days: int = DEFAULT_RETENTION_DAYS) -> DataFrame:
    """Non-expired entries: ``seen_at > now - retention`` (an entry at the cutoff is expired)."""
    return state.filter(F.col("seen_at") > cutoff_ts(now, retention_days))


def active_keys(state: DataFrame, now: int, retention_days: int = DEFAULT_RETENTION_DAYS,
                feed: str | None = None) -> DataFrame:
    s = active(state, now, retention_days)
    if feed is not None:
        s = s.filter(F.col("feed") == feed)
    return s.select("feed", "item_id")


def expire(state: DataFrame, now: int, retention_days: int = DEFAULT_RETENTION_DAYS) -> DataFrame:
    return active(state, now, retention_days)


def trim_newest(state: DataFrame, max_ids: int = DEFAULT_MAX_IDS) -> DataFrame:
    """Keep the ``max_ids`` newest keys per feed (ties broken by key); 0 keeps all.

    Keys are counted per feed (one row per feed reaches the driver); feeds within the
    cap pass untouched, the others are ranked with the distributed ordinal, so no
    feed's state is sorted inside one task.
    """
    if not max_ids:
        return state
    # the count, the ranking and the write then read one copy instead of running the lineage again
    state = state.checkpoint(eager=True)
    over = [r["feed"] for r in state.groupBy("feed").count().filter(F.col("count") > max_ids).collect()]
    if not over:
        return state
    keep = state.filter(~F.col("feed").isin(*over))
    big = state.filter(F.col("feed").isin(*over))
    ranked = with_ordinal(big, [F.col("seen_at").desc(), F.col("item_id").asc()], by=["feed"], name="_rk")
    return keep.unionByName(ranked.filter(F.col("_rk") <= max_ids).select(*state.columns))


def upsert(state: DataFrame, new: DataFrame) -> DataFrame:
    """Merge new sightings: newest ``seen_at`` per ``(feed, item_id)``.

    A hash aggregate with map-side partial merge, so a key repeated many times is
    combined before the shuffle.
    """
    both = normalize(state).unionByName(normalize(new))
    return both.groupBy("feed", "item_id").agg(F.max("seen_at").alias("seen_at"))


def unrenewed(state: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of one feed's state that ``new`` does not replace; a state in hash buckets stays where it is."""
    return state.join(new.select(F.col("item_id").cast("string").alias("item_id")), "item_id", "left_anti").select(
        *state.columns)


def stamp(keys: DataFrame, order_cols: Sequence[str | Column], commit_us: int, feed_col: str = "feed",
          key_col: str = "item_id") -> DataFrame:
    """Order-preserving microsecond stamps: the i-th key of a feed's batch gets ``commit + i`` us."""
    ranked = with_ordinal(keys, order_cols, by=[feed_col], name="_rn")
    seen = F.timestamp_micros(F.lit(int(commit_us)) + F.col("_rn") - F.lit(1))
    return ranked.select(F.col(feed_col).alias("feed"), F.col(key_col).cast("string").alias("item_id"),
                         seen.alias("seen_at"))


def flush(state: DataFrame, now: int, retention_days: int = DEFAULT_RETENTION_DAYS,
          max_ids: int = DEFAULT_MAX_IDS) -> DataFrame:
    """Retention, then the cap when one is asked for."""
    return trim_newest(expire(state, now, retention_days), max_ids)


def sweep(state: DataFrame, now: int, retention_days: int = DEFAULT_RETENTION_DAYS,
          max_ids: int = DEFAULT_MAX_IDS) -> DataFrame:
    """Cleanup over all feeds; returns active ids per feed."""
    return flush(state, now, retention_days, max_ids).groupBy("feed").agg(
        F.count(F.lit(1)).alias("active_ids"))


def clear(state: DataFrame, feed: str) -> DataFrame:
    return state.filter(F.col("feed") != F.lit(feed))


def feeds(state: DataFrame) -> DataFrame:
    return state.select("feed").distinct()


def stats(state: DataFrame, marks: DataFrame, now: int, retention_days: int = DEFAULT_RETENTION_DAYS) -> DataFrame:
    """Per-feed totals joined to the feed's scalar marks."""
    cut = cutoff_ts(now, retention_days)
    agg = state.groupBy("feed").agg(
        F.count(F.lit(1)).alias("total_tracked"),
        F.sum(F.when(F.col("seen_at") > cut, 1).otherwise(0)).cast("bigint").alias("active_ids"),
        X.epoch_micros(F.max("seen_at")).alias("newest_us"),
    )
    return agg.join(marks.select("feed", "last_timestamp", "last_cleanup"), "feed", "left")


def migrate_legacy(legacy: DataFrame, now: int) -> DataFrame:
    """Legacy documents (``feed, processed_ids[]``) -> state rows, every id stamped ``now``."""
    return (legacy.select("feed", F.explode("processed_ids").alias("item_id"))
            .select("feed", F.col("item_id").cast("string").alias("item_id"),
                    F.timestamp_seconds(F.lit(int(now))).alias("seen_at")))


# ---- snapshots ------------------------------------------------------------------------

class StateDamaged(RuntimeError):
    """Snapshots and marks of a store do not fit together."""


FEED_NAME = re.compile(r"[A-Za-z0-9_.-]+")
MARKS = ("last_timestamp", "last_full_scan", "last_cleanup")
STREAM_MARKS = ("last_batch", "pending")
MORE_MARKS = (*STREAM_MARKS, "mark_key")
MARKS_DDL = ("last_timestamp bigint, last_full_scan bigint, last_cleanup bigint, last_batch bigint, pending string, "
             "mark_key string, keys_v bigint, buckets int")
KEYS_DDL = "item_id string, seen_at timestamp"


def _root(base: str) -> str:
    return base.rstrip("/")


def _heads(spark: SparkSession, base: str, upto: int | None = None) -> dict[str, dict]:
    """{feed: its newest committed marks row up to a version}; a row per feed and kept version is read."""
    root = _root(base)
    if not paths.exists(spark, f"{root}/marks"):
        if paths.exists(spark, f"{root}/keys"):
            raise StateDamaged(f"{root}: snapshots without marks")
        return {}
    rows = spark.read.schema(f"{MARKS_DDL}, v bigint, feed string").parquet(f"{root}/marks")
    rows = rows if upto is None else rows.filter(F.col("v") <= int(upto))
    newest = rows.groupBy("feed").agg(F.max_by(F.struct("*"), "v").alias("m")).select("m.*").collect()
    return {r["feed"]: r.asDict() for r in newest}


def _folder(root: str, head: dict) -> str:
    return f"{root}/keys/v={head['keys_v']}/feed={head['feed']}"


def _bucketed_table(spark: SparkSession, folder: str, buckets: int) -> DataFrame:
    """Files that ``bucketBy`` wrote, as a table that knows its buckets (the catalog entry goes, the files stay)."""
    name = f"vigil_state_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {name} ({KEYS_DDL}) USING parquet CLUSTERED BY (item_id) SORTED BY (item_id) "
              f"INTO {int(buckets)} BUCKETS LOCATION '{folder}'")
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def _keys(spark: SparkSession, root: str, head: dict) -> DataFrame:
    folder = _folder(root, head)
    if not paths.exists(spark, folder):
        raise StateDamaged(f"{folder}: committed but gone")
    keys = _bucketed_table(spark, folder, head["buckets"]) if head["buckets"] else (
        spark.read.schema(KEYS_DDL).parquet(folder))
    return keys.select(F.lit(head["feed"]).alias("feed"), "item_id", "seen_at")


def _write_keys(parts: Sequence[DataFrame], root: str, version: int, feeds: Sequence[str], buckets: int) -> None:
    spark = parts[0].sparkSession
    for feed in feeds:
        paths.delete(spark, f"{root}/keys/v={version}/feed={feed}")
    if not buckets:
        for rows in parts:
            with shuffles_dropped(spark):
                rows.write.mode("append").option("compression", "zstd").partitionBy("feed").parquet(
                    f"{root}/keys/v={version}")         # one write for all feeds
        return
    for feed in feeds:
        name = f"vigil_state_{uuid.uuid4().hex}"
        for rows in parts:
            # clustered, so that a task writes one bucket; rows that come in these buckets are not moved for it
            (rows.filter(F.col("feed") == feed).select("item_id", "seen_at").repartition(int(buckets), "item_id").write
             .bucketBy(int(buckets), "item_id").sortBy("item_id").option("path", f"{root}/keys/v={version}/feed={feed}")
             .option("compression", "zstd").format("parquet").mode("append").saveAsTable(name))
        spark.sql(f"DROP TABLE {name}")


def commit(state: DataFrame, base: str, version: int, marks: DataFrame | None = None,
           feeds: Sequence[str] | None = None, buckets: int = 0, stream: dict | None = None,
           added: DataFrame | None = None) -> str:
    """Write ``version`` of the named feeds, each as a whole (all feeds of the store when none are named).

    Re-running a version rewrites it, so it is idempotent by version. ``marks`` are a row per
    feed; a feed without one keeps the marks it had. ``stream`` (``last_batch``, ``pending``, ``mark_key``) is set
    for the named feeds. With ``buckets`` the keys are written in hash buckets of ``item_id``, which an anti-join
    reads without moving them. ``added`` holds further rows of other keys, written beside ``state``.
    """
    spark = state.sparkSession
    root, version = _root(base), int(version)
    heads = _heads(spark, base, version - 1)
    given = {r["feed"]: {k: r[k] for k in MARKS if k in r.asDict()} for r in marks.collect()} if marks is not None else {}
    rows = normalize(state)
    if feeds is None:
        feeds = sorted({*heads, *given, *(r["feed"] for r in rows.select("feed").distinct().collect())})
    else:
        rows = rows.filter(F.col("feed").isin(*feeds))
    for feed in feeds:
        if not FEED_NAME.fullmatch(feed):
            raise ValueError(f"feed name {feed!r} can't name a folder")
        paths.delete(spark, f"{root}/marks/v={version}/feed={feed}")        # until the new keys are whole
    more = [normalize(added).filter(F.col("feed").isin(*feeds))] if added is not None else []
    _write_keys([rows, *more], root, version, feeds, buckets)
    keys_v = {f: version if paths.exists(spark, f"{root}/keys/v={version}/feed={f}") else None for f in feeds}
    _write_marks(spark, root, version, heads, {f: given.get(f, {}) | (stream or {}) | {
        "keys_v": keys_v[f], "buckets": int(buckets)} for f in feeds})
    return f"{root}/keys/v={version}"


def commit_marks(spark: SparkSession, base: str, version: int, marks: DataFrame, stream: dict | None = None) -> None:
    """A version that only moves marks: the keys stay those of the version before."""
    root, version = _root(base), int(version)
    given = {r["feed"]: {k: r[k] for k in MARKS if k in r.asDict()} for r in marks.collect()}     # a row per feed
    for feed in given:
        paths.delete(spark, f"{root}/marks/v={version}/feed={feed}")
        paths.delete(spark, f"{root}/keys/v={version}/feed={feed}")
    _write_marks(spark, root, version, _heads(spark, base, version - 1), {f: m | (stream or {}) for f, m in given.items()})


def _write_marks(spark: SparkSession, root: str, version: int, heads: dict[str, dict], changed: dict[str, dict]) -> None:
    names = (*MARKS, *MORE_MARKS, "keys_v", "buckets")
    rows = [tuple(({k: heads.get(feed, {}).get(k) for k in names} | m)[k] for k in names) + (feed,)
            for feed, m in changed.items()]
    if rows:
        frame = spark.createDataFrame(rows, f"{MARKS_DDL}, feed string").coalesce(1)
        frame.write.mode("append").partitionBy("feed").parquet(f"{root}/marks/v={version}")
        _drop_old(spark, root, version, list(changed))


def _drop_old(spark: SparkSession, root: str, version: int, feeds: Sequence[str]) -> None:
    """Only the newest ``KEEP_VERSIONS`` snapshots of a feed stay (readers of an older one finish on theirs)."""
    rows = spark.read.schema(f"{MARKS_DDL}, v bigint, feed string").parquet(f"{root}/marks").filter(
        F.col("feed").isin(*feeds) & (F.col("v") <= version)).select("feed", "v", "keys_v").collect()
    for feed in feeds:
        mine = sorted((r["v"], r["keys_v"]) for r in rows if r["feed"] == feed)
        needed = {k for _, k in mine[-KEEP_VERSIONS:]}
        for v, keys_v in mine[:-KEEP_VERSIONS]:
            paths.delete(spark, f"{root}/marks/v={v}/feed={feed}")
            if keys_v is not None and keys_v not in needed:
                paths.delete(spark, f"{root}/keys/v={keys_v}/feed={feed}")


def current_version(spark: SparkSession, base: str, feed: str | None = None) -> int | None:
    """Newest committed version of the store, or of one feed."""
    found = [m["v"] for f, m in _heads(spark, base).items() if feed in (None, f)]
    return max(found) if found else None


def load(spark: SparkSession, base: str, feed: str | None = None, version: int | None = None) -> DataFrame:
    """State of all feeds or of one; empty when nothing was committed. Damaged state fails."""
    parts = [_keys(spark, _root(base), m) for f, m in sorted(_heads(spark, base, version).items())
             if feed in (None, f) and m["keys_v"] is not None]
    return reduce(DataFrame.unionByName, parts) if parts else empty_state(spark)


def load_version(spark: SparkSession, base: str, version: int, feed: str | None = None) -> DataFrame:
    """State as of ``version``; a version above 0 that was never committed is an error.

    A replayed run reads the same state again, so its output and its commit
    are those of the first attempt.
    """
    if version > 0 and not any(feed in (None, f) for f in _heads(spark, base, version)):
        raise StateDamaged(f"{_root(base)}: nothing was committed up to version {version}")
    return load(spark, base, feed, int(version))


def load_marks(spark: SparkSession, base: str, version: int | None = None) -> DataFrame:
    """A row of marks per committed feed."""
    rows = [(f, *[m[k] for k in MARKS]) for f, m in sorted(_heads(spark, base, version).items())]
    return spark.createDataFrame(rows, WATERMARK_SCHEMA)


def load_marks_version(spark: SparkSession, base: str, version: int) -> DataFrame:
    return load_marks(spark, base, int(version))


def stream_marks(spark: SparkSession, base: str, feed: str) -> dict:
    """``last_batch``: newest micro-batch in the state; ``pending``: folder of its undelivered events."""
    head = _heads(spark, base).get(feed, {})
    return {k: head.get(k) for k in STREAM_MARKS}


def mark_key(spark: SparkSession, base: str, feed: str, version: int | None = None) -> str | None:
    """Key of the compound mark (``last_timestamp``, key) that an ordered run left."""
    return _heads(spark, base, version).get(feed, {}).get("mark_key")


def commit_clear(spark: SparkSession, base: str, feed: str) -> int:
    """Forget a feed's keys and marks; other feeds are not touched."""
    version = (current_version(spark, base) or 0) + 1
    gone = spark.createDataFrame([(feed, None, None, None)], WATERMARK_SCHEMA)
    commit(empty_state(spark), base, version, marks=gone, feeds=[feed], stream={"mark_key": None})
    return version


def commit_sweep(spark: SparkSession, base: str, now: int, retention_days: int = DEFAULT_RETENTION_DAYS,
                 max_ids: int = DEFAULT_MAX_IDS) -> DataFrame:
    """Retention and cap over all feeds, committed; (feed, active_ids) of what is left."""
    names = sorted(_heads(spark, base))
    version = (current_version(spark, base) or 0) + 1
    marks = load_marks(spark, base).withColumn("last_cleanup", F.lit(int(now)).cast("bigint"))
    commit(flush(load(spark, base), now, retention_days, max_ids), base, version, marks=marks, feeds=names)
    return load(spark, base).groupBy("feed").agg(F.count(F.lit(1)).alias("active_ids"))


def commit_legacy(legacy: DataFrame, base: str, now: int) -> int:
    """Take over legacy documents: ids stamped ``now`` and, where they have one, ``last_timestamp``."""
    spark = legacy.sparkSession
    version = (current_version(spark, base) or 0) + 1
    marks = None
    if "last_timestamp" in legacy.columns:
        marks = legacy.groupBy("feed").agg(F.max("last_timestamp").cast("bigint").alias("last_timestamp"))
    moved = migrate_legacy(legacy, now)
    names = [r["feed"] for r in legacy.select("feed").distinct().collect()]      # one row per feed
    commit(upsert(load(spark, base).filter(F.col("feed").isin(*names)), moved), base, version, marks=marks, feeds=names)
    return version
