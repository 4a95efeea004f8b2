"""High-water marks: data-driven, clock-driven, and last-scan based."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _with_old(old_mark: DataFrame, rows: DataFrame, by: str, value: str) -> DataFrame:
    """Old marks and new rows side by side in one aggregate (a tagged union, no join)."""
    olds = old_mark.select(F.col(by), F.col("last_timestamp").cast("bigint").alias("_old"),
                           F.lit(None).cast("bigint").alias("_v"), F.lit(1).alias("_has_old"))
    news = rows.select(F.col(by), F.lit(None).cast("bigint").alias("_old"), F.col(value).cast("bigint").alias("_v"),
                       F.lit(0).alias("_has_old"))
    return olds.unionByName(news)


def _held(union: DataFrame, held: DataFrame | None, by: str) -> DataFrame:
    """Adds the feeds whose mark must stay, as further tagged rows."""
    u = union.withColumn("_stay", F.lit(None).cast("boolean"))
    if held is None:
        return u
    return u.unionByName(held.select(F.col(by), F.lit(None).cast("bigint").alias("_old"), F.lit(None).cast(
        "bigint").alias("_v"), F.lit(0).alias("_has_old"), F.col("held").alias("_stay")))


def data_mark(emitted: DataFrame, old_mark: DataFrame, epoch_col: str = "updated_epoch",
              by: str = "feed", held: DataFrame | None = None) -> DataFrame:
    """``max(epoch)`` over emitted rows per feed, kept only when above the old mark.

    ``held`` (feed, held bool) keeps the old mark of feeds that have undelivered or
    capped events: a mark never passes an event that was not sent. Sent ones are in
    the state by then, so the next run skips them.
    """
    g = _held(_with_old(old_mark, emitted, by, epoch_col), held, by).groupBy(by).agg(
        F.max("_old").alias("old_mark"), F.max("_v").alias("_max"), F.max("_has_old").alias("_known"),
        F.max(F.col("_stay").cast("int")).alias("_stay"))
    old = F.coalesce("old_mark", F.lit(0))
    moved = F.greatest(old, F.coalesce("_max", F.lit(0)))
    return g.filter(F.col("_known") == 1).select(
        by, "old_mark", F.when(F.coalesce("_stay", F.lit(0)) == 1, old).otherwise(moved).cast("bigint").alias("new_mark"))


def clock_mark(emitted: DataFrame, old_mark: DataFrame, run_start: int, by: str = "feed",
               held: DataFrame | None = None) -> DataFrame:
    """Run start when the feed emitted >= 1 event or had no mark, else unchanged.

    ``held`` (feed, held bool) keeps the old mark of feeds that have undelivered or
    capped events, so they are fetched again.
    """
    rows = emitted.select(by, F.lit(1).alias("_one"))
    g = _held(_with_old(old_mark, rows, by, "_one"), held, by).groupBy(by).agg(
        F.max("_old").alias("old_mark"), F.count("_v").alias("n_events"),
        F.max("_has_old").alias("_known"), F.max(F.col("_stay").cast("int")).alias("_stay"))
    old = F.coalesce(F.col("old_mark"), F.lit(0))
    stay = F.coalesce(F.col("_stay"), F.lit(0)) == 1
    new = F.when(~stay & ((F.col("n_events") > 0) | (old == 0)), F.lit(int(run_start))).otherwise(old)
    return g.filter(F.col("_known") == 1).select(by, "old_mark", F.col("n_events").cast("bigint").alias("n_events"),
                                                 new.cast("bigint").alias("new_mark"))


def scan_mark(scans: DataFrame, old: int, modified_col: str = "modified_epoch", held: bool = False) -> DataFrame:
    """Newest qualifying scan time (``max``, not list order), never below the old mark; the old one when held."""
    top = F.lit(None).cast("bigint") if held else F.max(modified_col)
    return scans.agg(F.greatest(F.lit(int(old)), F.coalesce(top, F.lit(0))).cast("bigint").alias("new_mark"))


def keyset_mark(sent: DataFrame, failed_keys: DataFrame | None, epoch_col: str, old: tuple[int, str | None],
                order_key: str = "_order_key") -> tuple[int, str | None]:
    """The compound mark (epoch, key) that an ordered run leaves: its last event before the first undelivered one.

    ``failed_keys`` (item_id) names the undelivered events, None when there are none; then events without a
    key count as undelivered too, for no one can tell. The mark never goes back, and times of 0 or less make none.
    """
    pair = F.struct(F.coalesce(F.col(epoch_col).cast("bigint"), F.lit(-(1 << 63))).alias("e"), F.col(order_key).alias("k"))
    pairs = sent.select(pair.alias("p"), F.col("item_id").cast("string").alias("item_id"))
    if failed_keys is not None:
        unsent = pairs.join(failed_keys, "item_id", "left_semi").select("p").unionByName(
            pairs.filter("item_id IS NULL").select("p"))
        first = unsent.agg(F.min("p")).first()[0]       # one-row scalar
        if first is not None:
            pairs = pairs.filter(F.col("p") < F.struct(F.lit(first["e"]).alias("e"), F.lit(first["k"]).alias("k")))
    top = pairs.agg(F.max("p")).first()[0]      # one-row scalar
    if top is None or top["e"] <= 0 or (top["e"], top["k"].encode()) <= (old[0], (old[1] or "").encode()):
        return old
    return int(top["e"]), top["k"]


def next_mark(rule: str, feed: str, events: DataFrame, delivered: DataFrame, old: int, now: int,
              epoch_col: str | None, held: bool) -> int:
    """The mark one run leaves, by its feed's rule (data, clock, scans, none); one row reaches the driver."""
    spark = events.sparkSession
    old_row = spark.createDataFrame([(feed, int(old))], "feed string, last_timestamp bigint")
    held_row = spark.createDataFrame([(feed, bool(held))], "feed string, held boolean")
    if rule == "data" and epoch_col:
        rows = delivered.select(F.lit(feed).alias("feed"), F.col(epoch_col))
        return int(data_mark(rows, old_row, epoch_col, held=held_row).first()["new_mark"])
    if rule == "clock":
        rows = events.select(F.lit(feed).alias("feed")).limit(1)       # the rule asks for any event, not for all
        return int(clock_mark(rows, old_row, now, held=held_row).first()["new_mark"])
    if rule == "scans" and epoch_col:
        return int(scan_mark(delivered, old, epoch_col, held).first()["new_mark"])
    return int(old)
