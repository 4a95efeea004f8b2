"""Audit of late arrivals: records that landed at or below a mark and were never delivered.

A run under a mark looks only at what lies above it. The audit anti-joins the keys at or below
the mark with the state and counts them by how far below they lie; from the counts follows the lateness
(``--lateness`` of a run) that would have caught a wanted share of them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import dedup


def edge(late_s: Column) -> Column:
    """Smallest power of two above ``late_s``: 64 buckets at most, whatever the times."""
    return F.when(late_s <= 0, F.lit(1).cast("bigint")).otherwise(F.call_function(
        "shiftleft", F.lit(1).cast("bigint"), F.length(F.bin(late_s))))


def undelivered(rows: DataFrame, seen: DataFrame, epoch_col: str, mark: int) -> DataFrame:
    """(item_id, late_s): keys at or below the mark that ``seen`` lacks, by their newest record there.

    Null keys and null times are left out: neither can be found late. A key with a record above the mark
    is delivered by the next run and is not late."""
    newest = rows.filter(F.col("item_id").isNotNull()).groupBy(F.col("item_id").cast("string").alias("item_id")).agg(
        F.max(F.col(epoch_col).cast("bigint")).alias("_at"))       # combined map-side, before any join
    below = newest.filter(F.col("_at") <= F.lit(int(mark)))
    return dedup.new_only(below, seen).select("item_id", (F.lit(int(mark)) - F.col("_at")).alias("late_s"))


def histogram(late: DataFrame) -> DataFrame:
    """(edge_s, keys, share): keys by bucket of lateness (``late_s < edge_s``), and the share up to it."""
    counts = late.groupBy(edge(F.col("late_s")).alias("edge_s")).agg(F.count(F.lit(1)).alias("keys"))
    upto = Window.orderBy("edge_s").rowsBetween(Window.unboundedPreceding, 0)     # 64 rows at most
    return counts.select("edge_s", "keys", (F.sum("keys").over(upto) / F.sum("keys").over(Window.partitionBy())).alias("share"))


def covering(hist: DataFrame, share: float) -> int:
    """Lateness in seconds that covers ``share`` of the late keys; 0 when there are none."""
    if not 0 < share <= 1 or math.isnan(share):
        raise ValueError(f"a share lies above 0 and at most at 1, not {share}")
    row = hist.filter(F.col("share") >= F.lit(float(share))).agg(F.min("edge_s")).first()     # one-row scalar
    return int(row[0] or 0)
