"""Count and byte batching of ordered events.

Exact parity numbering (what the reference's buffers would produce) is computed
with the distributed ordinal of ``ordinal.py``; the byte packing then works
inside each count batch, a group bounded by ``batch_size``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordinal import with_ordinal

# ---- fixed values: reference defaults -------------------------------------------
DEFAULT_BATCH_SIZE = 5000          # events per buffered batch
DEFAULT_MAX_BYTES = 1048576        # 1 MiB per delivered payload
# -----------------------------------------------------------------------------------


def count_batches(df: DataFrame, order_cols: Sequence[str | Column], by: Sequence[str] = (),
                  batch_size: int = DEFAULT_BATCH_SIZE, name: str = "batch_no",
                  position: str = "pos") -> DataFrame:
    """``batch_no = floor((row_number - 1) / batch_size)`` per ``by`` group."""
    ranked = with_ordinal(df, order_cols, by=by, name=position)
    return ranked.withColumn(name, F.floor((F.col(position) - 1) / F.lit(int(batch_size))).cast("bigint"))


def greedy_starts(lengths: Column, max_bytes: int) -> Column:
    """Start indexes of greedy byte batches over an ordered length array.

    A batch closes when ``current + next > max``; an event longer than the limit
    sits alone. Only boundaries are appended, so the fold is linear in practice.
    """
    init = F.struct(F.lit(0).alias("i"), F.lit(0).cast("bigint").alias("cur"),
                    F.array(F.lit(0)).alias("starts"))

    def step(acc, x):
        close = (acc["i"] > 0) & (acc["cur"] + x > F.lit(int(max_bytes)))
        return F.when(close, F.struct((acc["i"] + 1).alias("i"), x.alias("cur"),
                                      F.concat(acc["starts"], F.array(acc["i"])).alias("starts"))
                      ).otherwise(F.struct((acc["i"] + 1).alias("i"), (acc["cur"] + x).alias("cur"),
                                           acc["starts"].alias("starts")))

    return F.aggregate(lengths, init, step)["starts"]


def batch_ids_from_starts(starts: Column, n: Column) -> Column:
    """Per-element batch number array from sorted batch start indexes."""
    return F.flatten(F.transform(
        starts, lambda s, k: F.array_repeat(k, (F.coalesce(F.get(starts, k + 1), n) - s).cast("int"))))


def byte_batches(df: DataFrame, length_col: str, order_cols: Sequence[str | Column], by: Sequence[str] = (),
                 batch_size: int = DEFAULT_BATCH_SIZE, max_bytes: int = DEFAULT_MAX_BYTES,
                 carry: Sequence[str] = ()) -> DataFrame:
    """Greedy byte batching inside count batches.

    Returns ``by..., batch_no, pos, byte_batch`` plus ``carry`` columns. Each group
    holds at most ``batch_size`` rows, so the collected arrays are bounded.
    """
    cb = count_batches(df, order_cols, by=by, batch_size=batch_size)
    fields = ["pos", length_col] + [c for c in carry if c not in (length_col, "pos")]
    grouped = cb.groupBy(*by, "batch_no").agg(
        F.sort_array(F.collect_list(F.struct(*[F.col(c) for c in fields]))).alias("items"))
    lens = F.transform("items", lambda it: it[length_col].cast("bigint"))
    starts = greedy_starts(lens, max_bytes)
    with_ids = grouped.select(*by, "batch_no", "items",
                              batch_ids_from_starts(starts, F.size("items")).alias("bb"))
    z = with_ids.select(*by, "batch_no", F.explode(F.arrays_zip("items", "bb")).alias("z"))
    return z.select(*by, "batch_no", *[F.col(f"z.items.{c}").alias(c) for c in fields],
                    F.col("z.bb").cast("bigint").alias("byte_batch"))
