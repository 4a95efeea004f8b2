"""Cross-run and in-run de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shuffles_dropped


def new_only(events: DataFrame, seen_keys: DataFrame, key_col: str = "item_id") -> DataFrame:
    """Drop an event iff its key is among ``seen_keys.item_id`` (non-expired state).

    ``left_anti`` keeps events whose key is null, as the reference re-sends them.
    Both sides compare the string form of the key.
    """
    # state holds one row per key already (upsert groups by key), so no distinct here
    seen = seen_keys.select(F.col("item_id").cast("string").alias("_seen_id"))
    return events.join(seen, F.col(key_col).cast("string") == F.col("_seen_id"), "left_anti")


def met_keys(events: DataFrame, seen_keys: DataFrame, folder: str, key_col: str = "item_id") -> DataFrame:
    """Those of ``seen_keys`` that ``events`` hold, written to ``folder``; ``new_only`` needs no others.

    Keys only are matched here. The few that a run meets again are then joined by broadcast, so that the records
    themselves are not sent between tasks for it.
    """
    keys = events.select(F.col(key_col).cast("string").alias("item_id"))
    with shuffles_dropped(events.sparkSession):
        seen_keys.select(F.col("item_id").cast("string").alias("item_id")).join(keys, "item_id", "left_semi").write.mode(
            "overwrite").parquet(folder)
    return events.sparkSession.read.schema("item_id string").parquet(folder)


def first_per_key(df: DataFrame, key_col: str, order_cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """First occurrence of each key in ``order_cols`` order.

    ``min(struct(order..., keep...))`` is a hash aggregate with a map-side partial
    step: a key repeated across a third of the rows is reduced inside every map
    task before the shuffle, unlike a ``row_number`` window.
    """
    fields = list(order_cols) + [c for c in keep if c not in order_cols]
    best = df.groupBy(key_col).agg(F.min(F.struct(*[F.col(c) for c in fields])).alias("_first"))
    return best.select(key_col, *[F.col(f"_first.{c}").alias(c) for c in fields])


def identity_key(df: DataFrame, key_col: str, version_col: str | None) -> DataFrame:
    """Optional versioned key: ``id`` plus a change marker, so changed records pass."""
    if version_col is None:
        return df
    return df.withColumn(key_col, F.concat_ws("@", F.col(key_col).cast("string"),
                                              F.col(version_col).cast("string")))
