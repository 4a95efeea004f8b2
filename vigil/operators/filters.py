"""Feed predicates as Column builders (Catalyst pushes them to the scan)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import exprs as X

# ---- fixed values -------------------------------------------------------------------
ACTIVE_SEVERITIES = ("medium", "high", "critical")
INFO_SEVERITIES = ("info",)
AGENT_SOURCE = "NESSUS_AGENT"
OPEN_STATE = "OPEN"
# -----------------------------------------------------------------------------------


def live_assets() -> Column:
    return ~X.truthy("is_deleted")


def agent_assets(sources_col: str = "sources") -> Column:
    return F.coalesce(F.array_contains(sources_col, AGENT_SOURCE), F.lit(False)) & X.truthy("has_agent")


def terminated_assets(terminated_col: str = "terminated_at") -> Column:
    return X.truthy("is_terminated") & F.col(terminated_col).isNotNull()


def scanned_assets() -> Column:
    return X.truthy("has_plugin_results")


def severity_in(severities) -> Column:
    return F.col("severity").isin(*severities)


def open_on_agent(has_agent_col: str = "asset.has_agent") -> Column:
    return (F.col("state") == OPEN_STATE) & X.truthy(has_agent_col)


def licensed(include_unlicensed: bool) -> Column | None:
    """``include_unlicensed=True`` disables the licence predicate."""
    return None if include_unlicensed else X.truthy("is_licensed")


def since(epoch_col: str, mark: int | None, lateness_s: int = 0) -> Column | None:
    """Incremental predicate, applied only when a mark exists (mark > 0)."""
    if not mark or int(mark) <= 0:
        return None
    return F.col(epoch_col) > F.lit(int(mark) - int(lateness_s))


ORDER_KEY = "_order_key"


def order_key(columns) -> Column:
    """``item_id`` as text; a record without one takes a digest of its ``columns``, so that it has a place too."""
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]))
    return F.coalesce(F.col("item_id").cast("string"), F.concat(F.lit("~"), F.sha2(row, 256)))


def from_mark(epoch_col: str, mark: int) -> Column:
    """The part of ``after_mark`` that the scan can use."""
    return F.col(epoch_col) >= F.lit(int(mark))


def after_mark(epoch_col: str, mark: int, key: Column, mark_key: str) -> Column:
    """Records behind the compound mark (epoch, key), compared in that order."""
    return (F.col(epoch_col) > F.lit(int(mark))) | (key > F.lit(mark_key))


INGEST_PARTITION = "ingest_date"


def landed_since(columns, mark: int | None, lateness_s: int = 0) -> Column | None:
    """Partition-pruning twin of ``since`` for a landing zone partitioned by ingest date.

    A record changed after the mark was landed on or after the mark's date, so
    whole ``ingest_date`` partitions before it are skipped at planning time. Folders may
    be dated in any time zone, so the day before the mark's UTC date still counts.
    """
    if INGEST_PARTITION not in columns or not mark or int(mark) <= 0:
        return None
    return F.col(INGEST_PARTITION) >= F.date_sub(F.to_date(F.timestamp_seconds(F.lit(int(mark) - int(lateness_s)))), 1)


def all_of(*preds: Column | None) -> Column:
    out = None
    for p in preds:
        if p is None:
            continue
        out = p if out is None else (out & p)
    return out if out is not None else F.lit(True)
