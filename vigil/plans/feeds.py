"""Feed runs composed from the operators: extract -> dedup -> envelope -> marks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from ..functions import exprs as X
from ..operators import dedup, diff, envelope, filters as P
from ..operators import state as S
from .registry import HOST, INDEX, SOURCE, FeedSpec


def extract(spec: FeedSpec, source: DataFrame, mark: int | None = None, include_unlicensed: bool = True,
            lateness_s: int = 0, mark_key: str | None = None) -> DataFrame:
    """Source predicate + incremental predicate + key column ``item_id``.

    With ``mark_key`` the mark is the pair (epoch, key): records of the mark's own second behind that key count
    as new. A lateness looks further back than that second, so it goes before."""
    paired = bool(mark and int(mark) > 0 and mark_key is not None and not lateness_s and spec.epoch_col)
    preds = [spec.predicate() if spec.predicate else None]
    if spec.source == "vulns":
        preds.append(P.licensed(include_unlicensed))
    if spec.mode in ("incremental", "flatten") and spec.epoch_col:
        preds.append(P.from_mark(spec.epoch_col, mark) if paired else P.since(spec.epoch_col, mark, lateness_s))
        preds.append(P.landed_since(source.columns, mark, lateness_s))
    df = source.filter(P.all_of(*preds))
    df = df.withColumn("item_id", spec.key())
    if paired:
        df = df.filter(P.after_mark(spec.epoch_col, mark, P.order_key(source.columns), mark_key))
    return df.transform(spec.transform) if spec.transform else df


def extract_many(specs: list[FeedSpec], source: DataFrame, marks: dict[str, int] | None = None,
                 include_unlicensed: bool = True, lateness_s: int = 0) -> DataFrame:
    """Several feeds over one shared source in a single scan.

    Each row is tagged with every feed whose predicates it meets (``explode`` of
    a ``CASE`` array), and the feed's own key is computed per tag. A group of
    feeds reads its export once instead of once per feed. Records that no feed wants are
    left out by the scan, and days before the oldest mark with them.
    """
    marks = marks or {}
    tags, keys, wanted = [], None, None
    for spec in specs:
        preds = [spec.predicate() if spec.predicate else None]
        if spec.source == "vulns":
            preds.append(P.licensed(include_unlicensed))
        if spec.mode == "incremental" and spec.epoch_col:
            preds.append(P.since(spec.epoch_col, marks.get(spec.feed), lateness_s))
        met = P.all_of(*preds)
        wanted = met if wanted is None else wanted | met
        tags.append(F.when(met, F.lit(spec.feed)))
        k = spec.key()
        keys = F.when(F.col("feed") == spec.feed, k) if keys is None else keys.when(F.col("feed") == spec.feed, k)
    oldest = min((marks.get(s.feed) or 0) if s.mode == "incremental" else 0 for s in specs)
    source = source.filter(P.all_of(wanted, P.landed_since(source.columns, oldest, lateness_s)))
    tagged = source.withColumn("feed", F.explode(F.array(*tags))).filter(F.col("feed").isNotNull())
    return tagged.withColumn("item_id", keys)


def cap_order(df: DataFrame) -> list[str | Column]:
    """A total order for caps: the key, then the whole row for events that share a key."""
    rest = [c for c in df.columns if c != "item_id" and not isinstance(df.schema[c].dataType, MapType)]
    return ["item_id", F.to_json(F.struct(*[F.col(c) for c in rest]))]


def cap_rows(df: DataFrame, n: int, order_cols: list[str | Column]) -> DataFrame:
    """The first ``n`` rows in ``order_cols`` order (a total order).

    Ranked with the distributed ordinal, so no single task merges the whole cap.
    """
    from ..operators.ordinal import with_ordinal
    return with_ordinal(df, order_cols, name="_cap_rn").filter(F.col("_cap_rn") <= n).drop("_cap_rn")


def _running(df: DataFrame, value: Column, n: int) -> tuple[int, int]:
    """The value of the ``n``-th row in its order, and how many rows have a smaller one (one row reaches the driver)."""
    before = Window.orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    at = df.groupBy(value.alias("v")).agg(F.count(F.lit(1)).alias("c")).withColumn(
        "before", F.coalesce(F.sum("c").over(before), F.lit(0)))
    row = at.filter((F.col("before") < n) & (F.col("before") + F.col("c") >= n)).first()
    return int(row["v"]), int(row["before"])


EPOCH_DIGITS = (40, 20, 0)      # 2**24, 2**20 and 2**20 values at most, whatever the timestamps


def cap_keyset(df: DataFrame, n: int, epoch_col: str) -> DataFrame:
    """The first ``n`` of more than ``n`` rows by (epoch, order key); a null epoch comes first.

    The second at which the cap falls is found from counts by leading digits of the epoch. Rows of earlier seconds
    stay as they are, those of later ones are left out; only the rows of that second are ranked.
    """
    from ..operators.ordinal import with_ordinal

    epoch = F.coalesce(F.col(epoch_col).cast("bigint"), F.lit(-(1 << 63)))
    part, left = df, int(n)
    for shift in EPOCH_DIGITS:
        digit = F.shiftright(epoch, shift)
        at, before = _running(part, digit, left)
        part, left = part.filter(digit == at), left - before
    ranked = with_ordinal(part, [P.ORDER_KEY], name="_cap_rn")
    return df.filter(epoch < F.lit(at)).unionByName(ranked.filter(F.col("_cap_rn") <= left).drop("_cap_rn"))


def run_incremental(spec: FeedSpec, source: DataFrame, state: DataFrame, now: int, mark: int | None = None,
                    retention_days: int = S.DEFAULT_RETENTION_DAYS, include_unlicensed: bool = True,
                    max_events: int = 0, lateness_s: int = 0, within_run: str | None = None,
                    order_cols: tuple[str, ...] = (), version_col: str | None = None,
                    mark_key: str | None = None, keyset: bool = False, met: str | None = None) -> DataFrame:
    """New events of one incremental feed (``feed`` + ``item_id`` + the record columns).

    ``version_col`` adds a change marker (e.g. ``updated_epoch``) to the dedup key so
    a changed record is delivered again instead of waiting for its key to expire.

    ``keyset`` gives one event per key, its earliest, with its place ``_order_key`` behind the epoch; records
    without a key are events of their own.

    ``met`` names a folder for the keys of the state that the source holds: they are found first, by key alone.
    """
    rows = extract(spec, source, mark, include_unlicensed, lateness_s, mark_key)
    if keyset:
        rows = rows.withColumn(P.ORDER_KEY, P.order_key(source.columns))
    rows = dedup.identity_key(rows, "item_id", version_col)
    seen = S.active_keys(state, now, retention_days, feed=spec.feed)
    if met:
        seen = dedup.met_keys(rows, seen, met)
    new = dedup.new_only(rows, seen, "item_id")
    if keyset:
        keep = [c for c in new.columns if c not in (P.ORDER_KEY, spec.epoch_col) and not isinstance(
            new.schema[c].dataType, MapType)]
        new = dedup.first_per_key(new, P.ORDER_KEY, [spec.epoch_col], keep)
    elif within_run == "first":
        # the whole row breaks ties, so the row that stays is fixed
        keep = [c for c in new.columns if c not in ("item_id", *order_cols)]
        new = dedup.first_per_key(new, "item_id", list(order_cols), keep)
    if max_events and spec.honours_cap:
        new = cap_rows(new, int(max_events), ["item_id", *order_cols, *cap_order(new)[1:]])
    return new.withColumn("feed", F.lit(spec.feed))


class SnapshotTooSmall(RuntimeError):
    """The current snapshot is implausibly small next to the previous one."""


def run_snapshot_diff(spec: FeedSpec, source: DataFrame, state: DataFrame, now: int,
                      retention_days: int = S.DEFAULT_RETENTION_DAYS,
                      min_snapshot_ratio: float | None = None, current_keys: DataFrame | None = None) -> DataFrame:
    """Keys in this feed's own state that the current snapshot lacks.

    ``min_snapshot_ratio`` refuses to report deletions when the current snapshot
    holds fewer than that share of the previous keys (an empty-but-successful
    export would otherwise report everything gone). Off by default (parity).
    ``current_keys`` are the snapshot's ``item_id`` where the caller has them already.
    """
    current = (extract(spec, source) if current_keys is None else current_keys).select(F.col("item_id").alias("k"))
    prev = S.active_keys(state, now, retention_days, feed=spec.feed).select(F.col("item_id").alias("k"))
    if min_snapshot_ratio:
        n_prev, n_curr = prev.count(), current.select("k").distinct().count()   # two scalars
        if not diff.min_ratio_ok(n_prev, n_curr, min_snapshot_ratio):
            raise SnapshotTooSmall(f"{spec.feed}: {n_curr} current keys vs {n_prev} previous")
    gone = diff.vanished(prev, current, "k")
    if spec.source == "assets":
        return diff.deletion_events(gone, now, "k")
    return diff.fix_events(gone, now, "k")


VULN_EVENT_COLS = ["vuln_key", "asset_uuid", "plugin_id", "port", "protocol", "severity"]


def flat_vuln_event(df: DataFrame) -> DataFrame:
    """Nested vulnerability record -> the flat event columns (one projection; ``port``
    replaces the nested struct with its port number)."""
    return df.withColumns({"vuln_key": F.col("item_id"), "asset_uuid": F.col("asset.uuid"),
                           "plugin_id": F.col("plugin.id"), "protocol": F.col("port.protocol"),
                           "port": F.col("port.port")})


def wrap(events: DataFrame, spec: FeedSpec, now: int, record_cols: list[str], tagged: bool = True,
         raw_col: str | None = None) -> DataFrame:
    """Add the envelope struct ``env`` and its JSON text ``json``.

    With ``raw_col`` the event is that column's JSON document, spliced into the
    envelope unchanged; otherwise it is the struct of ``record_cols``.
    """
    event = F.col(raw_col) if raw_col else F.struct(*[F.col(c) for c in record_cols])
    env = envelope.envelope(
        event, F.lit(spec.sourcetype), SOURCE, INDEX, HOST, now,
        F.lit(spec.feed_type) if tagged else None, F.lit(spec.label) if tagged else None)
    out = events.withColumn("env", env)
    if raw_col:
        return out.withColumn("json", envelope.envelope_json_raw(F.col(raw_col), F.col("env")))
    return out.withColumn("json", envelope.envelope_json(F.col("env")))
