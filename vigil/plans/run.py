"""One run of a feed with delivered-only commit.

load the feed's state + marks -> extract / dedup (or snapshot diff) -> envelope ->
posted through the delivery sink (clustered by key, partition-local count/byte
batches, injected transport) -> the sink records the keys of delivered and of
undelivered batches -> delivered keys without an undelivered event are committed with the
state. While a batch failed or a cap cut a batch run, the feed's mark stays where it
was, so the next run over the same landing sends exactly what is missing: what was
sent is in the state. A file stream never looks at a file twice, so a streaming run
keeps its undelivered and capped events in a retry table instead: their finished
envelopes, by batch id and key. The commit of a run names the retry table of that run; the
next run sends its events first, and its own commit replaces it. Events that the receiver
refused for good are written to the dead-letter table and count as settled.
"""

from __future__ import annotations

import time
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import dedup, metrics, sink, watermark
from ..operators import state as S
from ..operators.ordinal import with_ordinal
from ..session import no_rows, shuffles_dropped
from ..sources import event_sink, paths
from . import feeds
from .registry import FeedSpec

DEFAULT_TRANSPORT = "file:{outbox}"     # hand-off folder; {outbox} is the run's outbox folder


@dataclass
class RunResult:
    events: int
    delivered_events: int
    failed_batches: int
    old_mark: int
    new_mark: int
    truncated: bool
    seconds: float
    skipped: bool = False
    dead_letters: int = 0
    retries: int = 0
    trimmed: int = 0
    pending: int = 0


def _mark(marks: DataFrame, feed: str, name: str) -> int:
    row = marks.filter(F.col("feed") == feed).select(name).first()   # one-row mark
    return int(row[0]) if row is not None and row[0] is not None else 0


def _keys(spark: SparkSession, folder: str) -> DataFrame:
    """Keys that the sink's tasks wrote, one row per event; a folder that no task opened has none."""
    if not paths.exists(spark, folder):
        return no_rows(spark, "item_id string")
    return spark.read.schema("item_id string").parquet(folder).filter(F.col("item_id").isNotNull())


RETRY_DDL = "batch_id string, item_id string, event string"


def pending_events(spark: SparkSession, book: str | None) -> DataFrame:
    """(batch_id, item_id, event) that the run with the delivery folder ``book`` left unsent."""
    folders = [f for f in (f"{book}/retry", f"{book}/over_cap") if book and paths.exists(spark, f)]
    return spark.read.schema(RETRY_DDL).parquet(*folders) if folders else no_rows(spark, RETRY_DDL)


def has_pending(spark: SparkSession, state_base: str, feed: str) -> bool:
    book = S.stream_marks(spark, state_base, feed)["pending"]
    return bool(pending_events(spark, book).limit(1).count())


def run_feed(spark: SparkSession, spec: FeedSpec, source: DataFrame, state_base: str, outbox_base: str,
             now: int, run_id: int | str, record_cols: list[str], *, retention_days: int = S.DEFAULT_RETENTION_DAYS,
             max_ids: int = S.DEFAULT_MAX_IDS, max_events: int = 0, batch_size: int = 5000,
             max_bytes: int = 1048576, transport: str = DEFAULT_TRANSPORT, version_col: str | None = None,
             scan_interval_h: float | None = None, min_snapshot_ratio: float | None = None,
             emit: str = "until_expiry", raw_col: str | None = None, state_version: int | None = None,
             commit_version: int | None = None, include_unlicensed: bool = True,
             lateness_s: int = 0, within_run: str | None = None, backoff_s: float = 0.0,
             shape=None, stream_batch: int | None = None, deliver=event_sink.deliver, buckets: int = 0,
             keyset: bool = False) -> RunResult:
    """Run one feed. Snapshot feeds refresh only the keys still present; a vanished key
    keeps its old ``seen_at`` and is reported again each run until it expires
    (``emit="until_expiry"``), or is dropped from state once delivered (``emit="once"``).
    ``shape`` maps the new events to their record columns before the envelope.

    ``stream_batch`` makes it a streaming run: the source holds new files only, so no mark is applied
    and unsent events go through the retry table. A batch id that the state has
    already taken in is done: nothing is sent again (-1 sends the retry table only; ``source`` may then be
    None for a snapshot feed).
    ``deliver`` takes the arguments of ``event_sink.deliver``. ``buckets`` writes the state in hash buckets.

    ``keyset`` orders the run: one event per key, by (epoch, key), under a mark of that pair. A capped run sends the
    first ``max_events`` and the next one goes on behind them instead of reading all again; behind a failed batch
    the mark stays before its first event. Feeds without an epoch, flattened and snapshot feeds run as ever."""
    t0 = time.time()
    for what, path in (("state", state_base), ("outbox", outbox_base)):
        paths.require_shared(spark, path, what)
    if state_version is None:
        current, marks = S.load(spark, state_base, spec.feed), S.load_marks(spark, state_base)
    else:   # a run pinned to a version reads that state again when it is repeated
        current = S.load_version(spark, state_base, state_version, spec.feed)
        marks = S.load_marks_version(spark, state_base, state_version)
    old = _mark(marks, spec.feed, "last_timestamp")
    streaming = stream_batch is not None
    taken = S.stream_marks(spark, state_base, spec.feed) if streaming else {}
    if streaming and 0 <= stream_batch <= (-1 if taken["last_batch"] is None else taken["last_batch"]):
        return RunResult(0, 0, 0, old, old, False, round(time.time() - t0, 3), skipped=True)
    if keyset and (streaming or version_col):
        raise ValueError("an ordered run is a batch run, of plain keys")
    ordered = bool(keyset and spec.mode == "incremental" and spec.epoch_col and spec.transform is None)
    old_key = None if streaming else S.mark_key(spark, state_base, spec.feed, state_version)
    capped = bool(max_events and spec.honours_cap)
    # records that go nowhere but to the sink are not kept: what else is asked of them takes a few columns
    passing = spec.mode == "incremental" and spec.transform is None and not (
        streaming or capped or ordered or within_run or max_ids)
    root = outbox_base.rstrip("/")
    outbox = f"{root}/run={run_id}/feed={spec.feed}"
    book = f"{root}/_delivery/run={run_id}/feed={spec.feed}"
    last_full_scan = None
    if spec.mode == "snapshot_diff":
        last_full_scan = _mark(marks, spec.feed, "last_full_scan")
        if scan_interval_h:
            due = spark.range(1).select(X.scan_due(now, F.lit(last_full_scan), scan_interval_h)).first()[0]
            if not due:
                return RunResult(0, 0, 0, old, old, False, round(time.time() - t0, 3), skipped=True)
        key_col = "asset_id" if spec.source == "assets" else "vulnerability_key"
        if source is None:      # no snapshot to compare with: only the retry table is sent
            events = no_rows(spark, ", ".join(f"{c} string" for c in (key_col, "item_id")))
            current_keys, record_cols = None, [key_col]
        else:
            current_keys = feeds.extract(spec, source).select("item_id").persist()      # compared, then committed
            try:
                events = feeds.run_snapshot_diff(spec, source, current, now, retention_days, min_snapshot_ratio,
                                                 current_keys)
            except feeds.SnapshotTooSmall:
                current_keys.unpersist()
                raise
            events = events.withColumn("item_id", F.col(key_col))
    else:
        # a file stream is incremental by its offsets; re-applying the clock mark would drop
        # records that landed late, so streaming runs use none
        events = feeds.run_incremental(spec, source, current, now, mark=None if streaming else old,
                                       retention_days=retention_days, include_unlicensed=include_unlicensed,
                                       lateness_s=lateness_s, within_run=within_run, version_col=version_col,
                                       mark_key=old_key, keyset=ordered, met=f"{book}/met" if passing else None)
        current_keys = None
    for part in ("retry", "over_cap"):      # what an attempt that was not committed left under this run id
        paths.delete(spark, f"{book}/{part}")
    waiting = pending_events(spark, taken.get("pending"))
    if streaming:   # a key that waits to be sent counts as seen
        events = dedup.new_only(events, waiting)
    if not passing:
        events = events.persist()
    held = top = None
    try:
        if capped and not streaming:
            available = events.count()
            truncated = available > max_events
            sent = events
            if truncated:
                sent = feeds.cap_keyset(events, int(max_events), spec.epoch_col) if ordered else feeds.cap_rows(
                    events, int(max_events), feeds.cap_order(events))
        else:
            available, truncated, sent = None, False, events
        shaped = sent.transform(shape) if shape else sent
        lines = feeds.wrap(shaped, spec, now, record_cols, raw_col=raw_col if spec.mode != "snapshot_diff" else None)
        if streaming:
            old_lines = waiting.select(F.col("item_id"), F.col("event").alias("json"), F.lit(0).alias("_age"))
            lines = old_lines.unionByName(lines.select(
                F.col("item_id").cast("string").alias("item_id"), "json", F.lit(1).alias("_age")))
            if capped:          # ranked in several passes
                lines = held = lines.persist()
            available = lines.count()
            if capped and available > max_events:       # what waited longest goes first
                truncated = True
                ranked = with_ordinal(lines, ["_age", "item_id", "json"], name="_cap_rn")
                ranked.filter(F.col("_cap_rn") > max_events).select(
                    F.lit(None).cast("string").alias("batch_id"), "item_id", F.col("json").alias("event")).write.mode(
                    "overwrite").parquet(f"{book}/over_cap")
                lines = ranked.filter(F.col("_cap_rn") <= max_events)
        if passing:
            by_data = spec.epoch_col if spec.mark_rule in ("data", "scans") else None
            newest = F.max(F.when(F.col("item_id").isNotNull(), F.col(by_data).cast("bigint"))) if by_data else F.lit(None)
            with shuffles_dropped(spark):
                available, top = sent.agg(F.count(F.lit(1)), newest).first()
        elif available is None:
            available = events.count()
        n_events = min(available, max_events) if truncated else available
        deliver(lines, transport.format(outbox=outbox), f"{book}/log", run_id=f"{run_id}",
                batch_size=batch_size, max_bytes=max_bytes, key_column="item_id",
                delivered_keys=f"{book}/keys", failed_keys=f"{book}/failed",
                retry_lines=f"{book}/retry" if streaming else None,
                dead_letters=f"{root}/_dead_letters/run={run_id}/feed={spec.feed}", backoff_s=backoff_s)
        n_delivered = failed = retries = refused = unsent = 0
        if n_events:
            if not paths.exists(spark, f"{book}/log"):
                raise S.StateDamaged(f"{book}/log: {n_events} events were handed to the sink, which left no log")
            log = event_sink.read_delivery_log(spark, f"{book}/log")
            last = F.col("final") & (F.col("outcome") == "retryable")
            m = log.select("*", X.delivery_outcome("status_code").alias("outcome")).agg(
                F.sum(F.when(F.col("status_code") == 200, F.col("event_count"))), F.sum(F.when(last, 1)),
                F.sum(F.when(~F.col("final"), 1)),
                F.sum(F.when(F.col("final") & (F.col("outcome") == "dropped"), F.col("event_count"))),
                F.sum(F.when(last, F.col("event_count")))).first()
            n_delivered, failed, retries, refused, unsent = (int(x or 0) for x in m)

        # a key with an event in an undelivered batch is not committed, whatever else was sent of it
        delivered = _keys(spark, f"{book}/keys").join(_keys(spark, f"{book}/failed"), "item_id", "left_anti").join(
            _keys(spark, f"{book}/over_cap"), "item_id", "left_anti")
        if n_delivered + refused == n_events and not (streaming and truncated):     # then all of them are among the keys
            delivered_events = sent.filter(F.col("item_id").isNotNull())
            if passing:         # one row with their newest time, which is known by now
                delivered_events = sent = spark.createDataFrame([(top,)] if n_events else [],
                                                                f"{spec.epoch_col or 'item_id'} bigint")
        else:
            delivered_events = sent.join(delivered, "item_id", "left_semi")
        seen = F.timestamp_seconds(F.lit(int(now)))
        if current_keys is not None:
            # snapshot feeds: refresh every current key; reported keys are not refreshed
            new_keys = current_keys.select(F.lit(spec.feed).alias("feed"), "item_id", seen.alias("seen_at"))
        elif max_ids:
            # under a cap the order of the records decides which keys are the newest
            first = sent.groupBy(F.col("item_id").cast("string").alias("item_id")).agg(
                F.min(spec.epoch_col or "item_id").alias("_at"))
            ranked = delivered.distinct().join(first, "item_id", "left").select(F.lit(spec.feed).alias("feed"), "item_id", "_at")
            new_keys = S.stamp(ranked, ["_at", "item_id"], int(now) * 1_000_000)
        else:
            new_keys = delivered.select(F.lit(spec.feed).alias("feed"), "item_id", seen.alias("seen_at"))
        if spec.mode == "snapshot_diff" and source is None:
            new_keys = S.empty_state(spark)         # what vanished is not seen again by being reported

        held_back = truncated or failed > 0
        if ordered:
            new_mark, new_key = watermark.keyset_mark(sent, _keys(spark, f"{book}/failed") if failed else None,
                                                      spec.epoch_col, (old, old_key))
        else:
            new_mark = watermark.next_mark(spec.mark_rule, spec.feed, sent, delivered_events, old, now, spec.epoch_col,
                                           held=held_back)
            new_key = old_key if held_back else None
        mine = spark.createDataFrame([(spec.feed, new_mark, last_full_scan or None, int(now))], S.WATERMARK_SCHEMA)
        if spec.mode != "snapshot_diff":
            mine = mine.drop("last_full_scan")
        elif not failed and source is not None:     # events that were not sent must not wait for the next full scan
            mine = mine.withColumn("last_full_scan", F.lit(int(now)).cast("bigint"))
        version = commit_version if commit_version is not None else (S.current_version(spark, state_base) or 0) + 1
        stream_state = {"last_batch": max(stream_batch, -1 if taken["last_batch"] is None else taken["last_batch"]),
                        "pending": book} if streaming else {"mark_key": new_key}
        trimmed = 0
        reported_go = spec.mode == "snapshot_diff" and emit == "once"
        if current_keys is None and not reported_go and not max_ids and state_version is None and new_keys.isEmpty():
            S.commit_marks(spark, state_base, version, mine, stream=stream_state)     # a quiet run rewrites no keys
        else:
            base_state = current
            if reported_go:
                base_state = current.join(delivered.withColumn("feed", F.lit(spec.feed)), ["feed", "item_id"], "left_anti")
            added = None
            if buckets and not max_ids and spec.mode != "snapshot_diff":
                # the delivered keys are distinct and the newest: what they don't renew stays in its buckets
                added = new_keys.distinct()
                merged = S.expire(S.unrenewed(base_state, new_keys), now, retention_days)
            else:
                merged = S.expire(S.upsert(base_state, new_keys), now, retention_days)
            if max_ids:
                merged = merged.persist()
                trimmed = max(0, merged.count() - int(max_ids))
            S.commit(S.trim_newest(merged, max_ids), state_base, version, marks=mine, feeds=[spec.feed],
                     buckets=buckets, stream=stream_state, added=added)
            merged.unpersist()
    finally:
        events.unpersist()
        paths.delete(spark, f"{book}/met")
        if current_keys is not None:
            current_keys.unpersist()
        if held is not None:
            held.unpersist()
    over = available - n_events if streaming else 0
    return RunResult(n_events, n_delivered, failed, old, new_mark, truncated, round(time.time() - t0, 3),
                     dead_letters=refused, retries=retries, trimmed=trimmed, pending=(unsent if streaming else 0) + over)


def read_outbox_run(spark: SparkSession, outbox_base: str, run_id: int | str, feed: str) -> DataFrame:
    """Lines handed to the file transport in one run (``*.json.gz`` batches)."""
    return sink.read_outbox(spark, f"{outbox_base.rstrip('/')}/run={run_id}/feed={feed}/*.json.gz")


RUN_SCHEMA = ("run_id string, feed string, feed_group string, event_count bigint, sent bigint, duration double, "
              "status string, retries bigint, failed_batches bigint, dead_letters bigint, trimmed bigint, "
              "ts timestamp_ntz")
ERROR_SCHEMA = "error_id bigint, run_id string, feed string, error string, ts timestamp_ntz"


def _jobs_in_one_pass(jobs: list[tuple[FeedSpec, DataFrame, list[str]]], raw_cols: dict[str, str | None],
                      kw: dict) -> list[list[tuple[FeedSpec, DataFrame, list[str]]]]:
    """Jobs that read the same export with the same document column side by side; all others alone."""
    out: dict = {}
    for job in jobs:
        spec, source, _ = job
        alike = raw_cols.get(spec.feed) and spec.mode == "incremental" and spec.transform is None and not (
            kw.get("within_run") or kw.get("version_col") or kw.get("keyset"))
        out.setdefault((spec.group, id(source), raw_cols[spec.feed]) if alike else spec.feed, []).append(job)
    return list(out.values())


PROGRESS_SCHEMA = ("run_id string, scope string, tick bigint, events bigint, errors bigint, total bigint, "
                   "elapsed_s double, rate double")


def _progress(spark: SparkSession, outbox_base: str, run_id: int, scopes: list[str], tick_s: int) -> DataFrame | None:
    """Progress rows of a run from the delivery logs its tasks wrote, per feed or group that was sent."""
    root = f"{outbox_base.rstrip('/')}/_delivery/run={run_id}"
    logs = [event_sink.read_delivery_log(spark, f"{root}/{s}/log").withColumn("scope", F.lit(s))
            for s in scopes if paths.exists(spark, f"{root}/{s}/log")]
    if not logs:
        return None
    rows = metrics.delivery_progress(reduce(DataFrame.unionByName, logs), tick_s)
    return rows.withColumn("run_id", F.lit(str(run_id)))


def run_once(spark: SparkSession, jobs: list[tuple[FeedSpec, DataFrame, list[str]]], state_base: str,
             outbox_base: str, log_base: str, now: int, run_id: int, raw_cols: dict[str, str | None] | None = None,
             one_pass: bool = False, progress_s: int = 60, **kw) -> DataFrame:
    """Run several feeds; a failing feed is recorded and does not stop the others.

    With ``one_pass`` incremental feeds of one export run as a group (``plans.group``): one scan, one delivery
    and one commit. Appends one ``run_log`` row per feed (status ``ok`` / ``skipped`` / ``error``)
    and one ``error_log`` row per failure, then returns the run summary computed
    from those logs, with totals per feed group. ``progress_log`` gets a row per ``progress_s`` seconds of delivery and
    feed (``feed=F``, or ``group=G`` for one pass): events, running total and rate; 0 writes none.
    """
    import datetime as dt

    from .group import run_group

    paths.require_shared(spark, log_base, "logs")
    runs, errors, scopes, started = [], [], [], time.time()
    ts = dt.datetime.fromtimestamp(int(now), dt.timezone.utc).replace(tzinfo=None)
    raw_cols = raw_cols or {}
    for batch in _jobs_in_one_pass(jobs, raw_cols, kw) if one_pass else [[j] for j in jobs]:
        specs, (spec, source, cols) = [j[0] for j in batch], batch[0]
        try:
            if len(batch) > 1:
                own = {k: v for k, v in kw.items() if k not in ("within_run", "version_col", "keyset")}
                done = run_group(spark, specs, source, state_base, outbox_base, now, run_id, raw_cols[spec.feed], **own)
            else:
                done = {spec.feed: run_feed(spark, spec, source, state_base, outbox_base, now, run_id, cols,
                                            raw_col=raw_cols.get(spec.feed), **kw)}
            scopes.append(f"group={spec.group}" if len(batch) > 1 else f"feed={spec.feed}")
            for s in specs:
                r = done[s.feed]
                runs.append((str(run_id), s.feed, s.group, r.events, r.delivered_events, float(r.seconds),
                             "skipped" if r.skipped else "ok", r.retries, r.failed_batches, r.dead_letters, r.trimmed, ts))
        except Exception as e:  # noqa: BLE001 -- recorded, the run goes on
            for s in specs:
                runs.append((str(run_id), s.feed, s.group, 0, 0, 0.0, "error", 0, 0, 0, 0, ts))
                errors.append((len(errors) + 1, str(run_id), s.feed, f"{type(e).__name__}: {e}", ts))
    # processed (event_count) and sent differ when batches fail
    spark.createDataFrame(runs, RUN_SCHEMA).write.mode("append").parquet(f"{log_base}/run_log")
    spark.createDataFrame(errors, ERROR_SCHEMA).write.mode("append").parquet(f"{log_base}/error_log")
    rows = _progress(spark, outbox_base, run_id, scopes, progress_s) if progress_s else None
    if rows is not None:
        rows.select([f.split()[0] for f in PROGRESS_SCHEMA.split(", ")]).coalesce(1).write.mode("append").parquet(
            f"{log_base}/progress_log")
    run_log = spark.read.parquet(f"{log_base}/run_log").filter(F.col("run_id") == str(run_id))
    error_log = spark.read.parquet(f"{log_base}/error_log").filter(F.col("run_id") == str(run_id))
    summary = metrics.run_summary(run_log.withColumnRenamed("duration", "duration_s"), error_log,
                                  elapsed_s=time.time() - started)
    per_feed = F.array_sort(F.collect_list(F.struct("feed", "event_count", "sent", "retries", "failed_batches",
                                                    "dead_letters", "trimmed", "status")))
    more = run_log.agg(F.sum("retries").alias("retries"), F.sum("failed_batches").alias("failed_batches"),
                       F.sum("dead_letters").alias("dead_letters"), F.sum("trimmed").alias("trimmed"),
                       per_feed.alias("per_feed"))      # a row per feed of one run
    recent = metrics.errors_recent(error_log).agg(F.array_sort(F.collect_list(F.struct(
        "error_id", "feed", "error"))).alias("recent_errors"))
    failed = F.lit(sum(1 for r in runs if r[6] == "error")).cast("bigint")
    totals = metrics.events_rollup(run_log).filter("level = 1").agg(F.array_sort(F.collect_list(F.struct(
        "feed_group", F.col("runs").alias("feeds"), "events"))).alias("per_group"))      # a row per group of feeds
    # four one-row tables side by side
    return summary.join(more, F.lit(True)).join(totals, F.lit(True)).join(recent, F.lit(True)).withColumn(
        "failed_feeds", failed)
