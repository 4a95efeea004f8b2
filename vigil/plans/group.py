"""One pass for a group of feeds over one export: one scan, one anti-join, one delivery, one commit.

Every record is tagged with the feeds whose predicates it meets (``feeds.extract_many``); the tagged keys
meet the state of all feeds in one anti-join on (feed, key); all events go through one sink write, whose
batches may hold events of several feeds, and whose outcome is kept by (feed, key). Each feed then gets its own
marks, counts and state, under one version. Snapshot feeds take part: their current keys are tagged by the
same scan, and what their state has beyond them is reported.
"""

from __future__ import annotations

import time
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import diff, envelope, watermark
from ..operators import state as S
from ..operators.ordinal import with_ordinal
from ..session import no_rows
from ..sources import event_sink, paths
from . import feeds
from .registry import HOST, INDEX, SOURCE, FeedSpec
from .run import DEFAULT_TRANSPORT, RunResult

SNAPSHOT_RECORDS = {"assets": ["asset_id", "event_type", "detected_at"],
                    "vulns": ["vulnerability_key", "asset_uuid", "plugin_id", "port", "protocol", "event_type",
                              "detected_at"]}
# the sink's key: a feed name has no colon; "k" stands before a key, "n" for none
SINK_KEY = "concat(feed, ':', coalesce(concat('k', item_id), 'n'))"


def _by_feed(specs: list[FeedSpec], value) -> Column:
    """A CASE over the group's feeds."""
    return reduce(lambda c, s: c.when(F.col("feed") == s.feed, value(s)), specs[1:],
                  F.when(F.col("feed") == specs[0].feed, value(specs[0])))


def _outcome(spark: SparkSession, folder: str, schema: str = "item_id string") -> DataFrame:
    """What the sink's tasks wrote, with the feed and the key taken apart."""
    rows = spark.read.schema(schema).parquet(folder) if paths.exists(spark, folder) else no_rows(spark, schema)
    own = F.expr("IF(substring(item_id, instr(item_id, ':') + 1, 1) = 'k', substring(item_id, instr(item_id, ':') + 2), NULL)")
    return rows.withColumn("feed", F.substring_index("item_id", ":", 1)).withColumn("item_id", own)


def _counts(df: DataFrame) -> dict[str, int]:
    return {r["feed"]: r["n"] for r in df.groupBy("feed").agg(F.count(F.lit(1)).alias("n")).collect()}     # a row per feed


def _vanished(specs: list[FeedSpec], current: DataFrame, live: DataFrame, now: int, min_ratio: float | None) -> DataFrame:
    """(feed, item_id, _doc): an event per key of a snapshot feed's state that the export lacks."""
    names = [s.feed for s in specs]
    prev = live.filter(F.col("feed").isin(*names))
    if min_ratio:
        before, there = _counts(prev), _counts(current.distinct())
        for f in names:
            if not diff.min_ratio_ok(before.get(f, 0), there.get(f, 0), min_ratio):
                raise feeds.SnapshotTooSmall(f"{f}: {there.get(f, 0)} current keys vs {before.get(f, 0)} previous")
    gone = prev.join(current, ["feed", "item_id"], "left_anti")
    parts = []
    for s in specs:
        mine = gone.filter(F.col("feed") == s.feed)
        events = diff.deletion_events(mine, now, "item_id") if s.source == "assets" else diff.fix_events(mine, now, "item_id")
        names = SNAPSHOT_RECORDS[s.source]
        parts.append(events.select(F.lit(s.feed).alias("feed"), F.col(names[0]).alias("item_id"),
                                   X.to_json_keep_nulls(F.struct(*names)).alias("_doc")))
    return reduce(DataFrame.unionByName, parts)


def run_group(spark: SparkSession, specs: list[FeedSpec], source: DataFrame, state_base: str, outbox_base: str,
              now: int, run_id: int | str, raw_col: str, *, retention_days: int = S.DEFAULT_RETENTION_DAYS,
              max_ids: int = S.DEFAULT_MAX_IDS, max_events: int = 0, batch_size: int = 5000, max_bytes: int = 1048576,
              transport: str = DEFAULT_TRANSPORT, scan_interval_h: float | None = None,
              min_snapshot_ratio: float | None = None, emit: str = "until_expiry", include_unlicensed: bool = True,
              lateness_s: int = 0, backoff_s: float = 0.0, buckets: int = 0,
              deliver=event_sink.deliver) -> dict[str, RunResult]:
    """Run incremental and snapshot feeds of one source together; a result per feed.

    ``raw_col`` holds the event document of a record. The results, marks and states are those of single
    runs; lines go to ``<outbox>/run=<id>/group=<group>``. Retries and seconds are those of the whole group.
    """
    t0 = time.time()
    if len({s.source for s in specs}) != 1 or any(s.mode not in ("incremental", "snapshot_diff") for s in specs):
        raise ValueError("a group shares one source, of incremental and snapshot feeds")
    for what, path in (("state", state_base), ("outbox", outbox_base)):
        paths.require_shared(spark, path, what)
    had = {r["feed"]: r for r in S.load_marks(spark, state_base).collect()}       # a row per feed
    old = {s.feed: int((had[s.feed]["last_timestamp"] if s.feed in had else 0) or 0) for s in specs}
    # a compound mark: its second is read again, what was sent of it is in the state
    since = {f: m - 1 if m and S.mark_key(spark, state_base, f) is not None else m for f, m in old.items()}
    full = {s.feed: int((had[s.feed]["last_full_scan"] if s.feed in had else 0) or 0) for s in specs}
    results: dict[str, RunResult] = {}
    if scan_interval_h:
        gated = spark.createDataFrame([(s.feed, full[s.feed]) for s in specs if s.mode == "snapshot_diff"], "feed string, at bigint")
        waits = {r["feed"] for r in gated.filter(~X.scan_due(now, "at", scan_interval_h)).collect()}
        results = {f: RunResult(0, 0, 0, old[f], old[f], False, 0.0, skipped=True) for f in waits}
        specs = [s for s in specs if s.feed not in waits]
    if not specs:
        return results
    names = [s.feed for s in specs]
    snapshot = [s for s in specs if s.mode == "snapshot_diff"]
    plain = [s for s in specs if s.mode == "incremental"]
    group = specs[0].group
    book = f"{outbox_base.rstrip('/')}/_delivery/run={run_id}/group={group}"
    outbox = f"{outbox_base.rstrip('/')}/run={run_id}/group={group}"
    for part in ("keys", "retry"):
        paths.delete(spark, f"{book}/{part}")
    current = S.load(spark, state_base).filter(F.col("feed").isin(*names))
    live = S.active_keys(current, now, retention_days)
    epoch = _by_feed(specs, lambda s: F.col(s.epoch_col).cast("bigint") if s.epoch_col else F.lit(None).cast("bigint"))
    tagged = feeds.extract_many(specs, source, since, include_unlicensed, lateness_s).select(
        "feed", F.col("item_id").cast("string").alias("item_id"), F.col(raw_col).alias("_doc"), epoch.alias("_at")).persist()
    lines = None
    try:
        events = tagged.filter(F.col("feed").isin(*[s.feed for s in plain])).join(live, ["feed", "item_id"], "left_anti")
        there = tagged.filter(F.col("feed").isin(*[s.feed for s in snapshot]) & F.col("item_id").isNotNull()).select("feed", "item_id")
        if snapshot:
            events = events.unionByName(_vanished(snapshot, there, live, now, min_snapshot_ratio), allowMissingColumns=True)
        # all but the document is the same for a feed's events: a constant text each
        line = _by_feed(specs, lambda s: envelope.envelope_json_raw(F.col("_doc"), envelope.envelope(
            F.lit(""), F.lit(s.sourcetype), SOURCE, INDEX, HOST, now, F.lit(s.feed_type), F.lit(s.label))))
        lines = events.select("feed", "item_id", "_at", "_doc").persist()
        available = _counts(lines)
        lines_json = lines.select("feed", "item_id", "_at", line.alias("json"))
        over = {s.feed for s in specs if max_events and s.honours_cap and available.get(s.feed, 0) > max_events}
        sent = lines_json
        if over:
            ranked = with_ordinal(lines_json.filter(F.col("feed").isin(*over)), ["item_id", "json"], by=["feed"], name="_rn")
            sent = lines_json.filter(~F.col("feed").isin(*over)).unionByName(ranked.filter(F.col("_rn") <= max_events).drop("_rn"))
        taken = {f: max_events if f in over else n for f, n in available.items()}
        deliver(sent.withColumn("_key", F.expr(SINK_KEY)), transport.format(outbox=outbox), f"{book}/log", run_id=f"{run_id}",
                batch_size=batch_size, max_bytes=max_bytes, key_column="_key", delivered_keys=f"{book}/keys",
                retry_lines=f"{book}/retry", dead_letters=f"{outbox_base.rstrip('/')}/_dead_letters/run={run_id}/group={group}",
                backoff_s=backoff_s)
        lost = _outcome(spark, f"{book}/retry", "batch_id string, item_id string")
        failed = {r["feed"]: r["n"] for r in lost.groupBy("feed").agg(F.countDistinct("batch_id").alias("n")).collect()}
        settled = _outcome(spark, f"{book}/keys")
        dead = _counts(_outcome(spark, f"{outbox_base.rstrip('/')}/_dead_letters/run={run_id}/group={group}"))
        reached = _counts(settled)
        retries = 0
        if any(taken.values()):
            if not paths.exists(spark, f"{book}/log"):
                raise S.StateDamaged(f"{book}/log: events were handed to the sink, which left no log")
            retries = event_sink.read_delivery_log(spark, f"{book}/log").filter(~F.col("final")).count()
        # a key with an event in an undelivered batch is not committed, whatever else was sent of it
        done = settled.filter(F.col("item_id").isNotNull()).join(
            lost.select("feed", "item_id"), ["feed", "item_id"], "left_anti")
        by_data_rule = sent.filter(F.col("feed").isin(*[s.feed for s in specs if s.mark_rule == "data"]))
        if not failed and reached == taken:     # then all events are among the keys
            sent_done = by_data_rule.filter(F.col("item_id").isNotNull())
        else:
            sent_done = by_data_rule.join(done, ["feed", "item_id"], "left_semi")

        held = {f: f in over or f in failed for f in names}
        held_rows = spark.createDataFrame(list(held.items()), "feed string, held boolean")
        old_rows = spark.createDataFrame([(f, old[f]) for f in names], "feed string, last_timestamp bigint")
        by_data = {r["feed"]: r["new_mark"] for r in watermark.data_mark(sent_done, old_rows, "_at", held=held_rows).collect()}
        sent_any = spark.createDataFrame([(f,) for f, n in taken.items() if n], "feed string")     # the rule asks for any event
        by_clock = {r["feed"]: r["new_mark"] for r in watermark.clock_mark(sent_any, old_rows, now, held=held_rows).collect()}
        new = {s.feed: by_data[s.feed] if s.mark_rule == "data" else by_clock[s.feed] if s.mark_rule == "clock" else old[s.feed]
               for s in specs}
        marks = spark.createDataFrame([(s.feed, new[s.feed], (int(now) if s.mode == "snapshot_diff" and not failed.get(s.feed)
                                                              else full[s.feed]) or None, int(now)) for s in specs],
                                      S.WATERMARK_SCHEMA)
        seen = F.timestamp_seconds(F.lit(int(now)))
        fresh = done.filter(F.col("feed").isin(*[s.feed for s in plain]))
        if max_ids:
            first = sent.groupBy("feed", "item_id").agg(F.min("_at").alias("_at"))
            fresh = S.stamp(fresh.distinct().join(first, ["feed", "item_id"], "left"), ["_at", "item_id"], int(now) * 1_000_000)
        else:
            fresh = fresh.select("feed", "item_id", seen.alias("seen_at"))
        base = current
        if snapshot:
            fresh = fresh.unionByName(there.select("feed", "item_id", seen.alias("seen_at")))
            if emit == "once":
                base = current.join(done.filter(F.col("feed").isin(*[s.feed for s in snapshot])), ["feed", "item_id"], "left_anti")
        merged = S.expire(S.upsert(base, fresh), now, retention_days)
        version = (S.current_version(spark, state_base) or 0) + 1
        S.commit(S.trim_newest(merged, max_ids), state_base, version, marks=marks, feeds=names, buckets=buckets)
    finally:
        tagged.unpersist()
        if lines is not None:
            lines.unpersist()
    seconds = round(time.time() - t0, 3)
    for f in names:
        results[f] = RunResult(taken.get(f, 0), reached.get(f, 0) - dead.get(f, 0), failed.get(f, 0), old[f], new[f],
                               f in over, seconds, dead_letters=dead.get(f, 0), retries=retries if f == names[0] else 0)
    return results
