"""Structured Streaming runs: every micro-batch is one feed run with delivered-only commit.

Each micro-batch posts the new events, and those that the run before left unsent, through the
delivery sink and commits the state of what was delivered together with its batch id and its own retry
table. A crash before the commit only causes a re-send of that batch; a batch id that the state has
taken in is passed by when Spark replays it. A file stream moves on whatever became of a batch, so
unsent and capped events live in the retry table (``plans.run``): the next micro-batch sends them, and
so does the start of the next run, over unchanged files too. ``trigger(availableNow=True)`` is one
incremental run; ``processingTime`` makes it a daemon.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import sink
from ..operators import state as S
from ..plans import feeds
from ..plans.registry import REGISTRY, FeedSpec
from ..session import no_rows, work_dir
from ..sources import tpc_landing as L


def vuln_records(batch: DataFrame) -> DataFrame:
    """Raw lineitem-shaped landing rows -> nested vulnerability records (same rules as the batch view)."""
    flat = L.vulns_from_lineitem(batch)
    return L.nest_vulns(flat).withColumn("last_found_epoch", X.epoch_seconds("last_found"))


def make_batch_handler(spec: FeedSpec, state_base: str, outbox_base: str, now: int | None, retention_days: int, max_ids: int,
                       record_cols: list[str], **run_kw):
    """A micro-batch of lineitem-shaped rows is one streaming ``run_feed``."""
    from ..plans.run import run_feed

    def handle(batch: DataFrame, batch_id: int, run_id: int | str | None = None) -> None:
        t = int(now) if now is not None else int(time.time())
        run_feed(batch.sparkSession, spec, vuln_records(batch), state_base, outbox_base, t,
                 batch_id if run_id is None else run_id, record_cols, retention_days=retention_days,
                 max_ids=max_ids, stream_batch=batch_id, shape=feeds.flat_vuln_event, **run_kw)
    return handle


def resend(spark: SparkSession, spec: FeedSpec, state_base: str, handle, nothing: DataFrame) -> None:
    """Send what earlier runs left unsent, before any new file is looked at."""
    from ..plans.run import has_pending

    if has_pending(spark, state_base, spec.feed):
        handle(nothing, -1, f"resend-{(S.current_version(spark, state_base) or 0) + 1}")


def run_feed_available_now(spark: SparkSession, sf_dir: str, with_state: bool = True,
                           feed: str = "vulnerability", now: int = L.NOW_TPC,
                           retention_days: int = L.STATE_RETENTION_DAYS, max_ids: int = S.DEFAULT_MAX_IDS,
                           max_files_per_trigger: int | None = None, source_dir: str | None = None,
                           source_glob: str = "lineitem.parquet", root: str | None = None,
                           initial_state: DataFrame | None = None, **run_kw) -> dict[str, DataFrame]:
    """One incremental run of a vulnerability feed over landed lineitem-shaped files.

    ``root`` holds state, outbox and the stream checkpoint; passing the same root
    again continues from the committed offsets and state, and sends what was left unsent (a later run).
    """
    spec = REGISTRY[feed]
    root = root or work_dir(spark, "stream")
    state_base, outbox, ckpt = f"{root}/state", f"{root}/outbox", f"{root}/_checkpoint"
    if S.current_version(spark, state_base) is None:   # first run on this root
        if initial_state is not None:
            S.commit(initial_state, state_base, version=0, feeds=[spec.feed])
        elif with_state:
            S.commit(L.state(spark, sf_dir), state_base, version=0)
    src_dir = source_dir or sf_dir
    schema = spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", source_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    stream = reader.parquet(src_dir)
    handler = make_batch_handler(spec, state_base, outbox, now, retention_days, max_ids, feeds.VULN_EVENT_COLS,
                                 **run_kw)
    resend(spark, spec, state_base, handler, no_rows(spark, schema))
    q = (stream.writeStream.foreachBatch(lambda batch, batch_id: handler(batch, batch_id)).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return _outputs(spark, outbox, state_base, now, retention_days)


def start_daemon(spark: SparkSession, sf_dir: str, interval_s: int, root: str, source_dir: str | None = None,
                 source_glob: str = "lineitem.parquet", feed: str = "vulnerability", now: int | None = None,
                 retention_days: int = S.DEFAULT_RETENTION_DAYS, max_ids: int = S.DEFAULT_MAX_IDS):
    """Continuous mode: the same commit protocol every ``interval_s`` seconds.

    Without ``now`` every micro-batch runs at its own wall-clock time, so retention advances.
    Returns the running ``StreamingQuery``; ``query.stop()`` is the shutdown (the
    current micro-batch finishes; its state commit happens inside the batch).
    """
    spec = REGISTRY[feed]
    state_base, outbox, ckpt = f"{root}/state", f"{root}/outbox", f"{root}/_checkpoint"
    schema = spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", source_glob).parquet(source_dir or sf_dir)
    handler = make_batch_handler(spec, state_base, outbox, now, retention_days, max_ids, feeds.VULN_EVENT_COLS)
    resend(spark, spec, state_base, handler, no_rows(spark, schema))
    return (stream.writeStream.foreachBatch(lambda batch, batch_id: handler(batch, batch_id)).option("checkpointLocation", ckpt)
            .trigger(processingTime=f"{int(interval_s)} seconds").start())


def _outputs(spark: SparkSession, outbox: str, state_base: str, now: int | None = None,
             retention_days: int = S.DEFAULT_RETENTION_DAYS) -> dict[str, DataFrame]:
    schema = "vuln_key string, asset_uuid string, plugin_id bigint, port int, protocol string, severity string"
    env = sink.read_outbox(spark, f"{outbox}/run=*/feed=*/*.gz", schema)   # every delivered batch of this root
    events = env.select("event.vuln_key", "event.asset_uuid", "event.plugin_id", "event.port", "event.protocol",
                        "event.severity", "sourcetype", "time")
    state = S.load(spark, state_base)
    return {"events": events, "state": S.active(state, now, retention_days) if now is not None else state}


def stream_documents(spark: SparkSession, spec: FeedSpec, landing_dir: str, root: str, *, once: bool = True,
                     interval_s: int = 60, now: int | None = None, max_files_per_trigger: int | None = None,
                     **run_kw):
    """A feed over a JSON-lines landing folder as a Structured Streaming query: an incremental feed, the
    compliance feed (from new host details), or a snapshot feed, whose exports lie in folders of their
    own and count once they are complete (``streaming.snapshots``).

    Each micro-batch is one streaming feed run (``plans.run.run_feed``): only keys of delivered
    batches enter state, and what was not sent, by a failed batch or over ``max_events``, waits in the retry table.
    ``once`` = ``availableNow`` (one incremental run), else ``processingTime``.
    """
    from ..plans.group import SNAPSHOT_RECORDS
    from ..plans.run import run_feed
    from ..sources import readers

    state_base, outbox_base = f"{root}/state", f"{root}/outbox"
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    clock = lambda: int(now) if now is not None else int(time.time())

    def run(s: SparkSession, source: DataFrame, batch_id: int, raw_col: str, run_id: int | str | None = None) -> None:
        run_feed(s, spec, source, state_base, outbox_base, clock(), batch_id if run_id is None else run_id, [],
                 raw_col=raw_col, stream_batch=batch_id, **run_kw)

    if spec.source == "compliance":
        from ..operators import flatten
        from ..sources import paths

        def compliance(s: SparkSession, ready: DataFrame, done: DataFrame) -> DataFrame:
            tree = flatten.compliance_tree(done, readers.scan_hosts(s, details_dir), readers.parse_host_items(ready))
            return tree.withColumn("event_raw", X.json_with_raw(
                F.struct("scan_id", "scan_name", "host_id", "hostname"), "compliance_data", F.col("compliance_data")))

        # new host details and new scan documents both start a micro-batch; scans and scan details
        # are read as static tables, and host details of scans that have not completed stay pending
        landing_root = landing_dir.rstrip("/").rsplit("/", 1)[0]
        scans_dir, details_dir = f"{landing_root}/scans", f"{landing_root}/scan_details"
        stream = reader.load(landing_dir).select("value", F.lit(True).alias("_host")).unionByName(
            reader.load(scans_dir).select("value", F.lit(False).alias("_host")))
        nothing = no_rows(spark, "value string, _host boolean")

        def handle(batch: DataFrame, batch_id: int, run_id: int | str | None = None) -> None:
            s = batch.sparkSession
            if batch_id < 0:        # the retry table alone; host details keep waiting
                run(s, compliance(s, batch.select("value").filter("false"), readers.scans(s, scans_dir)), batch_id,
                    "event_raw", run_id)
                return
            lines = batch.filter("_host").select("value")
            waiting = f"{root}/pending/v={batch_id}"
            if paths.exists(s, waiting):
                lines = lines.unionByName(s.read.schema("value string").parquet(waiting))
            done = readers.scans(s, scans_dir).groupBy("scan_id").agg(F.max_by(F.struct(
                "scan_name", "status", "modified_epoch"), F.coalesce("modified_epoch", F.lit(0))).alias("x")).select(
                "scan_id", "x.*").filter(F.col("status") == "completed")
            scan = F.get_json_object("value", "$.scan_id").cast("bigint")
            lines = lines.withColumn("_scan", scan).persist()
            try:
                later = lines.join(done.select(F.col("scan_id").alias("_scan")), "_scan", "left_anti").filter(
                    F.col("_scan").isNotNull())
                later.select("value").write.mode("overwrite").parquet(f"{root}/pending/v={batch_id + 1}")
                ready = lines.join(done.select(F.col("scan_id").alias("_scan")), "_scan", "left_semi").select("value")
                run(s, compliance(s, ready, done), batch_id, "event_raw", run_id)
            finally:
                lines.unpersist()
    elif spec.source not in readers.PARSERS:
        raise ValueError(f"{spec.feed}: only asset and vulnerability feeds and the compliance feed stream from documents")
    elif spec.mode == "snapshot_diff":
        from . import snapshots

        stream = reader.load(landing_dir).select("value", F.col("_metadata.file_path").alias("file"))
        nothing = no_rows(spark, "value string, file string")

        def handle(batch: DataFrame, batch_id: int, run_id: int | str | None = None) -> None:
            s = batch.sparkSession
            if batch_id < 0:        # the retry table alone
                run_feed(s, spec, None, state_base, outbox_base, clock(), run_id, [], stream_batch=batch_id, **run_kw)
                return
            snapshots.stage(batch, f"{root}/staged", batch_id)
            due = snapshots.newest_complete(s, f"{root}/staged", f"{root}/compared", batch_id)
            if due is None:
                return
            lines = snapshots.lines_of(s, f"{root}/staged", due, batch_id)
            source = readers.good(readers.PARSERS[spec.source](lines))
            run_feed(s, spec, source, state_base, outbox_base, clock(), batch_id, SNAPSHOT_RECORDS[spec.source],
                     stream_batch=batch_id, **run_kw)
            snapshots.settle(s, f"{root}/staged", f"{root}/compared", due)
    else:
        stream = reader.load(landing_dir)
        nothing = no_rows(spark, "value string")

        def handle(batch: DataFrame, batch_id: int, run_id: int | str | None = None) -> None:
            s = batch.sparkSession
            parsed = readers.PARSERS[spec.source](batch).persist()      # one parse for rejects and feed
            try:
                bad = readers.rejects(parsed)
                if bad.limit(1).count():
                    bad.write.mode("overwrite").parquet(f"{root}/rejects/batch={batch_id}")
                run(s, readers.good(parsed), batch_id, "raw", run_id)
            finally:
                parsed.unpersist()

    resend(spark, spec, state_base, handle, nothing)
    w = stream.writeStream.foreachBatch(lambda batch, batch_id: handle(batch, batch_id)).option("checkpointLocation", f"{root}/_checkpoint")
    if once:
        q = w.trigger(availableNow=True).start()
        q.awaitTermination()
        return q
    return w.trigger(processingTime=f"{int(interval_s)} seconds").start()
