"""Command line: run selected feeds over a landing zone, once or every N seconds.

    python -m vigil run --landing L --state S --outbox O --logs G [--feed all|a,b]
                        [--daemon SECONDS] [--max-events N] [--batch-size N] ...
    python -m vigil state list|stats|clear|sweep|migrate --state S ...
    python -m vigil audit --landing L --state S --feed F [--share 0.99]

Landing layout (JSON-lines export documents, optionally partitioned by
``ingest_date=YYYY-MM-DD``): ``assets/ vulns/ families/ family_details/
plugin_details/ scans/ scan_details/ host_details/``.
"""

from __future__ import annotations

import argparse
import importlib
import signal
import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import flatten, lateness
from ..operators import state as S
from ..sources import landing, readers
from . import feeds, registry as R
from .group import SNAPSHOT_RECORDS
from .run import DEFAULT_TRANSPORT, run_once

def feed_source(spark: SparkSession, landing: str, spec: R.FeedSpec,
                landed: dict[str, DataFrame] | None = None) -> tuple[DataFrame, list[str], str | None]:
    """(source DataFrame, record columns, raw event column) for one feed; ``landed`` has the typed tables of exports."""
    root = landing.rstrip("/")
    if spec.source in ("assets", "vulns"):
        # a snapshot feed compares with the export as it lies there now
        src = (landed or {}).get(spec.source) if spec.mode == "incremental" else None
        if src is None:
            src = readers.good(readers.PARSERS[spec.source](spark.read.text(f"{root}/{spec.source}")))
    elif spec.source == "plugins":
        cat = flatten.plugin_catalog(readers.families(spark, f"{root}/families"),
                                     readers.family_details(spark, f"{root}/family_details"),
                                     readers.plugin_details(spark, f"{root}/plugin_details"))
        return flatten.enriched_documents(cat), [], "event_raw"
    elif spec.source == "compliance":
        tree = flatten.compliance_tree(readers.scans(spark, f"{root}/scans"),
                                       readers.scan_hosts(spark, f"{root}/scan_details"),
                                       readers.host_items(spark, f"{root}/host_details"))
        src = tree.withColumn("event_raw", X.json_with_raw(
            F.struct("scan_id", "scan_name", "host_id", "hostname"), "compliance_data", F.col("compliance_data")))
        return src, [], "event_raw"
    else:
        raise ValueError(f"no landing source for {spec.source!r}")
    if spec.mode == "snapshot_diff":
        return src, SNAPSHOT_RECORDS[spec.source], None
    return src, [], "raw"


def load_registry(target: str | None) -> dict[str, R.FeedSpec]:
    """The built-in feeds, and those that ``module:name`` (a spec, a list of specs or a registry) adds."""
    reg = dict(R.REGISTRY)
    if target:
        module, _, name = target.partition(":")
        added = getattr(importlib.import_module(module), name or "REGISTRY")
        specs = added.values() if isinstance(added, dict) else [added] if isinstance(added, R.FeedSpec) else added
        for spec in specs:
            reg = R.register(spec, reg)
    return reg


def _run_options(p: argparse.ArgumentParser) -> None:
    p.add_argument("--max-events", type=int, default=0, help="events that a run sends at most; the rest waits")
    p.add_argument("--batch-size", type=int, default=5000)
    p.add_argument("--max-bytes", type=int, default=1048576)
    p.add_argument("--retention-days", type=int, default=7)
    p.add_argument("--max-ids", type=int, default=0, help="keep only the newest N keys per feed (0: all)")
    p.add_argument("--state-buckets", type=int, default=0, help="hash buckets of the state; joins then leave it in place")
    p.add_argument("--transport", default=DEFAULT_TRANSPORT)
    p.add_argument("--now", type=int, default=None, help="fixed clock (epoch seconds) for replays and tests")
    p.add_argument("--licensed-only", action="store_true", help="leave out vulnerabilities of unlicensed assets")
    p.add_argument("--lateness", type=int, default=0, help="seconds below the mark that are looked at again")
    p.add_argument("--within-run", choices=["first"], default=None, help="one event per key and run")
    p.add_argument("--version-col", default=None, help="column that makes a changed record a new key")
    p.add_argument("--emit", choices=["until_expiry", "once"], default="until_expiry")
    p.add_argument("--registry", default=None, help="module:name with further feed specs")


def parse(argv=None) -> argparse.Namespace:
    ap = argparse.ArgumentParser(prog="vigil")
    sub = ap.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("run", help="run feeds once, or continuously with --daemon")
    r.add_argument("--landing", required=True)
    r.add_argument("--state", required=True)
    r.add_argument("--outbox", required=True)
    r.add_argument("--logs", required=True)
    r.add_argument("--feed", default="all", help="'all' or a comma-separated list of feed names")
    r.add_argument("--daemon", type=int, default=0, help="repeat every N seconds until interrupted")
    _run_options(r)
    r.add_argument("--one-pass", action="store_true", help="feeds of one export share a scan, a delivery and a commit")
    r.add_argument("--keyset", action="store_true",
                   help="send one event per key by (time, key) and go on behind the last one sent, under --max-events too")
    r.add_argument("--scan-interval-hours", type=float, default=24.0)
    r.add_argument("--min-snapshot-ratio", type=float, default=None)
    r.add_argument("--run-id", type=int, default=None)
    st = sub.add_parser("stream", help="one feed as a Structured Streaming query over its landing folder")
    st.add_argument("--landing", required=True)
    st.add_argument("--root", required=True, help="folder for state, outbox and the stream checkpoint")
    st.add_argument("--feed", required=True)
    st.add_argument("--once", action="store_true", help="availableNow: process what has landed, then stop")
    st.add_argument("--interval", type=int, default=60)
    _run_options(st)
    au = sub.add_parser("audit", help="landed records below a feed's mark that were never sent, by lateness")
    au.add_argument("--landing", required=True)
    au.add_argument("--state", required=True)
    au.add_argument("--feed", required=True)
    au.add_argument("--share", type=float, default=0.99, help="share of the late keys that the lateness is to cover")
    au.add_argument("--registry", default=None, help="module:name with further feed specs")
    sp = sub.add_parser("state", help="look after a state store: list, stats, clear, sweep, migrate")
    sp.add_argument("action", choices=["list", "stats", "clear", "sweep", "migrate"])
    sp.add_argument("--state", required=True)
    sp.add_argument("--feed", default=None, help="feed to clear")
    sp.add_argument("--legacy", default=None, help="folder of legacy documents to migrate")
    sp.add_argument("--retention-days", type=int, default=7)
    sp.add_argument("--max-ids", type=int, default=0)
    sp.add_argument("--now", type=int, default=None)
    return ap.parse_args(argv)


def run_kw(a: argparse.Namespace) -> dict:
    return dict(max_events=a.max_events, batch_size=a.batch_size, max_bytes=a.max_bytes, retention_days=a.retention_days, max_ids=a.max_ids,
                transport=a.transport, buckets=a.state_buckets, include_unlicensed=not a.licensed_only, lateness_s=a.lateness,
                within_run=a.within_run, version_col=a.version_col, emit=a.emit)


def state_command(spark: SparkSession, a: argparse.Namespace) -> list[dict]:
    """Rows per feed; clear, sweep and migrate commit what they do."""
    now = a.now if a.now is not None else int(time.time())
    if a.action == "clear":
        if not a.feed:
            raise ValueError("--feed names the feed to clear")
        S.commit_clear(spark, a.state, a.feed)
    elif a.action == "migrate":
        if not a.legacy:
            raise ValueError("--legacy names the folder of legacy documents")
        S.commit_legacy(readers.legacy_state(spark, a.legacy), a.state, now)
    elif a.action == "sweep":
        return [r.asDict() for r in S.commit_sweep(spark, a.state, now, a.retention_days, a.max_ids).collect()]
    state = S.load(spark, a.state)
    if a.action == "list":
        return [r.asDict() for r in S.feeds(state).orderBy("feed").collect()]
    return [r.asDict() for r in S.stats(state, S.load_marks(spark, a.state), now, a.retention_days).orderBy("feed").collect()]


def audit(spark: SparkSession, a: argparse.Namespace) -> list[dict]:
    """Buckets of lateness, then the lateness that covers ``--share`` of the late keys."""
    reg = load_registry(a.registry)
    spec = reg[R.select_feeds([a.feed], reg)[0]]
    if spec.mode != "incremental" or not spec.epoch_col:
        raise ValueError(f"{spec.feed} has no mark of time to be late for")
    source, _, _ = feed_source(spark, a.landing, spec)
    mark = S.load_marks(spark, a.state).filter(F.col("feed") == spec.feed).agg(F.max("last_timestamp")).first()[0] or 0
    late = lateness.undelivered(feeds.extract(spec, source), S.load(spark, a.state, spec.feed), spec.epoch_col, mark)
    hist = lateness.histogram(late).checkpoint()
    return [*[r.asDict() for r in hist.orderBy("edge_s").collect()],       # 64 rows at most
            {"feed": spec.feed, "mark": int(mark), "lateness_s": lateness.covering(hist, a.share)}]


def stream(spark: SparkSession, a: argparse.Namespace):
    from ..streaming.runner import stream_documents

    reg = load_registry(a.registry)
    spec = reg[R.select_feeds([a.feed], reg)[0]]
    folder = {"assets": "assets", "vulns": "vulns", "compliance": "host_details"}.get(spec.source, spec.source)
    return stream_documents(spark, spec, f"{a.landing.rstrip('/')}/{folder}", a.root, once=a.once,
                            interval_s=a.interval, now=a.now, **run_kw(a))


def run_selected(spark: SparkSession, a: argparse.Namespace, run_id: int, now: int) -> DataFrame:
    reg = load_registry(a.registry)
    names = R.select_feeds(a.feed, reg)
    root = a.landing.rstrip("/")
    # new files of an export are parsed once, for all its incremental feeds and all later runs
    landed = {src: landing.land_new(spark, src, f"{root}/{src}", f"{a.state.rstrip('/')}/_landed/{src}",
                                    f"{a.outbox.rstrip('/')}/_rejects/run={run_id}/{src}")
              for src in sorted({reg[n].source for n in names if reg[n].mode == "incremental"} & set(readers.PARSERS))}
    jobs, kw_by_feed = [], {}
    for name in names:
        spec = reg[name]
        src, cols, raw = feed_source(spark, a.landing, spec, landed)
        jobs.append((spec, src, cols))
        kw_by_feed[name] = raw
    return run_once(spark, jobs, a.state, a.outbox, a.logs, now, run_id, raw_cols=kw_by_feed,
                    one_pass=a.one_pass, keyset=a.keyset, scan_interval_h=a.scan_interval_hours,
                    min_snapshot_ratio=a.min_snapshot_ratio, **run_kw(a))


def main(argv=None, spark: SparkSession | None = None) -> list[dict]:
    a = parse(argv)
    if spark is None:
        from ..session import build_session
        spark = build_session()
    if a.cmd == "stream":
        q = stream(spark, a)
        if not a.once:
            q.awaitTermination()
        return []
    if a.cmd in ("state", "audit"):
        rows = state_command(spark, a) if a.cmd == "state" else audit(spark, a)
        for row in rows:
            print(row, flush=True)
        return rows
    stop = threading.Event()
    previous = {}
    if a.daemon:   # stop between runs; the current run finishes and commits
        for sig in (signal.SIGINT, signal.SIGTERM):
            previous[sig] = signal.signal(sig, lambda *_: stop.set())
    summaries, run_id = [], a.run_id if a.run_id is not None else int(time.time())
    try:
        while True:
            now = a.now if a.now is not None else int(time.time())
            summaries.append(run_selected(spark, a, run_id, now).first().asDict())
            print(summaries[-1], flush=True)
            if not a.daemon or stop.wait(a.daemon):
                return summaries
            run_id += 1
    finally:
        for sig, handler in previous.items():
            signal.signal(sig, handler)
