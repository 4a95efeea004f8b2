"""End to end through the command line over a landing zone with all eight document sources."""

import gzip
import glob
import json
import os

from landing_files import write_lines
from vigil.plans.cli import main

NOW = 1_800_000_000

ASSETS = [
    {"id": "a1", "updated_at": "2026-01-02T00:00:00Z", "is_deleted": False, "has_agent": True,
     "sources": ["NESSUS_AGENT"], "has_plugin_results": True, "extra": {"k": [1, 2]}},
    {"id": "a2", "updated_at": "2026-01-03T00:00:00.5Z", "is_deleted": True, "sources": ["NESSUS_SCAN"]},
    {"id": "a3", "updated_at": "1767225600", "is_terminated": True, "terminated_at": None,
     "sources": ["NESSUS_AGENT"], "has_agent": None},
    {"id": "a4", "updated_at": "2026-01-05T00:00:00Z", "is_terminated": True,
     "terminated_at": "2026-01-04T00:00:00Z", "has_plugin_results": True},
]
VULNS = [
    {"asset": {"uuid": "u1", "has_agent": False}, "plugin": {"id": 10}, "port": {"port": 443, "protocol": "tcp"},
     "severity": "high", "state": "OPEN", "last_found": "2026-01-01T00:00:00Z"},
    {"asset": {"uuid": "u1", "has_agent": True}, "plugin": {"id": 11}, "severity": "high", "state": "OPEN",
     "last_found": "2026-01-01T00:00:00Z"},
    {"asset": {"uuid": "u2"}, "plugin": {"id": 12}, "port": {"port": 80, "protocol": "udp"}, "severity": "info",
     "state": "OPEN", "last_found": "2026-01-01T00:00:00Z"},
]


def landing(root):
    docs = {
        "assets": ASSETS, "vulns": VULNS,
        "families": [{"id": 1, "name": "Web"}, {"id": 2, "name": "DB"}],
        "family_details": [{"family_id": 1, "plugins": [{"id": 10}, {"id": 11}]}],
        "plugin_details": [{"id": 10, "family_name": "stale", "risk": "low"}],
        "scans": [{"id": 1, "name": "s1", "status": "completed", "last_modification_date": 100},
                  {"id": 2, "name": "s2", "status": "completed", "last_modification_date": 50},
                  {"id": 3, "name": "s3", "status": "running", "last_modification_date": 200}],
        "scan_details": [{"scan_id": 1, "hosts": [{"host_id": 7, "hostname": "h7"}, {"host_id": 8, "hostname": "h8"}]}],
        "host_details": [{"scan_id": 1, "host_id": 7, "compliance": [{"plugin_id": 5, "x": 1}, {"plugin_id": 5, "x": 2}]}],
    }
    for name, rows in docs.items():
        write_lines(os.path.join(root, name), [json.dumps(r) for r in rows])
    return root


def lines(outbox, run, feed):
    out = []
    for p in glob.glob(os.path.join(outbox, f"run={run}", f"feed={feed}", "*.json.gz")):
        out += [json.loads(x) for x in gzip.decompress(open(p, "rb").read()).decode().split("\n")]
    return out


def test_cli_runs_all_feeds_and_second_run_is_quiet(spark, tmp_root):
    land = landing(os.path.join(tmp_root, "landing"))
    dirs = {k: os.path.join(tmp_root, k) for k in ("state", "outbox", "logs")}
    args = ["run", "--landing", land, "--state", dirs["state"], "--outbox", dirs["outbox"], "--logs", dirs["logs"]]
    s1 = main(args + ["--now", str(NOW), "--run-id", "1"], spark=spark)[0]
    assert s1["failed_feeds"] == 0 and s1["feeds"] == 10
    log = {r.feed: r.event_count for r in spark.read.parquet(os.path.join(dirs["logs"], "run_log")).collect()}
    assert log == {"asset": 3, "asset_self_scan": 1, "deleted_asset": 0, "terminated_asset": 1, "vulnerability": 2,
                   "vulnerability_no_info": 1, "vulnerability_self_scan": 1, "fixed_vulnerability": 0, "plugin": 1,
                   "compliance": 2}
    assert s1["total_events"] == 12
    from vigil.operators import metrics
    done = {r.feed: r for r in metrics.feed_completion(spark.read.parquet(os.path.join(dirs["logs"], "run_log")))
            .collect()}
    assert done["asset"].processed == 3 and done["asset"].sent == 3 and done["plugin"].sent == 1

    # the delivered event is the landed document, byte for byte
    asset_events = {e["event"]["id"]: e for e in lines(dirs["outbox"], 1, "asset")}
    assert asset_events["a1"]["event"] == ASSETS[0]
    assert asset_events["a1"]["fields"] == {"feed_type": "asset", "feed_name": "Asset Inventory"}
    plugin = lines(dirs["outbox"], 1, "plugin")[0]["event"]
    assert plugin["family_name"] == "Web" and plugin["family_id"] == 1 and plugin["risk"] == "low"
    comp = sorted(e["event"]["compliance_data"]["x"] for e in lines(dirs["outbox"], 1, "compliance"))
    assert comp == [1, 2]

    s2 = main(args + ["--now", str(NOW + 100), "--run-id", "2"], spark=spark)[0]
    assert s2["total_events"] == 0 and s2["failed_feeds"] == 0
    status = {(r.run_id, r.feed): r.status for r in spark.read.parquet(os.path.join(dirs["logs"], "run_log")).collect()}
    assert status[("2", "deleted_asset")] == "skipped"            # inside the 24 h full-scan gate


def test_cli_rejects_unknown_feed(spark, tmp_root):
    import pytest

    with pytest.raises(ValueError):
        main(["run", "--landing", tmp_root, "--state", tmp_root, "--outbox", tmp_root, "--logs", tmp_root,
              "--feed", "asset,bogus", "--now", "1"], spark=spark)


def test_cli_stream_once_is_incremental_across_runs(spark, tmp_root):
    land = os.path.join(tmp_root, "landing")
    root = os.path.join(tmp_root, "stream")
    write_lines(os.path.join(land, "vulns"), [json.dumps(v) for v in VULNS])
    args = ["stream", "--landing", land, "--root", root, "--feed", "vulnerability", "--once", "--now", str(NOW)]
    main(args, spark=spark)
    sent = [json.loads(x) for p in glob.glob(os.path.join(root, "outbox", "run=*", "feed=vulnerability", "*.json.gz"))
            for x in gzip.decompress(open(p, "rb").read()).decode().split("\n")]
    assert sorted(e["event"]["plugin"]["id"] for e in sent) == [10, 11]
    # a new file: one repeated document and one new key
    new = dict(VULNS[0], plugin={"id": 99})
    with open(os.path.join(land, "vulns", "part-1.json"), "w") as f:
        f.write(json.dumps(VULNS[0]) + "\n" + json.dumps(new) + "\n")
    main(args, spark=spark)
    batch1 = [json.loads(x) for p in glob.glob(os.path.join(root, "outbox", "run=1", "feed=vulnerability", "*.json.gz"))
              for x in gzip.decompress(open(p, "rb").read()).decode().split("\n")]
    assert [e["event"]["plugin"]["id"] for e in batch1] == [99]


def test_cli_daemon_stops_on_sigterm_and_restores_handlers(spark, tmp_root):
    import signal
    import threading

    land = landing(os.path.join(tmp_root, "landing"))
    args = ["run", "--landing", land, "--state", os.path.join(tmp_root, "s"), "--outbox",
            os.path.join(tmp_root, "o"), "--logs", os.path.join(tmp_root, "g"), "--feed", "asset",
            "--daemon", "1", "--now", str(NOW), "--run-id", "1"]
    before = signal.getsignal(signal.SIGTERM)
    timer = threading.Timer(3.0, lambda: os.kill(os.getpid(), signal.SIGTERM))
    timer.start()
    try:
        summaries = main(args, spark=spark)
    finally:
        timer.cancel()
    assert len(summaries) >= 1 and summaries[0]["total_events"] == 3
    assert signal.getsignal(signal.SIGTERM) == before


def test_cli_streams_compliance_from_new_host_details(spark, tmp_root):
    land = landing(os.path.join(tmp_root, "landing"))
    root = os.path.join(tmp_root, "stream")
    args = ["stream", "--landing", land, "--root", root, "--feed", "compliance", "--once", "--now", str(NOW)]
    main(args, spark=spark)
    # a new host-detail document for the other host of the completed scan
    with open(os.path.join(land, "host_details", "part-1.json"), "w") as f:
        f.write(json.dumps({"scan_id": 1, "host_id": 8, "compliance": [{"plugin_id": 6, "x": 3}]}) + "\n")
    main(args, spark=spark)
    sent = {}
    for run in (0, 1):
        sent[run] = [json.loads(x)["event"] for p in glob.glob(os.path.join(root, "outbox", f"run={run}",
                                                                            "feed=compliance", "*.json.gz"))
                     for x in gzip.decompress(open(p, "rb").read()).decode().split("\n")]
    assert sorted(e["compliance_data"]["x"] for e in sent[0]) == [1, 2]
    assert [(e["host_id"], e["hostname"], e["compliance_data"]["x"]) for e in sent[1]] == [(8, "h8", 3)]


EXTRA = None    # set by the test below; read by --registry


def _dirs(root):
    return ["--state", os.path.join(root, "s"), "--outbox", os.path.join(root, "o"), "--logs", os.path.join(root, "g")]


def test_cli_run_options_reach_the_feed(spark, tmp_root):
    land = os.path.join(tmp_root, "landing")
    v = dict(VULNS[0], is_licensed=True)
    write_lines(os.path.join(land, "vulns"), [json.dumps(x) for x in (
        v, v, dict(VULNS[1], is_licensed=False), dict(v, plugin={"id": 77}, last_found="2026-01-01T00:00:10Z"))]
        + ['{"asset": {"uuid": "torn'])
    args = ["run", "--landing", land, "--feed", "vulnerability", "--now", str(NOW), "--run-id", "1"]
    first = main(args + _dirs(os.path.join(tmp_root, "a")) + ["--licensed-only", "--within-run", "first"], spark=spark)[0]
    assert first["total_events"] == 2                       # no unlicensed one, one per key, no torn line
    assert os.path.exists(os.path.join(tmp_root, "a", "o", "_rejects", "run=1", "vulns"))
    assert main(args + _dirs(os.path.join(tmp_root, "b")), spark=spark)[0]["total_events"] == 4
    # lateness looks below the mark again; the state still keeps what was sent
    late = _dirs(os.path.join(tmp_root, "c"))
    main(["run", "--landing", land, "--feed", "vulnerability", "--now", "1767225605", "--run-id", "1", *late], spark=spark)
    write_lines(os.path.join(land, "vulns"), [json.dumps(dict(v, plugin={"id": 99}))])
    again = ["run", "--landing", land, "--feed", "vulnerability", "--now", str(NOW), "--run-id", "2", *late]
    assert main(again, spark=spark)[0]["total_events"] == 0
    again[again.index("2")] = "3"
    assert main([*again, "--lateness", "60"], spark=spark)[0]["total_events"] == 1


def test_cli_cap_keeps_the_newest_and_counts_the_trimmed(spark, tmp_root):
    from vigil.operators import state as S

    land, dirs = os.path.join(tmp_root, "landing"), _dirs(tmp_root)
    write_lines(os.path.join(land, "vulns"), [json.dumps(dict(VULNS[0], plugin={"id": i}, last_found=f"2026-01-0{9 - i}T00:00:00Z"))
                                              for i in range(1, 9)])
    s = main(["run", "--landing", land, "--feed", "vulnerability", "--now", str(NOW), "--run-id", "1", "--max-ids", "3", *dirs],
             spark=spark)[0]
    assert s["trimmed"] == 5 and s["per_feed"][0]["trimmed"] == 5
    assert sorted(r.item_id for r in S.load(spark, dirs[1]).collect()) == [f"u1_{i}_443_tcp" for i in (1, 2, 3)]


def test_cli_versions_and_further_feeds(spark, tmp_root):
    import sys

    from pyspark.sql import functions as F

    from vigil.plans import registry as R

    land, dirs = os.path.join(tmp_root, "landing"), _dirs(tmp_root)
    write_lines(os.path.join(land, "assets"), [json.dumps({"id": "x", "updated_at": "2026-01-02T00:00:00Z"})])
    args = ["run", "--landing", land, "--feed", "asset", "--version-col", "updated_epoch", *dirs]
    assert main(args + ["--now", str(NOW), "--run-id", "1"], spark=spark)[0]["total_events"] == 1
    write_lines(os.path.join(land, "assets"), [json.dumps({"id": "x", "updated_at": "2026-01-03T00:00:00Z"})])
    assert main(args + ["--now", str(NOW + 1), "--run-id", "2"], spark=spark)[0]["total_events"] == 1
    module = sys.modules[__name__]
    module.EXTRA = R.FeedSpec("agents", "assets", "agents", "Agents", "agents", 20, source="assets",
                              predicate=lambda: F.col("id") == "x", key=lambda: F.col("id"), epoch_col="updated_epoch")
    got = main(["run", "--landing", land, "--feed", "agents", "--registry", f"{__name__}:EXTRA", "--now", str(NOW),
                "--run-id", "3", *dirs], spark=spark)[0]
    assert got["total_events"] == 1 and got["per_feed"][0]["feed"] == "agents"


def test_cli_summary_has_retries_and_errors(spark, tmp_root):
    land, dirs = landing(os.path.join(tmp_root, "landing")), _dirs(tmp_root)
    s = main(["run", "--landing", land, "--feed", "vulnerability,plugin", "--now", str(NOW), "--run-id", "1",
              "--transport", "python:failing_transport:FailingFolder:{outbox}?fail_match=u1_", *dirs], spark=spark)[0]
    assert s["failed_batches"] == 0 and s["recent_errors"] == []
    s = main(["run", "--landing", land, "--feed", "vulnerability_no_info", "--now", str(NOW), "--run-id", "2",
              "--transport", 'python:failing_transport:FailingFolder:{outbox}?fail_match="u2"', *dirs], spark=spark)[0]
    assert (s["retries"], s["failed_batches"]) == (3, 1)
    s = main(["run", "--landing", land, "--feed", "vulnerability", "--now", str(NOW), "--run-id", "3",
              "--transport", "bogus:x", "--lateness", "999999999", *_dirs(os.path.join(tmp_root, "n"))], spark=spark)[0]
    assert s["failed_feeds"] == 1 and len(s["recent_errors"]) == 1 and s["recent_errors"][0]["error_id"] == 1


def test_cli_state_commands(spark, tmp_root):
    from vigil.operators import state as S

    land, dirs = landing(os.path.join(tmp_root, "landing")), _dirs(tmp_root)
    main(["run", "--landing", land, "--feed", "asset,vulnerability,vulnerability_no_info", "--now", str(NOW), "--run-id", "1",
          *dirs], spark=spark)
    state = ["--state", dirs[1], "--now", str(NOW)]
    assert [r["feed"] for r in main(["state", "list", *state], spark=spark)] == ["asset", "vulnerability", "vulnerability_no_info"]
    stats = {r["feed"]: r for r in main(["state", "stats", *state], spark=spark)}
    assert stats["vulnerability_no_info"]["last_timestamp"] == NOW and stats["asset"]["active_ids"] == 3
    main(["state", "clear", "--feed", "asset", *state], spark=spark)
    assert sorted(r.feed for r in S.feeds(S.load(spark, dirs[1])).collect()) == ["vulnerability", "vulnerability_no_info"]
    swept = main(["state", "sweep", "--state", dirs[1], "--now", str(NOW + 30 * 86400)], spark=spark)
    assert swept == [] and S.load(spark, dirs[1]).count() == 0
    old = write_lines(os.path.join(tmp_root, "legacy"), [json.dumps({"feed": "asset", "processed_ids": ["q"], "last_timestamp": 7})])
    main(["state", "migrate", "--legacy", old, *state], spark=spark)
    assert {r["feed"]: r["last_timestamp"] for r in main(["state", "stats", *state], spark=spark)} == {"asset": 7}
    assert S.load(spark, dirs[1]).count() == 1


def test_compliance_stream_waits_for_its_scan(spark, tmp_root):
    land, root = landing(os.path.join(tmp_root, "landing")), os.path.join(tmp_root, "r")
    host = {"scan_id": 3, "host_id": 7, "compliance": [{"plugin_id": 5, "x": 9}]}
    with open(os.path.join(land, "host_details", "part-1.json"), "w") as f:
        f.write(json.dumps(host) + "\n")
    with open(os.path.join(land, "scan_details", "part-1.json"), "w") as f:
        f.write(json.dumps({"scan_id": 3, "hosts": [{"host_id": 7}]}) + "\n")
    args = ["stream", "--landing", land, "--root", root, "--feed", "compliance", "--once", "--now", str(NOW)]

    def sent():
        return sorted((e["event"]["scan_id"], e["event"]["compliance_data"]["x"], e["event"]["hostname"])
                      for p in glob.glob(os.path.join(root, "outbox", "run=*", "feed=compliance", "*.json.gz"))
                      for e in map(json.loads, gzip.decompress(open(p, "rb").read()).decode().split("\n")))
    main(args, spark=spark)
    assert sent() == [(1, 1, "h7"), (1, 2, "h7")]
    with open(os.path.join(land, "scans", "part-1.json"), "w") as f:
        f.write(json.dumps({"id": 3, "name": "s3", "status": "completed", "last_modification_date": 300}) + "\n")
    main(args, spark=spark)
    assert sent() == [(1, 1, "h7"), (1, 2, "h7"), (3, 9, "unknown")]
    main(args, spark=spark)
    assert len(sent()) == 3
