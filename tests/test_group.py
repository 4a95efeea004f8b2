"""A group run equals single runs of its feeds: events, marks, states; one reading of the export."""

import glob
import gzip
import json
import os
from collections import Counter

from landing_files import write_lines

from vigil.operators import state as S
from vigil.plans import registry as R
from vigil.plans.cli import SNAPSHOT_RECORDS, main
from vigil.plans.group import run_group
from vigil.plans.run import run_feed
from vigil.sources import readers

NOW = 1_800_000_000
FEEDS = ["vulnerability", "vulnerability_no_info", "vulnerability_self_scan", "fixed_vulnerability"]
SPECS = [R.REGISTRY[f] for f in FEEDS]


def vuln(i, severity="high", state="OPEN", agent=False):
    return json.dumps({"asset": {"uuid": f"u{i}", "has_agent": agent}, "plugin": {"id": i}, "severity": severity,
                       "port": {"port": 1, "protocol": "tcp"}, "state": state, "last_found": "2026-01-01T00:00:00Z"})


def sent(outbox, run):
    out = Counter()
    for p in glob.glob(os.path.join(outbox, f"run={run}", "*", "*.json.gz")):
        for x in gzip.decompress(open(p, "rb").read()).decode().split("\n"):
            e = json.loads(x)
            body = e["event"]
            out[e["fields"]["feed_type"], e["fields"]["feed_name"], e["sourcetype"], e["time"], json.dumps(body, sort_keys=True)] += 1
    return out


def marks(spark, state):
    return {r.feed: tuple(r)[1:] for r in S.load_marks(spark, state).collect()}


def test_group_equals_single_runs(spark, tmp_root):
    first = [vuln(i, "info" if i % 4 == 0 else "high", "FIXED" if i % 5 == 0 else "OPEN", i % 3 == 0) for i in range(40)]
    second = first[10:] + [vuln(100 + i, agent=True) for i in range(5)]
    one, many = os.path.join(tmp_root, "one"), os.path.join(tmp_root, "many")
    for n, docs in ((1, first), (2, second), (3, second)):
        src = readers.vulns(spark, write_lines(os.path.join(tmp_root, f"v{n}"), docs))
        got = run_group(spark, SPECS, src, f"{one}/s", f"{one}/o", NOW + n, n, "raw", emit="once", buckets=4)
        for spec in SPECS:
            r = run_feed(spark, spec, src, f"{many}/s", f"{many}/o", NOW + n, n, SNAPSHOT_RECORDS["vulns"], raw_col="raw", emit="once")
            assert (r.events, r.delivered_events, r.old_mark, r.new_mark) == (
                got[spec.feed].events, got[spec.feed].delivered_events, got[spec.feed].old_mark, got[spec.feed].new_mark), spec.feed
        assert sent(f"{one}/o", n) == sent(f"{many}/o", n)
        assert marks(spark, f"{one}/s") == marks(spark, f"{many}/s")
        assert sorted(map(tuple, S.load(spark, f"{one}/s").collect())) == sorted(map(tuple, S.load(spark, f"{many}/s").collect()))
    assert sum(sent(f"{one}/o", 1).values()) > 40 and sum(sent(f"{one}/o", 2).values()) > 5 and not sent(f"{one}/o", 3)


def test_group_reads_its_export_once(spark, tmp_root):
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for b in batches:
            seen.add(len(b))
            yield b
    src = readers.vulns(spark, write_lines(os.path.join(tmp_root, "v"), [vuln(i, agent=True) for i in range(30)]))
    src = src.mapInPandas(look, src.schema)
    got = run_group(spark, SPECS, src, f"{tmp_root}/s", f"{tmp_root}/o", NOW, 1, "raw")
    assert {f: r.events for f, r in got.items()} == dict(zip(FEEDS, (30, 0, 30, 0), strict=True)) and seen.value == 30


def test_failed_and_capped_feeds_of_a_group_keep_their_marks(spark, tmp_root):
    docs = [vuln(i, "info" if i % 2 else "high") for i in range(12)] + [json.dumps({"severity": "info"})]
    src = readers.vulns(spark, write_lines(os.path.join(tmp_root, "v"), docs))
    dirs = (f"{tmp_root}/s", f"{tmp_root}/o")
    got = run_group(spark, SPECS[:2], src, *dirs, NOW, 1, "raw", batch_size=1, max_events=6,
                    transport='python:failing_transport:FailingFolder:{outbox}?fail_match="u4"')
    assert got["vulnerability"].failed_batches == 1 and got["vulnerability"].delivered_events == 5
    assert got["vulnerability"].new_mark == 0
    assert got["vulnerability_no_info"].truncated and got["vulnerability_no_info"].new_mark == 0
    again = run_group(spark, SPECS[:2], src, *dirs, NOW + 1, 2, "raw")
    assert {f: (r.events, r.new_mark) for f, r in again.items()} == {"vulnerability": (1, NOW + 1), "vulnerability_no_info": (1, NOW + 1)}
    assert sum((sent(dirs[1], 1) + sent(dirs[1], 2)).values()) == 13


def test_one_pass_of_the_command_line_has_group_totals(spark, tmp_root):
    land = os.path.join(tmp_root, "land")
    write_lines(os.path.join(land, "vulns"), [vuln(i, "info" if i % 2 else "high") for i in range(6)])
    args = ["run", "--landing", land, "--state", f"{tmp_root}/s", "--outbox", f"{tmp_root}/o", "--logs", f"{tmp_root}/g",
            "--feed", ",".join(FEEDS), "--now", str(NOW), "--run-id", "1", "--one-pass"]
    s = main(args, spark=spark)[0]
    assert s["failed_feeds"] == 0 and s["total_events"] == 6
    assert [tuple(x) for x in s["per_group"]] == [("vulnerabilities", 4, 6)]
    assert sum(sent(f"{tmp_root}/o", 1).values()) == 6 and os.path.isdir(f"{tmp_root}/o/run=1/group=vulnerabilities")
    args[args.index("1")] = "2"
    assert main(args, spark=spark)[0]["total_events"] == 0
