import json
import os

import pytest
from pyspark.sql import functions as F

from landing_files import write_lines
from vigil.operators import state as S
from vigil.plans import feeds, registry as R
from vigil.plans.run import run_feed, run_once
from vigil.sources import readers

NOW = 1_800_000_000


def assets_docs(ids, ts="2026-01-01T00:00:00Z", scanned=True):
    return [json.dumps({"id": i, "updated_at": ts, "is_deleted": False, "has_plugin_results": scanned}) for i in ids]


def test_versioned_key_resends_changed_records(spark, tmp_root):
    spec = R.REGISTRY["asset"]
    sb, ob = os.path.join(tmp_root, "s"), os.path.join(tmp_root, "o")
    a1 = readers.assets(spark, write_lines(os.path.join(tmp_root, "a1"), assets_docs(["x", "y"])))
    assert run_feed(spark, spec, a1, sb, ob, NOW, 1, ["id"], version_col="updated_epoch").events == 2
    a2 = readers.assets(spark, write_lines(os.path.join(tmp_root, "a2"),
                                           assets_docs(["x"], "2026-02-01T00:00:00Z") + assets_docs(["y"])))
    # data-driven mark moved to 2026-01-01; y is unchanged and at the mark, x changed after it
    r2 = run_feed(spark, spec, a2, sb, ob, NOW + 10, 2, ["id"], version_col="updated_epoch")
    assert r2.events == 1
    assert r2.new_mark == 1769904000          # 2026-02-01


def test_deleted_assets_scan_gate_and_diff(spark, tmp_root):
    spec = R.REGISTRY["deleted_asset"]
    sb, ob = os.path.join(tmp_root, "s"), os.path.join(tmp_root, "o")
    snap1 = readers.assets(spark, write_lines(os.path.join(tmp_root, "a1"), assets_docs(["a", "b", "c"])))
    r1 = run_feed(spark, spec, snap1, sb, ob, NOW, 1, ["asset_id", "event_type"], scan_interval_h=24)
    assert r1.events == 0 and not r1.skipped           # first run only builds the baseline
    snap2 = readers.assets(spark, write_lines(os.path.join(tmp_root, "a2"), assets_docs(["a"])))
    gated = run_feed(spark, spec, snap2, sb, ob, NOW + 3600, 2, ["asset_id"], scan_interval_h=24)
    assert gated.skipped
    r3 = run_feed(spark, spec, snap2, sb, ob, NOW + 25 * 3600, 3, ["asset_id", "event_type"], scan_interval_h=24)
    assert r3.events == 2
    sent = spark.read.text(os.path.join(ob, "run=3", f"feed={spec.feed}")).select(
        F.get_json_object("value", "$.event.asset_id").alias("a")).collect()
    assert sorted(r.a for r in sent) == ["b", "c"]


def test_run_once_records_failing_feed_and_continues(spark, tmp_root):
    sb, ob, lb = (os.path.join(tmp_root, x) for x in ("s", "o", "l"))
    full = readers.assets(spark, write_lines(os.path.join(tmp_root, "a1"), assets_docs([str(i) for i in range(10)])))
    run_feed(spark, R.REGISTRY["deleted_asset"], full, sb, ob, NOW, 1, ["asset_id"])
    empty = readers.assets(spark, write_lines(os.path.join(tmp_root, "a2"), assets_docs([])))
    jobs = [(R.REGISTRY["deleted_asset"], empty, ["asset_id"]), (R.REGISTRY["asset"], full, ["id"])]
    summary = run_once(spark, jobs, sb, ob, lb, NOW + 100, 2, min_snapshot_ratio=0.5).first()
    assert summary.failed_feeds == 1 and summary.total_errors == 1 and summary.total_events == 10
    log = spark.read.parquet(os.path.join(lb, "run_log")).collect()
    assert {(r.feed, r.status) for r in log} == {("deleted_asset", "error"), ("asset", "ok")}


def test_cap_rows_is_a_total_order(spark):
    df = spark.range(0, 300).select((F.col("id") % 30).cast("string").alias("item_id"), "id")
    got = [sorted(map(tuple, feeds.cap_rows(x, 50, feeds.cap_order(x)).collect())) for x in (df, df.orderBy(F.rand(1)))]
    assert got[0] == got[1] and len(got[0]) == 50


@pytest.mark.parametrize("emit,third", [("until_expiry", ["b", "c"]), ("once", [])])
def test_snapshot_feed_reports_until_expiry_or_once(spark, tmp_root, emit, third):
    spec = R.REGISTRY["deleted_asset"]
    sb, ob = os.path.join(tmp_root, "s"), os.path.join(tmp_root, "o")
    snap1 = readers.assets(spark, write_lines(os.path.join(tmp_root, "a1"), assets_docs(["a", "b", "c"])))
    snap2 = readers.assets(spark, write_lines(os.path.join(tmp_root, "a2"), assets_docs(["a"])))
    run_feed(spark, spec, snap1, sb, ob, NOW, 1, ["asset_id"], emit=emit)
    assert run_feed(spark, spec, snap2, sb, ob, NOW + 100, 2, ["asset_id"], emit=emit).events == 2
    r3 = run_feed(spark, spec, snap2, sb, ob, NOW + 200, 3, ["asset_id"], emit=emit)
    assert r3.events == len(third)
    # vanished keys keep their first-run stamp, so they expire on schedule
    seen = {r.item_id: r.seen_at for r in S.load(spark, sb).collect()}
    if emit == "until_expiry":
        assert seen["b"] < seen["a"]
    else:
        assert "b" not in seen


def test_rerun_of_same_run_id_counts_once(spark, tmp_root):
    spec = R.REGISTRY["asset"]
    sb, ob = os.path.join(tmp_root, "s"), os.path.join(tmp_root, "o")
    a = readers.assets(spark, write_lines(os.path.join(tmp_root, "a"), assets_docs(["x", "y", "z"])))
    first = run_feed(spark, spec, a, sb, ob, NOW, 7, ["id"], state_version=0, commit_version=1)
    again = run_feed(spark, spec, a, sb, ob, NOW, 7, ["id"], state_version=0, commit_version=1)
    assert (first.events, first.delivered_events) == (3, 3)
    assert (again.events, again.delivered_events, again.failed_batches) == (3, 3, 0)
    assert S.load(spark, sb).count() == 3


def test_bucketed_state_gives_the_same_runs(spark, tmp_root):
    spec = R.REGISTRY["asset"]
    dirs = {n: (os.path.join(tmp_root, f"s{n}"), os.path.join(tmp_root, f"o{n}")) for n in (0, 3)}
    for run, ids in ((1, "abc"), (2, "bcde"), (3, "bcde")):
        ts = f"2026-01-0{run}T00:00:00Z"
        a = readers.assets(spark, write_lines(os.path.join(tmp_root, f"a{run}"), assets_docs(list(ids), ts)))
        got = {n: run_feed(spark, spec, a, *dirs[n], NOW + run, run, ["id"], buckets=n) for n in dirs}
        assert (got[0].events, got[0].new_mark) == (got[3].events, got[3].new_mark) and got[3].events == {1: 3, 2: 2, 3: 0}[run]
    assert sorted(map(tuple, S.load(spark, dirs[3][0]).collect())) == sorted(map(tuple, S.load(spark, dirs[0][0]).collect()))
    assert S.load(spark, dirs[3][0]).count() == 5


def test_failed_snapshot_feed_is_due_again(spark, tmp_root):
    """A refused batch does not wait for the next full scan."""
    spec = R.REGISTRY["deleted_asset"]
    sb, ob = os.path.join(tmp_root, "s"), os.path.join(tmp_root, "o")
    snap1 = readers.assets(spark, write_lines(os.path.join(tmp_root, "a1"), assets_docs(["a", "b"])))
    snap2 = readers.assets(spark, write_lines(os.path.join(tmp_root, "a2"), assets_docs(["a"])))
    run_feed(spark, spec, snap1, sb, ob, NOW, 1, ["asset_id"], scan_interval_h=24)
    failed = run_feed(spark, spec, snap2, sb, ob, NOW + 25 * 3600, 2, ["asset_id"], scan_interval_h=24,
                      transport="python:failing_transport:FailingFolder:{outbox}?fail=1")
    assert (failed.events, failed.delivered_events, failed.failed_batches) == (1, 0, 1)
    again = run_feed(spark, spec, snap2, sb, ob, NOW + 26 * 3600, 3, ["asset_id"], scan_interval_h=24)
    assert not again.skipped and again.delivered_events == 1
