"""Ordered runs under a compound mark (epoch, key)."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from vigil.operators import sink
from vigil.operators import state as S
from vigil.plans import feeds, registry as R
from vigil.plans.run import run_feed

NOW = 1_800_000_000
SPEC = R.REGISTRY["asset"]


def landed(spark, root, rows):
    """(id, updated_epoch) records as a typed table on disk."""
    path = os.path.join(root, "typed")
    spark.createDataFrame(rows, "id string, updated_epoch bigint").withColumn("is_deleted", F.lit(False)).write.mode(
        "overwrite").parquet(path)
    return spark.read.parquet(path)


def sent(spark, ob, run_no):
    files = glob.glob(f"{ob}/run={run_no}/feed=asset/*.gz")
    rows = [json.loads(r["event"]) for r in sink.read_outbox(spark, files).collect()] if files else []
    return sorted((e["updated_epoch"] or -1, e["id"] or "") for e in rows)


def run(spark, src, root, n, **kw):
    return run_feed(spark, SPEC, src, f"{root}/s", f"{root}/o", NOW + n, n, ["id", "updated_epoch"], keyset=True, **kw)


def test_capped_runs_send_all_once_in_order(spark, tmp_root):
    # a second that holds more events than the cap, a key seen twice, ties in the key across seconds
    rows = [(f"k{i:02d}", 100) for i in range(7)] + [("a", 50), ("a", 300), ("b", 200), ("é", 200), ("z", 400)]
    src = landed(spark, tmp_root, rows)
    got, marks = [], []
    for n in range(1, 6):
        r = run(spark, src, tmp_root, n, max_events=3)
        got.append(sent(spark, f"{tmp_root}/o", n))
        marks.append((r.new_mark, S.mark_key(spark, f"{tmp_root}/s", "asset")))
    want = sorted({(e, k) for k, e in rows if (k, e) != ("a", 300)})
    assert [x for part in got for x in part] == want
    assert [len(p) for p in got] == [3, 3, 3, 2, 0]
    assert marks[0] == (100, "k01") and marks[3] == marks[4] == (400, "z")


def test_a_later_run_reads_behind_the_mark_only(spark, tmp_root):
    src = landed(spark, tmp_root, [("a", 100), ("b", 100), ("c", 200)])
    run(spark, src, tmp_root, 1, max_events=1)
    plan = feeds.extract(SPEC, src, mark=100, mark_key="a")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(updated_epoch,100)" in plan
    assert [r["id"] for r in feeds.extract(SPEC, src, mark=100, mark_key="a").orderBy("id").collect()] == ["b", "c"]


def test_null_keys_null_and_bad_times(spark, tmp_root):
    # records without a key are events of their own; null and non-positive times go first and make no mark
    rows = [(None, 100), (None, 200), (None, 200), ("n", None), ("zero", 0), ("a", 100)]
    src = landed(spark, tmp_root, rows)
    path = os.path.join(tmp_root, "more")
    src.withColumn("x", F.monotonically_increasing_id()).write.parquet(path)
    src, got = spark.read.parquet(path), []
    for n in range(1, 5):
        run(spark, src, tmp_root, n, max_events=2)
        got += [(n, x) for x in sent(spark, f"{tmp_root}/o", n)]
    assert sorted(x for _, x in got) == [(-1, "n"), (-1, "zero"), (100, ""), (100, "a"), (200, ""), (200, "")]
    assert [n for n, _ in got] == [1, 1, 2, 2, 3, 3]


def test_a_failed_batch_holds_the_mark_before_its_first_event(spark, tmp_root):
    src = landed(spark, tmp_root, [(f"k{i}", 100 + i) for i in range(6)])
    kw = dict(batch_size=1, transport=f"python:failing_transport:FailingFolder:{tmp_root}/o/run=1/feed=asset?fail_match=k3")
    r1 = run(spark, src, tmp_root, 1, **kw)
    assert r1.failed_batches == 1 and r1.new_mark == 102
    assert S.mark_key(spark, f"{tmp_root}/s", "asset") == "k2"
    r2 = run(spark, src, tmp_root, 2)
    assert sent(spark, f"{tmp_root}/o", 2) == [(103, "k3")] and r2.new_mark == 103


def test_plain_run_after_an_ordered_one_loses_nothing(spark, tmp_root):
    src = landed(spark, tmp_root, [("a", 100), ("b", 100), ("c", 100), ("d", 200)])
    run(spark, src, tmp_root, 1, max_events=1)
    r = run_feed(spark, SPEC, src, f"{tmp_root}/s", f"{tmp_root}/o", NOW + 2, 2, ["id", "updated_epoch"])
    assert r.events == 3 and r.new_mark == 200
    assert S.mark_key(spark, f"{tmp_root}/s", "asset") is None
    # forgetting a feed forgets both halves of its mark
    run(spark, src.withColumn("updated_epoch", F.col("updated_epoch") + 500).withColumn("id", F.concat("id", F.lit("2"))),
        tmp_root, 3, max_events=1)
    assert S.mark_key(spark, f"{tmp_root}/s", "asset") == "a2"
    S.commit_clear(spark, f"{tmp_root}/s", "asset")
    assert S.mark_key(spark, f"{tmp_root}/s", "asset") is None


def test_ordered_runs_refuse_versions_and_streams(spark, tmp_root):
    src = landed(spark, tmp_root, [("a", 1)])
    for kw in ({"version_col": "updated_epoch"}, {"stream_batch": 0}):
        with pytest.raises(ValueError):
            run(spark, src, tmp_root, 1, **kw)


def test_cap_over_far_apart_times(spark, tmp_root):
    rows = [("a", -(1 << 62)), ("b", 5), ("c", 1 << 41), ("d", 1 << 61), ("e", 1 << 61), ("f", None)]
    df = spark.createDataFrame(rows, "_order_key string, updated_epoch bigint")
    order = ["f", "a", "b", "c", "d", "e"]
    for n in range(1, 6):
        assert sorted(r[0] for r in feeds.cap_keyset(df, n, "updated_epoch").select("_order_key").collect()) == sorted(order[:n])
