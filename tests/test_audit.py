"""Late-arrival audit, progress of a delivery, and what a document holds at a path."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from landing_files import write_lines
from vigil.functions import exprs as X
from vigil.operators import filters as P
from vigil.operators import lateness, metrics
from vigil.plans import cli

ROWS = [("a", 100), ("b", 99), ("c", 90), ("c", 40), ("d", 40), ("e", 101), ("f", None), (None, 10), ("g", 30), ("h", 20),
        ("h", 200)]


def test_late_keys_and_their_histogram(spark):
    rows = spark.createDataFrame(ROWS, "item_id string, at bigint")
    late = lateness.undelivered(rows, spark.createDataFrame([("g",)], "item_id string"), "at", 100)
    # delivered (g), above the mark (e, h), without time (f) or key: not late
    assert sorted(tuple(r) for r in late.collect()) == [("a", 0), ("b", 1), ("c", 10), ("d", 60)]
    hist = lateness.histogram(late)
    assert [tuple(r) for r in hist.orderBy("edge_s").collect()] == [(1, 1, 0.25), (2, 1, 0.5), (16, 1, 0.75), (64, 1, 1.0)]
    assert [lateness.covering(hist, s) for s in (0.2, 0.5, 0.7, 1.0)] == [1, 2, 16, 64]
    # a run with that lateness looks at what the share promises
    got = rows.filter(P.since("at", 100, lateness.covering(hist, 0.7))).filter("at <= 100").select("item_id")
    assert {r[0] for r in got.collect()} == {"a", "b", "c"}


def test_nothing_late(spark):
    none = spark.createDataFrame([], "item_id string, at bigint")
    hist = lateness.histogram(lateness.undelivered(none, none.select("item_id"), "at", 100))
    assert hist.count() == 0 and lateness.covering(hist, 0.9) == 0
    for bad in (0, 1.1, float("nan")):
        with pytest.raises(ValueError):
            lateness.covering(hist, bad)


def test_delivery_progress(spark):
    t = dt.datetime(2026, 1, 1)

    def at(s):
        return t + dt.timedelta(seconds=s)

    log = spark.createDataFrame(
        [("x", 200, 10, at(0)), ("x", 503, 5, at(30)), ("x", 200, 20, at(50)), ("x", 200, 5, at(130)),
         ("x", None, 7, at(200)), ("y", 200, 1, at(5)), ("y", 200, 1, None)],
        "scope string, status_code int, event_count bigint, ts timestamp")
    got = metrics.delivery_progress(log, 60).orderBy("scope", "tick").collect()
    t0 = int(t.replace(tzinfo=dt.timezone.utc).timestamp()) // 60
    assert [tuple(r) for r in got] == [
        ("x", t0, 30, 1, 30, 50.0, 0.6), ("x", t0 + 2, 5, 0, 35, 130.0, 0.27), ("x", t0 + 3, 0, 1, 35, 200.0, 0.18),
        ("y", t0, 1, 0, 1, 0.0, 0.0)]


def test_a_run_writes_progress_and_the_audit_finds_what_came_late(spark, tmp_root):
    land = os.path.join(tmp_root, "land")

    def docs(ids, ts):
        return [json.dumps({"id": i, "updated_at": ts, "is_deleted": False}) for i in ids]

    write_lines(os.path.join(land, "assets"), docs(["a", "b", "c"], "2026-01-01T00:00:00Z"))
    args = ["--landing", land, "--state", f"{tmp_root}/s", "--feed", "asset"]
    cli.main(["run", *args, "--outbox", f"{tmp_root}/o", "--logs", f"{tmp_root}/g", "--now", "1800000000", "--run-id", "7",
              "--batch-size", "1"], spark)
    rows = spark.read.parquet(f"{tmp_root}/g/progress_log").orderBy(F.col("tick").desc()).collect()
    assert rows[0]["total"] == 3 == sum(r["events"] for r in rows)
    assert {(r["run_id"], r["scope"]) for r in rows} == {("7", "feed=asset")}
    with open(os.path.join(land, "assets", "late.json"), "w") as f:
        f.write("\n".join(docs(["l1"], "2025-12-31T23:59:00Z") + docs(["l2"], "2025-12-31T00:00:00Z")) + "\n")
    got = cli.main(["audit", *args, "--share", "0.5"], spark)
    assert got == [{"edge_s": 64, "keys": 1, "share": 0.5}, {"edge_s": 131072, "keys": 1, "share": 1.0},
                   {"feed": "asset", "mark": 1767225600, "lateness_s": 64}]


def test_json_presence(spark):
    cases = {'{"a":{"b":1}}': "value", '{"a":{"b":null}}': "null", '{"a":{}}': "missing", '{"a":{"c":1}}': "missing",
             '{"a":null}': "no_parent", '{}': "no_parent", '{"a":[1]}': "no_parent", '{"a":"b"}': "no_parent",
             '{"a":{"b":{}}}': "value", '{"a":{"b":""}}': "value", '{"a":{"b":1}': "bad", '': "bad", None: "bad",
             'null': "no_parent", '[1]': "no_parent", '{"a":{"b":1,"b":2}}': "bad"}
    df = spark.createDataFrame([(k,) for k in cases], "raw string")
    got = {r["raw"]: r["p"] for r in df.select("raw", X.json_presence("raw", "a", "b").alias("p")).collect()}
    assert got == cases
    top = spark.createDataFrame([('{"b":null}',), ('{}',), ('3',)], "raw string")
    assert [r[0] for r in top.select(X.json_presence("raw", "b")).collect()] == ["null", "missing", "no_parent"]
