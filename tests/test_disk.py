"""What a landing and a feed run put on disk: packed lines, no copies of records, no shuffle files of steps that are over."""

import hashlib
import json
import os

import pytest
from landing_files import write_lines
from pyspark.sql import functions as F

from vigil.operators import dedup
from vigil.plans import catalog, registry as R, run
from vigil.sources import event_sink, landing

NOW = 1767225600        # 2026-01-01


def shuffle_bytes(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return sum(os.path.getsize(os.path.join(d, f)) for top in dirs for d, _, fs in os.walk(top.getPath()) for f in fs
               if f.startswith("shuffle_"))


def tree_bytes(root):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(root) for f in fs)


def vuln_lines(keys):
    return [json.dumps({"asset": {"uuid": hashlib.sha256(str(k).encode()).hexdigest()}, "plugin": {"id": k},
                        "port": {"port": 1, "protocol": "tcp"}, "severity": "high", "state": "OPEN", "is_licensed": True,
                        "last_found": str(NOW - 9000 + k)}) for k in keys]


@pytest.fixture()
def tables(spark, tmp_root):
    """20,000 line items of the driver's shape, half of them found before 1998."""
    k = F.col("id")
    spark.range(20000).select(
        (k * 7).alias("l_orderkey"), (k % 311).alias("l_partkey"), (k % 97).alias("l_suppkey"),
        (k % 7 + 1).cast("int").alias("l_linenumber"), (k % 50 + 1).cast("double").alias("l_quantity"),
        F.lit(1.0).alias("l_extendedprice"), F.lit(0.0).alias("l_discount"), F.lit(0.0).alias("l_tax"),
        F.when(k % 3 == 0, "R").otherwise("N").alias("l_returnflag"),
        F.when(k % 2 == 0, "O").otherwise("F").alias("l_linestatus"),
        F.timestamp_seconds(F.when(k % 2 == 0, 880000000).otherwise(910000000) + k).cast(
            "timestamp_ntz").alias("l_shipdate"),
    ).coalesce(1).write.parquet(f"{tmp_root}/lineitem.parquet")
    return tmp_root


@pytest.mark.parametrize("query", ["landing_run", "landing_incremental"])
def test_a_landing_query_leaves_less_than_its_plain_lines(spark, tables, monkeypatch, query):
    root = f"{tables}/work"
    monkeypatch.setattr(catalog, "work_dir", lambda spark, name: root)
    got = catalog.QUERIES[query](spark, tables)
    assert got.select("vuln_key").distinct().count() == got.count() == 20000 * 31 // 50
    plain = catalog.vuln_source(spark, tables).select(F.to_json(F.struct("asset", "plugin", "port", "severity", "state"))
                                                      .alias("v")).agg(F.sum(F.length("v"))).first()[0]
    assert tree_bytes(root) < plain


def test_landed_lines_are_not_sent_between_tasks(spark, tmp_root):
    for day in (1, 2):
        for n in range(3):
            write_lines(f"{tmp_root}/in/ingest_date=2026-01-0{day}/{n}",
                        vuln_lines(range(day * 9000 + n * 1000, day * 9000 + n * 1000 + 1000)))
    before = shuffle_bytes(spark)
    got = landing.land_new(spark, "vulns", f"{tmp_root}/in", f"{tmp_root}/typed")
    assert shuffle_bytes(spark) - before < 20000
    assert {(str(r[0]), r["count"]) for r in got.groupBy("ingest_date").count().collect()} == {
        ("2026-01-01", 3000), ("2026-01-02", 3000)}
    for day in (1, 2):      # many small files become one
        folder = f"{tmp_root}/typed/data/batch=1/ingest_date=2026-01-0{day}"
        assert len([f for f in os.listdir(folder) if f.endswith(".parquet")]) == 1


def test_a_day_of_a_torn_batch_does_not_stay(spark, tmp_root):
    old = write_lines(f"{tmp_root}/in/ingest_date=2026-01-01", vuln_lines([1]))
    landing.land_new(spark, "vulns", f"{tmp_root}/in", f"{tmp_root}/typed")
    os.rename(f"{tmp_root}/typed/ledger", f"{tmp_root}/torn")       # the run went down before its ledger
    os.rename(old, f"{tmp_root}/gone")
    write_lines(f"{tmp_root}/in/ingest_date=2026-01-02", vuln_lines([2]))
    got = landing.land_new(spark, "vulns", f"{tmp_root}/in", f"{tmp_root}/typed")
    assert [r.plugin.id for r in got.collect()] == [2]


def test_delivered_lines_leave_no_shuffle_files(spark, tmp_root):
    lines = spark.range(20000).select(F.sha2(F.col("id").cast("string"), 256).alias("json"), F.col("id").alias("item_id"))
    before = shuffle_bytes(spark)
    event_sink.deliver(lines, f"file:{tmp_root}/posted", f"{tmp_root}/log", key_column="item_id",
                       delivered_keys=f"{tmp_root}/keys")
    assert shuffle_bytes(spark) <= before
    assert spark.read.text(f"{tmp_root}/posted").count() == spark.read.parquet(f"{tmp_root}/keys").count() == 20000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"


@pytest.mark.parametrize("feed, mark", [("vulnerability", [0, NOW, NOW]), ("asset", [0, NOW - 9000 + 39, NOW - 9000 + 59])])
def test_a_plain_run_keeps_no_copy_of_its_records(spark, tmp_root, monkeypatch, feed, mark):
    """Each record goes to the sink once, also where a run meets keys of the state again; marks are as ever."""
    spec = R.REGISTRY[feed]

    def no_copy(self, *a):
        raise AssertionError("records were kept")
    monkeypatch.setattr(type(spark.range(1)), "persist", no_copy)
    sent = []
    for n, keys in ((1, range(0, 40)), (2, range(20, 60))):
        write_lines(f"{tmp_root}/in/ingest_date=2025-12-3{n}", vuln_lines(keys) if spec.source == "vulns" else [
            json.dumps({"id": f"a{k}", "updated_at": str(NOW - 9000 + k), "is_deleted": False}) for k in keys])
        src = landing.land_new(spark, spec.source, f"{tmp_root}/in", f"{tmp_root}/typed")
        r = run.run_feed(spark, spec, src, f"{tmp_root}/s", f"{tmp_root}/o", NOW, n, [], raw_col="raw", lateness_s=86400)
        sent.append((r.events, r.delivered_events, r.old_mark, r.new_mark))
        assert not os.path.exists(f"{tmp_root}/o/_delivery/run={n}/feed={spec.feed}/met")
    assert sent == [(40, 40, *mark[:2]), (20, 20, *mark[1:])]


def test_met_keys_are_those_of_both_sides(spark, tmp_root):
    events = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "item_id string")
    seen = spark.createDataFrame([("b",), ("c",), (None,)], "item_id string")
    met = dedup.met_keys(events, seen, f"{tmp_root}/met")
    assert [r.item_id for r in met.collect()] == ["b"]
    assert sorted(str(r.item_id) for r in dedup.new_only(events, met).collect()) == ["None", "a"]
