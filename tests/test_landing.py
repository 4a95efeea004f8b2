"""Incremental landing: a file is parsed once; predicates on the day prune folders."""

import json
import os
import time

import pytest

from vigil.plans import feeds, registry as R
from vigil.sources import landing

DAY1, DAY2 = 1767225600, 1767312000        # 2026-01-01, 2026-01-02


def put(root, folder, name, ids, extra=()):
    path = os.path.join(root, folder)
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        for i in ids:
            f.write(json.dumps({"id": f"a{i}", "updated_at": str(DAY1 + i), "is_deleted": False}) + "\n")
        f.write("".join(x + "\n" for x in extra))
    return os.path.join(path, name)


def ids(df):
    return sorted(r.id for r in df.collect())


@pytest.fixture()
def place(tmp_root):
    return os.path.join(tmp_root, "in"), os.path.join(tmp_root, "typed"), os.path.join(tmp_root, "bad")


def data_files(table):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f))
            for d, _, fs in os.walk(os.path.join(table, "data")) for f in fs if f.endswith(".parquet")}


def test_only_new_files_are_parsed(spark, place):
    land, table, bad = place
    put(land, "ingest_date=2026-01-01", "p0 +%é.json", [1, 2], ['{"id": "torn'])
    assert ids(landing.land_new(spark, "assets", land, table, bad)) == ["a1", "a2"]
    assert [r.raw for r in spark.read.parquet(bad).collect()] == ['{"id": "torn']
    before = data_files(table)
    assert ids(landing.land_new(spark, "assets", land, table, bad)) == ["a1", "a2"]       # nothing new: nothing written
    assert data_files(table) == before and landing.last_batch(spark, table) == 1
    put(land, "ingest_date=2026-01-02", "p0.json", [3])
    late = put(land, "ingest_date=2026-01-01", "p1.json", [4])
    assert sorted(os.path.basename(r.path) for r in landing.new_files(spark, land, table).collect()) == ["p0.json", "p1.json"]
    got = landing.land_new(spark, "assets", land, table)
    assert ids(got) == ["a1", "a2", "a3", "a4"] and ids(got.filter("batch = 2")) == ["a3", "a4"]
    assert {k: v for k, v in data_files(table).items() if k in before} == before
    # a file that was rewritten is read again
    time.sleep(1.1)
    put(land, "ingest_date=2026-01-01", os.path.basename(late), [5, 6])
    got = landing.land_new(spark, "assets", land, table)
    assert ids(got.filter("batch = 3")) == ["a5", "a6"] and ids(got) == ["a1", "a2", "a3", "a5", "a6"]


def test_a_batch_counts_once_its_ledger_is_written(spark, place):
    land, table, _ = place
    put(land, "ingest_date=2026-01-01", "p0.json", [1])
    landing.land_new(spark, "assets", land, table)
    put(land, "ingest_date=2026-01-02", "p0.json", [2])
    landing.land_new(spark, "assets", land, table)
    os.rename(os.path.join(table, "ledger", "batch=2"), os.path.join(table, "torn"))
    assert ids(landing.landed(spark, "assets", table)) == ["a1"]
    assert ids(landing.land_new(spark, "assets", land, table)) == ["a1", "a2"]


def test_the_mark_prunes_days_and_pushes_down(spark, place):
    land, table, _ = place
    for k in range(5):
        put(land, f"ingest_date=2026-01-0{k + 1}", "p.json", [k * 86400 + 5])
    src = landing.land_new(spark, "assets", land, table)
    new = feeds.extract(R.REGISTRY["asset"], src, mark=DAY2 + 2 * 86400)
    assert ids(new) == [f"a{3 * 86400 + 5}", f"a{4 * 86400 + 5}"]
    plan = new._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    scan = plan[plan.index("PartitionFilters"):].split("\n")[0]
    assert "ingest_date" in scan and "batch" in scan
    assert "GreaterThan(updated_epoch" in plan


def test_folder_without_days_takes_the_files_own(spark, place):
    land, table, _ = place
    path = put(land, "", "p0.json", [1])
    os.utime(path, (DAY1 + 3600, DAY1 + 3600))
    got = landing.land_new(spark, "assets", land, table).collect()
    assert [(r.id, str(r.ingest_date)) for r in got] == [("a1", "2026-01-01")]


def test_empty_folder(spark, place):
    land, table, _ = place
    os.makedirs(land)
    assert landing.land_new(spark, "assets", land, table).count() == 0
    put(land, "", "empty.json", [])
    assert landing.land_new(spark, "assets", land, table).count() == 0 and landing.last_batch(spark, table) is None
