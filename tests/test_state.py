import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from vigil.operators import state as S

NOW = 1_000_000_000
DAY = 86400


def ts(sec):
    return dt.datetime.fromtimestamp(sec, dt.timezone.utc).replace(tzinfo=None)


def mk(spark, rows):
    return spark.createDataFrame([(f, k, ts(t)) for f, k, t in rows], "feed string, item_id string, seen_at timestamp")


def test_retention_is_strict(spark):
    st = mk(spark, [("a", "1", NOW - 7 * DAY), ("a", "2", NOW - 7 * DAY + 1), ("a", "3", NOW)])
    keys = sorted(r.item_id for r in S.active_keys(st, NOW, 7).collect())
    assert keys == ["2", "3"]          # exactly at the cutoff is expired


def test_upsert_keeps_newest(spark):
    st = mk(spark, [("a", "1", 100), ("a", "2", 100)])
    new = mk(spark, [("a", "1", 200), ("a", "1", 150), ("b", "1", 50)])
    got = {(r.feed, r.item_id): r.seen_at for r in S.upsert(st, new).collect()}
    assert got == {("a", "1"): ts(200), ("a", "2"): ts(100), ("b", "1"): ts(50)}


@pytest.mark.parametrize("cap", [3, 1500])
def test_trim_newest(spark, cap):
    rows = [("hot", f"k{i:05d}", 1000 + i // 2) for i in range(cap + 40)] + [("cold", "x", 5)]
    st = mk(spark, rows)
    out = S.trim_newest(st, cap).collect()
    hot = sorted([r for r in out if r.feed == "hot"], key=lambda r: (-r.seen_at.timestamp(), r.item_id))
    want = sorted([r for r in rows if r[0] == "hot"], key=lambda r: (-r[2], r[1]))[:cap]
    assert [r.item_id for r in hot] == [w[1] for w in want]
    assert [r.item_id for r in out if r.feed == "cold"] == ["x"]


def test_commit_load_roundtrip_and_missing(spark, tmp_root):
    base = os.path.join(tmp_root, "state")
    assert S.load(spark, base).count() == 0              # no state yet = empty
    st = mk(spark, [("a", "1", 100), ("a", "2", 200)])
    S.commit(st, base, 1)
    S.commit(st.filter(F.col("item_id") == "1"), base, 2)
    assert S.current_version(spark, base) == 2
    assert [r.item_id for r in S.load(spark, base).collect()] == ["1"]
    assert S.load_version(spark, base, 1).count() == 2
    S.commit(st.filter(F.col("item_id") == "1"), base, 2)   # re-run of a version is idempotent
    assert S.load(spark, base).count() == 1


def test_corrupt_state_fails(spark, tmp_root):
    base = os.path.join(tmp_root, "bad")
    S.commit(mk(spark, [("a", "1", 100)]), base, 1)
    d = os.path.join(base, "keys", "v=1", "feed=a")
    for f in os.listdir(d):
        if f.endswith(".parquet"):
            with open(os.path.join(d, f), "wb") as fh:
                fh.write(b"not parquet at all")
    with pytest.raises(Exception):
        S.load(spark, base).collect()


def test_lost_marks_or_data_raise(spark, tmp_root):
    import shutil

    base = os.path.join(tmp_root, "s")
    S.commit(mk(spark, [("a", "1", 100)]), base, 1)
    os.rename(os.path.join(base, "marks"), os.path.join(base, "elsewhere"))
    with pytest.raises(S.StateDamaged):
        S.load(spark, base)
    os.rename(os.path.join(base, "elsewhere"), os.path.join(base, "marks"))
    shutil.move(os.path.join(base, "keys", "v=1", "feed=a"), os.path.join(tmp_root, "gone"))
    with pytest.raises(S.StateDamaged):
        S.load(spark, base)
    with pytest.raises(S.StateDamaged):
        S.load_version(spark, os.path.join(tmp_root, "never"), 3)


def test_torn_commit_is_not_seen(spark, tmp_root):
    """Keys whose marks row was never written belong to no version."""
    base = os.path.join(tmp_root, "s")
    S.commit(mk(spark, [("a", "1", 100)]), base, 1)
    S._write_keys([S.normalize(mk(spark, [("a", "1", 100), ("a", "2", 100)]))], base, 2, ["a"], 0)
    assert S.current_version(spark, base) == 1 and [r.item_id for r in S.load(spark, base).collect()] == ["1"]
    S.commit(mk(spark, [("a", "3", 100)]), base, 2)
    assert [r.item_id for r in S.load(spark, base).collect()] == ["3"]


def test_commit_touches_only_its_feed(spark, tmp_root):
    def listing(folder):
        return sorted((os.path.join(d, f), os.stat(os.path.join(d, f)).st_mtime_ns)
                      for d, _, fs in os.walk(folder) for f in fs if "feed=b" in os.path.join(d, f))

    base = os.path.join(tmp_root, "s")
    S.commit(mk(spark, [("a", "1", 100), ("b", "1", 100)]), base, 1,
             marks=spark.createDataFrame([("a", 5, None, None), ("b", 6, None, None)], S.WATERMARK_SCHEMA))
    before = listing(base)
    both = mk(spark, [("a", "1", 100), ("a", "2", 200)])
    S.commit(both, base, 2, feeds=["a"], marks=spark.createDataFrame([("a", 9, None, 3)], S.WATERMARK_SCHEMA))
    assert listing(base) == before and before
    assert sorted((r.feed, r.item_id) for r in S.load(spark, base).collect()) == [("a", "1"), ("a", "2"), ("b", "1")]
    marks = {r.feed: (r.last_timestamp, r.last_cleanup) for r in S.load_marks(spark, base).collect()}
    assert marks == {"a": (9, 3), "b": (6, None)}
    assert S.load_version(spark, base, 1).count() == 2


def test_marks_move_without_rewriting_keys_and_old_snapshots_go(spark, tmp_root):
    base = os.path.join(tmp_root, "s")
    S.commit(mk(spark, [("a", "1", 100), ("b", "1", 100)]), base, 1)
    for v in range(2, 8):
        S.commit_marks(spark, base, v, spark.createDataFrame([("a", v, None, None)], S.WATERMARK_SCHEMA))
    assert sorted(os.listdir(os.path.join(base, "keys"))) == ["v=1"] and S.load(spark, base).count() == 2
    assert {r.feed: r.last_timestamp for r in S.load_marks(spark, base).collect()} == {"a": 7, "b": None}
    for v in range(8, 13):
        S.commit(mk(spark, [("a", str(v), 100)]), base, v, feeds=["a"])
    kept = {d for d in os.listdir(os.path.join(base, "keys")) if os.path.exists(os.path.join(base, "keys", d, "feed=a"))}
    assert kept == {"v=10", "v=11", "v=12"}
    assert sorted((r.feed, r.item_id) for r in S.load(spark, base).collect()) == [("a", "12"), ("b", "1")]
    assert [r.item_id for r in S.load_version(spark, base, 10, "a").collect()] == ["10"]


def test_clear_sweep_and_legacy_are_committed(spark, tmp_root):
    base = os.path.join(tmp_root, "s")
    S.commit(mk(spark, [("a", "1", NOW), ("a", "2", NOW - 30 * DAY), ("b", "1", NOW)]), base, 1,
             marks=spark.createDataFrame([("a", 5, 6, 7)], S.WATERMARK_SCHEMA))
    assert {r.feed: r.active_ids for r in S.commit_sweep(spark, base, NOW).collect()} == {"a": 1, "b": 1}
    assert sorted((r.feed, r.item_id) for r in S.load(spark, base).collect()) == [("a", "1"), ("b", "1")]
    assert {r.feed: r.last_cleanup for r in S.load_marks(spark, base).collect()}["a"] == NOW
    S.commit_clear(spark, base, "a")
    assert [r.feed for r in S.load(spark, base).collect()] == ["b"]
    assert [r.last_timestamp for r in S.load_marks(spark, base).filter("feed = 'a'").collect()] == [None]
    legacy = spark.createDataFrame([("c", ["x", "y"], 77)], "feed string, processed_ids array<string>, last_timestamp bigint")
    S.commit_legacy(legacy, base, NOW)
    assert S.load(spark, base, "c").count() == 2
    assert S.load_marks(spark, base).filter("feed = 'c'").first().last_timestamp == 77


def test_cap_is_off_by_default(spark):
    st = mk(spark, [("a", str(i), i) for i in range(50)])
    assert S.flush(st, 60, 7).count() == 50 and S.flush(st, 60, 7, 5).count() == 5


def test_stamp_order(spark):
    keys = spark.createDataFrame([("a", "z", 3), ("a", "y", 1), ("a", "x", 2), ("b", "q", 9)],
                                 "feed string, item_id string, pos int")
    got = {(r.feed, r.item_id): r.seen_at for r in S.stamp(keys, ["pos"], NOW * 1_000_000).collect()}
    base = dt.datetime(2001, 9, 9, 1, 46, 40)
    us = dt.timedelta(microseconds=1)
    assert got[("a", "y")] == base and got[("a", "x")] == base + us and got[("a", "z")] == base + 2 * us
    assert got[("b", "q")] == base


def test_legacy_migration_and_sweep(spark):
    legacy = spark.createDataFrame([("a", ["1", "2"]), ("b", ["3"])], "feed string, processed_ids array<string>")
    st = S.migrate_legacy(legacy, NOW)
    rows = st.collect()
    assert sorted(r.item_id for r in rows) == ["1", "2", "3"]
    assert {r.seen_at for r in rows} == {ts(NOW)}
    sw = {r.feed: r.active_ids for r in S.sweep(st, NOW + DAY, 7, 1).collect()}
    assert sw == {"a": 1, "b": 1}
    assert [r.feed for r in S.clear(st, "a").collect()] == ["b"]


def test_stats(spark):
    st = mk(spark, [("a", "1", NOW), ("a", "2", NOW - 30 * DAY)])
    marks = spark.createDataFrame([("a", 5, 6)], "feed string, last_timestamp bigint, last_cleanup bigint")
    r = S.stats(st, marks, NOW, 7).first()
    assert (r.total_tracked, r.active_ids, r.last_timestamp) == (2, 1, 5)


def test_legacy_documents_from_json(spark, tmp_root):
    import json

    from landing_files import write_lines
    from vigil.sources import readers

    path = write_lines(os.path.join(tmp_root, "legacy"), [
        json.dumps({"feed": "asset", "processed_ids": ["a", "b"], "last_timestamp": 7}),
        json.dumps({"feed": "plugin", "processed_ids": [], "last_timestamp": 0})])
    st = S.migrate_legacy(readers.legacy_state(spark, path), NOW)
    assert sorted((r.feed, r.item_id) for r in st.collect()) == [("asset", "a"), ("asset", "b")]
