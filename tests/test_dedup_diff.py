from pyspark.sql import functions as F

from vigil.operators import dedup, diff


def test_new_only_null_and_numeric_ids(spark):
    ev = spark.createDataFrame([(123,), (None,), (7,), (123,)], "id bigint").withColumn("item_id", F.col("id"))
    seen = spark.createDataFrame([("123",), ("999",)], "item_id string")
    got = sorted((r.id is None, r.id) for r in dedup.new_only(ev, seen, "item_id").collect())
    # numeric 123 matches stored "123"; a null key is never tracked, so it is re-sent
    assert got == [(False, 7), (True, None)]


def test_new_only_empty_state_passes_everything(spark):
    ev = spark.createDataFrame([("a",), ("a",), ("b",)], "item_id string")
    seen = spark.createDataFrame([], "item_id string")
    assert dedup.new_only(ev, seen).count() == 3          # in-run duplicates are all sent


def test_first_per_key(spark):
    df = spark.createDataFrame([("k", 3, "x"), ("k", 1, "y"), ("k", 1, "a"), ("j", 5, "z")],
                               "key string, t int, v string")
    got = {r.key: (r.t, r.v) for r in dedup.first_per_key(df, "key", ["t", "v"]).collect()}
    assert got == {"k": (1, "a"), "j": (5, "z")}


def test_vanished_filters_nulls_and_is_disjoint(spark):
    prev = spark.createDataFrame([("a",), ("b",), (None,), ("c",), ("c",)], "k string")
    curr = spark.createDataFrame([("b",), ("d",)], "k string")
    gone = sorted(r.k for r in diff.vanished(prev, curr, "k").collect())
    assert gone == ["a", "c"]
    assert not set(gone) & {"b", "d"}


def test_fix_and_deletion_events(spark):
    keys = spark.createDataFrame([("u1_10_443_tcp",), ("u2_7",)], "vuln_key string")
    rows = {r.vulnerability_key: r for r in diff.fix_events(keys, 42).collect()}
    assert (rows["u2_7"].port, rows["u2_7"].protocol, rows["u2_7"].plugin_id) == ("0", "tcp", "7")
    assert rows["u1_10_443_tcp"].event_type == "vulnerability_fixed" and rows["u1_10_443_tcp"].detected_at == 42
    d = diff.deletion_events(spark.createDataFrame([("x",)], "item_id string"), 42).first()
    assert (d.asset_id, d.event_type, d.detected_at) == ("x", "asset_deleted", 42)


def test_diff_sequence_modes(spark):
    s1 = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    s2 = spark.createDataFrame([("b",), ("c",)], "k string")
    s3 = spark.createDataFrame([("c",)], "k string")
    until = sorted((r.run_no, r.k) for r in diff.diff_sequence([s1, s2, s3], "k").collect())
    assert until == [(2, "a"), (3, "a"), (3, "b")]           # re-reported until expiry
    once = sorted((r.run_no, r.k) for r in diff.diff_sequence([s1, s2, s3], "k", emit="once").collect())
    assert once == [(2, "a"), (3, "b")]
    first_only = diff.diff_sequence([s1], "k")
    assert first_only.count() == 0                             # run 1 only builds the baseline


def test_min_ratio_guard():
    assert diff.min_ratio_ok(100, 0, None)
    assert not diff.min_ratio_ok(100, 0, 0.5)
    assert diff.min_ratio_ok(100, 60, 0.5)
