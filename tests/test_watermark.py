from vigil.operators import watermark as W


def test_data_mark_only_moves_forward(spark):
    old = spark.createDataFrame([("a", 100), ("b", 500), ("c", 0)], "feed string, last_timestamp bigint")
    ev = spark.createDataFrame([("a", 150), ("a", 120), ("b", 300)], "feed string, updated_epoch bigint")
    got = {r.feed: (r.old_mark, r.new_mark) for r in W.data_mark(ev, old).collect()}
    assert got == {"a": (100, 150), "b": (500, 500), "c": (0, 0)}


def test_clock_mark_rules(spark):
    old = spark.createDataFrame([("busy", 10), ("idle", 10), ("new", 0), ("cut", 10)],
                                "feed string, last_timestamp bigint")
    ev = spark.createDataFrame([("busy",), ("busy",), ("cut",)], "feed string")
    trunc = spark.createDataFrame([("cut", True)], "feed string, held boolean")
    got = {r.feed: (r.n_events, r.new_mark) for r in W.clock_mark(ev, old, 99, held=trunc).collect()}
    # events -> run start; no events -> unchanged; no previous mark -> run start; truncated -> unchanged
    assert got == {"busy": (2, 99), "idle": (0, 10), "new": (0, 99), "cut": (1, 10)}


def test_scan_mark_is_max_not_list_order(spark):
    scans = spark.createDataFrame([(300,), (100,), (200,)], "modified_epoch bigint")
    assert W.scan_mark(scans, 50).first().new_mark == 300
    assert W.scan_mark(scans.filter("modified_epoch > 1000"), 50).first().new_mark == 50
