"""Properties of SURVEY section 5.4, checked on generated inputs."""

import datetime as dt
import os

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vigil.operators import dedup, diff, state as S

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
keys = st.lists(st.one_of(st.none(), st.text("abc", min_size=1, max_size=3)), max_size=40)


@SETTINGS
@given(events=keys, seen=keys)
def test_emitted_and_suppressed_partition_the_input(spark, events, seen):
    ev = spark.createDataFrame([(i, k) for i, k in enumerate(events)], "pos int, item_id string")
    sn = spark.createDataFrame([(k,) for k in seen if k is not None], "item_id string")
    emitted = {r.pos for r in dedup.new_only(ev, sn).collect()}
    suppressed = {r.pos for r in ev.join(sn.distinct(), "item_id", "left_semi").collect()}
    assert emitted | suppressed == set(range(len(events)))
    assert not emitted & suppressed


@SETTINGS
@given(prev=keys, curr=keys)
def test_diff_is_disjoint_from_current(spark, prev, curr):
    p = spark.createDataFrame([(k,) for k in prev], "k string")
    c = spark.createDataFrame([(k,) for k in curr], "k string")
    gone = {r.k for r in diff.vanished(p, c, "k").collect()}
    assert gone == {k for k in prev if k is not None} - set(curr)


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from(["f", "g"]), st.text("xyz", min_size=1, max_size=4),
                               st.integers(0, 5)), max_size=60),
       cap=st.integers(1, 6))
def test_state_never_exceeds_cap(spark, rows, cap):
    base = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(f, k, base + dt.timedelta(seconds=t)) for f, k, t in rows],
                               "feed string, item_id string, seen_at timestamp")
    merged = S.upsert(S.empty_state(spark), df)
    out = S.trim_newest(merged, cap).groupBy("feed").count().collect()
    assert all(r["count"] <= cap for r in out)


def test_replayed_micro_batch_changes_nothing(spark, tmp_root):
    import pyarrow.parquet as pq

    from vigil.plans.registry import REGISTRY
    from vigil.streaming.runner import make_batch_handler

    sf = "/root/testdata/sf0.001"
    batch = spark.read.parquet(f"{sf}/lineitem.parquet").limit(400).cache()
    state_base, outbox = os.path.join(tmp_root, "state"), os.path.join(tmp_root, "outbox")
    cols = ["vuln_key", "asset_uuid", "plugin_id", "port", "protocol", "severity"]
    h = make_batch_handler(REGISTRY["vulnerability"], state_base, outbox, 1007164800, 365, 500000, cols)
    h(batch, 0)
    first_out = sorted(r.value for r in spark.read.text(f"{outbox}/run=0/feed=vulnerability").collect())
    first_state = sorted(tuple(r) for r in S.load(spark, state_base).collect())
    h(batch, 0)                                   # the same batch id again (crash before offset commit)
    assert sorted(r.value for r in spark.read.text(f"{outbox}/run=0/feed=vulnerability").collect()) == first_out
    assert sorted(tuple(r) for r in S.load(spark, state_base).collect()) == first_state
    assert len(first_out) > 0
    h(batch, 1)                                   # the next batch with the same rows emits nothing new
    later = f"{outbox}/batch=1"
    if os.path.exists(later):
        assert spark.read.text(later).count() == 0
