import json
import os

import pytest
from pyspark.sql import functions as F

from landing_files import write_lines
from vigil.operators import flatten, state as S
from vigil.plans import feeds, registry as R
from vigil.plans.run import read_outbox_run, run_feed
from vigil.sources import readers

NOW = 1_800_000_000


def vuln(uuid, plugin, port, proto, sev="high", state="OPEN", agent=False, found="2026-01-01T00:00:00Z"):
    d = {"asset": {"uuid": uuid, "has_agent": agent}, "plugin": {"id": plugin}, "severity": sev, "state": state,
         "last_found": found}
    if port is not None or proto is not None:
        d["port"] = {k: v for k, v in (("port", port), ("protocol", proto)) if v is not None}
    return json.dumps(d)


ASSETS = [
    {"id": "a1", "updated_at": "2026-01-02T00:00:00Z", "is_deleted": False, "has_agent": True,
     "sources": ["NESSUS_AGENT"], "has_plugin_results": True},
    {"id": "a2", "updated_at": "2026-01-03T00:00:00.5Z", "is_deleted": True, "sources": ["NESSUS_SCAN"]},
    {"id": "a3", "updated_at": "1767225600", "is_terminated": True, "terminated_at": None,
     "sources": ["NESSUS_AGENT"], "has_agent": None},
    {"id": "a4", "updated_at": "2026-01-05T00:00:00Z", "is_terminated": True, "terminated_at": "2026-01-04T00:00:00Z",
     "has_plugin_results": True},
]


def test_asset_predicates_on_native_documents(spark, tmp_root):
    path = write_lines(os.path.join(tmp_root, "assets"), [json.dumps(a) for a in ASSETS])
    a = readers.assets(spark, path)
    ids = lambda feed: sorted(r.item_id for r in feeds.extract(R.REGISTRY[feed], a).collect())
    assert ids("asset") == ["a1", "a3", "a4"]                 # missing is_deleted counts as live
    assert ids("asset_self_scan") == ["a1"]                    # agent source AND truthy has_agent
    assert ids("terminated_asset") == ["a4"]                   # explicit null terminated_at excluded
    raw = a.filter(F.col("id") == "a2").first()
    assert json.loads(raw.raw)["id"] == "a2" and raw.updated_epoch == 1767398400
    # incremental predicate applies only when a mark exists, and is strict
    inc = feeds.extract(R.REGISTRY["asset"], a, mark=1767312000)
    assert sorted(r.item_id for r in inc.collect()) == ["a4"]


def test_vuln_key_missing_port_and_agent_feed(spark, tmp_root):
    docs = [vuln("u1", 10, 443, "tcp"), vuln("u1", 11, None, None, agent=True), vuln("u2", 12, 80, "udp", sev="info")]
    v = readers.vulns(spark, write_lines(os.path.join(tmp_root, "v"), docs))
    keys = sorted(r.item_id for r in feeds.extract(R.REGISTRY["vulnerability"], v).collect())
    assert keys == ["u1_10_443_tcp", "u1_11_0_tcp"]
    info = [r.item_id for r in feeds.extract(R.REGISTRY["vulnerability_no_info"], v).collect()]
    assert info == ["u2_12_80_udp"]
    agent = [r.item_id for r in feeds.extract(R.REGISTRY["vulnerability_self_scan"], v).collect()]
    assert agent == ["u1_11_0_tcp"]


def test_two_runs_emit_only_new_keys_and_failed_batches_are_resent(spark, tmp_root):
    spec = R.REGISTRY["vulnerability"]
    run1 = [vuln(f"u{i}", i, 443, "tcp") for i in range(20)]
    run2 = run1 + [vuln(f"n{i}", 100 + i, 22, "tcp") for i in range(5)]
    state_base, outbox = os.path.join(tmp_root, "state"), os.path.join(tmp_root, "outbox")
    cols = ["item_id", "severity"]
    v1 = readers.vulns(spark, write_lines(os.path.join(tmp_root, "r1"), run1))

    # the batch holding u3's event answers 503 (after retries): its keys must not be committed
    r1 = run_feed(spark, spec, v1, state_base, outbox, NOW, 1, cols, batch_size=5,
                  transport='python:failing_transport:FailingFolder:{outbox}?fail_match="u3_3_443_tcp"')
    assert r1.events == 20 and r1.failed_batches == 1 and 0 < r1.delivered_events < 20
    assert r1.new_mark == 0                          # the mark never passes an event that was not sent
    sent1 = read_outbox_run(spark, outbox, 1, spec.feed)
    assert sent1.count() == r1.delivered_events      # only delivered batches reached the hand-off folder
    ev = sent1.first()
    assert ev.sourcetype == spec.sourcetype and ev.fields.feed_type == "vulnerability"
    committed = S.load(spark, state_base).count()
    assert committed == r1.delivered_events

    v2 = readers.vulns(spark, write_lines(os.path.join(tmp_root, "r2"), run2))
    r2 = run_feed(spark, spec, v2, state_base, outbox, NOW + 100, 2, cols, batch_size=5)
    # new keys + the keys of the failed batch, nothing else
    assert r2.events == 5 + (20 - r1.delivered_events)
    assert S.load(spark, state_base).count() == 25 and r2.new_mark == NOW + 100


@pytest.mark.parametrize("feed", ["asset", "vulnerability", "compliance"])
def test_same_landing_resends_exactly_what_failed(spark, tmp_root, feed):
    """Data, clock and scan marks: a failed batch goes out with the next run over the same landing."""
    spec = R.REGISTRY[feed]
    if feed == "asset":
        docs = [json.dumps({"id": f"a{i:02d}", "updated_at": f"2026-01-{20 - i:02d}T00:00:00Z", "is_deleted": False})
                for i in range(12)]
        src, raw = readers.assets(spark, write_lines(os.path.join(tmp_root, "in"), docs)), "raw"
    elif feed == "vulnerability":
        docs = [vuln(f"a{i:02d}", i, 443, "tcp") for i in range(12)] * 2          # every key twice
        src, raw = readers.vulns(spark, write_lines(os.path.join(tmp_root, "in"), docs)), "raw"
    else:
        src = spark.createDataFrame([(i // 3, 7, i % 2, f'{{"n":"a{i:02d}"}}', "completed", 100 + i) for i in range(12)],
                                    "scan_id long, host_id long, plugin_id long, raw string, status string, modified_epoch long")
        raw = "raw"
    state, outbox = os.path.join(tmp_root, "s"), os.path.join(tmp_root, "o")
    r1 = run_feed(spark, spec, src, state, outbox, NOW, 1, [], raw_col=raw, batch_size=4,
                  transport='python:failing_transport:FailingFolder:{outbox}?fail_match="a03"')
    assert r1.failed_batches == 1 and r1.new_mark == 0 and 0 < r1.delivered_events < r1.events
    r2 = run_feed(spark, spec, src, state, outbox, NOW + 5, 2, [], raw_col=raw, batch_size=4)
    assert r2.events == r1.events - r1.delivered_events and r2.failed_batches == 0 and r2.new_mark > 0
    sent = [x for run in (1, 2) for x in (r.event for r in read_outbox_run(spark, outbox, run, feed).collect())]
    assert len(sent) == r1.events
    assert run_feed(spark, spec, src, state, outbox, NOW + 9, 3, [], raw_col=raw).events == 0


def test_cap_loses_nothing_with_a_data_mark(spark, tmp_root):
    docs = [json.dumps({"id": f"a{i}", "updated_at": f"2026-01-0{9 - i}T00:00:00Z", "is_deleted": False}) for i in range(3)]
    a = readers.assets(spark, write_lines(os.path.join(tmp_root, "in"), docs))
    state, outbox = os.path.join(tmp_root, "s"), os.path.join(tmp_root, "o")
    seen = []
    for run in range(1, 4):
        r = run_feed(spark, R.REGISTRY["asset"], a, state, outbox, NOW + run, run, [], raw_col="raw", max_events=1)
        assert r.events == 1 and (r.truncated, r.new_mark > 0) == ((True, False) if run < 3 else (False, True))
        seen += [json.loads(x.event)["id"] for x in read_outbox_run(spark, outbox, run, "asset").collect()]
    assert sorted(seen) == ["a0", "a1", "a2"]


def test_refused_events_do_not_pin_the_mark(spark, tmp_root):
    v = readers.vulns(spark, write_lines(os.path.join(tmp_root, "v"), [vuln(f"u{i}", i, 1, "tcp") for i in range(6)]))
    state, outbox = os.path.join(tmp_root, "s"), os.path.join(tmp_root, "o")
    r = run_feed(spark, R.REGISTRY["vulnerability"], v, state, outbox, NOW, 1, [], raw_col="raw", batch_size=2,
                 transport='python:failing_transport:FailingFolder:{outbox}?fail_match="u3"&status=400')
    assert r.failed_batches == 0 and r.dead_letters > 0 and r.new_mark == NOW
    dead = spark.read.parquet(f"{outbox}/_dead_letters/run=1/feed=vulnerability").collect()
    assert len(dead) == r.dead_letters == r.events - r.delivered_events
    assert run_feed(spark, R.REGISTRY["vulnerability"], v, state, outbox, NOW + 1, 2, [], raw_col="raw").events == 0


def test_no_cache_is_left_after_a_capped_run(spark, tmp_root):
    v = readers.vulns(spark, write_lines(os.path.join(tmp_root, "v"), [vuln(f"u{i}", i, 1, "tcp") for i in range(6)]))
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    run_feed(spark, R.REGISTRY["vulnerability"], v, os.path.join(tmp_root, "s"), os.path.join(tmp_root, "o"), NOW, 1, [],
             raw_col="raw", max_events=2)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_torn_lines_go_to_rejects(spark, tmp_root):
    lines = [vuln("u1", 1, 1, "tcp"), '{"asset": {"uuid": "u2"', "", "not json",
             json.dumps({"asset": {"uuid": "u3"}, "plugin": {"id": "odd"}, "severity": "high", "state": "OPEN"})]
    path = write_lines(os.path.join(tmp_root, "v"), lines)
    got = readers.land(spark, "vulns", path, os.path.join(tmp_root, "typed"), os.path.join(tmp_root, "rej"))
    assert sorted(r.asset.uuid for r in got.collect()) == ["u1", "u3"]       # an odd field type is only null
    assert sorted(r.raw for r in spark.read.parquet(os.path.join(tmp_root, "rej")).collect()) == ["not json", lines[1]]
    plan = feeds.extract(R.REGISTRY["vulnerability"], got).select("item_id")._jdf.queryExecution().executedPlan().toString()
    assert "from_json" not in plan.lower() and "jsontostructs" not in plan.lower() and "In(severity" in plan


def test_family_is_written_over_the_document(spark):
    from vigil.functions import exprs as X
    docs = ['{"id":1,"family_name":"old","x":{"a":[1,"b"]}}', "{}", '{"id":2, "y":1.50}', '{"family_id":9}']
    df = spark.createDataFrame([(d, "Web", 3) for d in docs], "raw string, family_name string, family_id int")
    out = [r.o for r in df.select(X.json_overlay("raw", F.struct("family_name", "family_id"), ["family_name", "family_id"])
                                  .alias("o")).collect()]
    for text in out:
        pairs = json.loads(text, object_pairs_hook=list)
        assert len({k for k, _ in pairs}) == len(pairs) and dict(pairs)["family_name"] == "Web"
    assert json.loads(out[0])["x"] == {"a": [1, "b"]} and out[2].startswith('{"id":2, "y":1.50,')
    got = df.select(F.get_json_object(X.json_overlay("raw", F.struct("family_name", "family_id"), [
        "family_name", "family_id"]), "$.family_name").alias("n")).collect()
    assert {r.n for r in got} == {"Web"}


def test_cap_truncation_keeps_clock_mark(spark, tmp_root):
    spec = R.REGISTRY["vulnerability"]
    v = readers.vulns(spark, write_lines(os.path.join(tmp_root, "v"), [vuln(f"u{i}", i, 1, "tcp") for i in range(6)]))
    state_base, outbox = os.path.join(tmp_root, "s"), os.path.join(tmp_root, "o")
    S.commit(spark.createDataFrame([], S.STATE_SCHEMA), state_base, 1,
             marks=spark.createDataFrame([("vulnerability", 5, None, 1)], S.WATERMARK_SCHEMA))
    r = run_feed(spark, spec, v, state_base, outbox, NOW, 1, ["item_id"], max_events=4)
    assert r.truncated and r.events == 4 and r.new_mark == 5
    assert sorted(x.item_id for x in S.load(spark, state_base).collect()) == [f"u{i}_{i}_1_tcp" for i in range(4)]


def test_plugin_and_compliance_flattening(spark, tmp_root):
    fam = readers.families(spark, write_lines(os.path.join(tmp_root, "f"), [
        json.dumps({"id": 1, "name": "Web"}), json.dumps({"id": 2, "name": "DB"})]))
    fd = readers.family_details(spark, write_lines(os.path.join(tmp_root, "fd"), [
        json.dumps({"family_id": 1, "plugins": [{"id": 10}, {"id": 11}]})]))       # family 2 has no detail
    pd_ = readers.plugin_details(spark, write_lines(os.path.join(tmp_root, "pd"), [
        json.dumps({"id": 10, "family_name": "old"})]))                             # plugin 11 has no detail
    cat = flatten.plugin_catalog(fam, fd, pd_).collect()
    assert [(r.family_id, r.plugin_id, r.family_name) for r in cat] == [(1, 10, "Web")]

    scans = readers.scans(spark, write_lines(os.path.join(tmp_root, "s"), [
        json.dumps({"id": 1, "name": "s1", "status": "completed", "last_modification_date": 100}),
        json.dumps({"id": 2, "name": "s2", "status": "completed", "last_modification_date": 50}),
        json.dumps({"id": 3, "name": "s3", "status": "running", "last_modification_date": 200})]))
    hosts = readers.scan_hosts(spark, write_lines(os.path.join(tmp_root, "sd"), [
        json.dumps({"scan_id": 1, "hosts": [{"host_id": 7, "hostname": "h7"}, {"host_id": 8, "hostname": "h8"}]})]))
    items = readers.host_items(spark, write_lines(os.path.join(tmp_root, "hd"), [
        json.dumps({"scan_id": 1, "host_id": 7, "compliance": [{"plugin_id": 5, "x": 1}, {"plugin_id": 5, "x": 2}]})]))
    done = flatten.completed_since(scans, 50)            # a scan exactly at the mark is skipped
    assert [r.scan_id for r in done.collect()] == [1]
    t = flatten.compliance_tree(done, hosts, items).collect()
    assert len(t) == 2 and {json.loads(r.compliance_data)["x"] for r in t} == {1, 2}
    # two items on one host share a key: the key is not unique, so no in-run dedup by default
    spec = R.REGISTRY["compliance"]
    keys = [r.k for r in flatten.compliance_tree(done, hosts, items).select(spec.key().alias("k")).collect()]
    assert keys == ["1_7_5", "1_7_5"]


def test_feed_selection_and_groups():
    assert R.select_feeds("all")[0] == "asset" and len(R.select_feeds("all")) == 10
    assert R.select_feeds("plugin,asset") == ["asset", "plugin"]
    with pytest.raises(ValueError):
        R.select_feeds(["asset", "nope"])
    g = R.groups()
    assert list(g) == ["assets", "vulnerabilities", "plugins"] and len(g["vulnerabilities"]) == 4


def test_registry_frame_and_custom_spec(spark):
    spec = R.FeedSpec("x", "vulnerabilities", "x_type", "X", "x", 99, source="vulns",
                      predicate=lambda: F.col("severity") == "critical",
                      key=lambda: F.col("asset.uuid"))
    reg = R.register(spec)
    df = R.registry_frame(spark, reg)
    assert df.count() == 11 and df.filter(F.col("feed") == "x").first().sourcetype == R.SOURCETYPE_PREFIX + "x"


def test_extract_many_equals_separate_extracts(spark, tmp_root):
    docs = [vuln("u1", 10, 443, "tcp"), vuln("u1", 11, None, None, agent=True),
            vuln("u2", 12, 80, "udp", sev="info"), vuln("u3", 13, 22, "tcp", sev="critical", agent=True,
                                                        found="2026-03-01T00:00:00Z")]
    v = readers.vulns(spark, write_lines(os.path.join(tmp_root, "v"), docs))
    names = ["vulnerability", "vulnerability_no_info", "vulnerability_self_scan"]
    marks = {"vulnerability": 1769904000}                      # 2026-02-01: only u3 is newer
    one_scan = sorted((r.feed, r.item_id) for r in feeds.extract_many([R.REGISTRY[n] for n in names], v, marks)
                      .select("feed", "item_id").collect())
    separate = sorted((n, r.item_id) for n in names
                      for r in feeds.extract(R.REGISTRY[n], v, mark=marks.get(n)).collect())
    assert one_scan == separate and ("vulnerability", "u3_13_22_tcp") in one_scan
