"""Streams lose nothing: failed and capped events go out with the next run, replays send nothing twice."""

import glob
import gzip
import json
import os

import pytest
from landing_files import write_lines

from vigil.operators import state as S
from vigil.plans import registry as R
from vigil.streaming.runner import stream_documents

NOW = 1_800_000_000
SPEC = R.REGISTRY["vulnerability"]


def doc(i):
    return json.dumps({"asset": {"uuid": f"u{i}"}, "plugin": {"id": i}, "port": {"port": 1, "protocol": "tcp"},
                       "severity": "high", "state": "OPEN", "last_found": "2026-01-01T00:00:00Z"})


def failing(text):
    return f"python:failing_transport:FailingFolder:{{outbox}}?fail_match={text}"


def sent(root, run="*"):
    return sorted(json.loads(x)["event"]["plugin"]["id"]
                  for p in glob.glob(os.path.join(root, "outbox", f"run={run}", "feed=vulnerability", "*.json.gz"))
                  for x in gzip.decompress(open(p, "rb").read()).decode().split("\n"))


def run(spark, land, root, **kw):
    stream_documents(spark, SPEC, land, root, now=NOW, batch_size=1, **kw)


def add(land, name, docs):
    with open(os.path.join(land, name), "w") as f:
        f.write("".join(d + "\n" for d in docs))


@pytest.fixture()
def place(tmp_root):
    return write_lines(os.path.join(tmp_root, "land"), [doc(i) for i in range(4)]), os.path.join(tmp_root, "r")


def test_failed_batch_goes_out_with_the_next_run_over_unchanged_files(spark, place):
    land, root = place
    run(spark, land, root, transport=failing("u2"))
    assert sent(root) == [0, 1, 3]
    assert S.load(spark, f"{root}/state").count() == 3
    run(spark, land, root, transport=failing("u2"))         # still refused: it keeps waiting
    assert sent(root) == [0, 1, 3]
    run(spark, land, root)
    assert sent(root) == [0, 1, 2, 3] and sent(root, "resend-*") == [2]
    assert S.load(spark, f"{root}/state").count() == 4
    run(spark, land, root)
    assert sent(root) == [0, 1, 2, 3]


def test_next_micro_batch_takes_what_waits(spark, place):
    land, root = place
    run(spark, land, root, transport=failing("u2"))
    add(land, "part-1.json", [doc(2), doc(9)])              # the waiting key again, and a new one
    import vigil.streaming.runner as runner
    kept, runner.resend = runner.resend, lambda *_: None    # a daemon: no run starts in between
    try:
        run(spark, land, root)
    finally:
        runner.resend = kept
    assert sent(root, "1") == [2, 9] and sent(root) == [0, 1, 2, 3, 9]


def test_capped_stream_sends_the_rest_later(spark, place):
    land, root = place
    for n in range(1, 5):
        run(spark, land, root, max_events=1)
        assert len(sent(root)) == n
    assert sent(root) == [0, 1, 2, 3]
    run(spark, land, root, max_events=1)
    assert sent(root) == [0, 1, 2, 3]


def test_replayed_batch_sends_nothing_twice(spark, place):
    land, root = place
    run(spark, land, root, transport=failing("u2"))
    done = os.path.join(root, "_checkpoint", "commits")
    for f in ("0", ".0.crc"):
        os.remove(os.path.join(done, f))                    # Spark went down before it noted the batch as done
    mark = os.path.getmtime(os.path.join(root, "state", "marks"))
    before = sorted(glob.glob(os.path.join(root, "outbox", "run=0", "**"), recursive=True))
    import vigil.streaming.runner as runner
    kept, runner.resend = runner.resend, lambda *_: None
    try:
        run(spark, land, root)
    finally:
        runner.resend = kept
    assert sent(root) == [0, 1, 3] and os.path.getmtime(os.path.join(root, "state", "marks")) == mark
    assert sorted(glob.glob(os.path.join(root, "outbox", "run=0", "**"), recursive=True)) == before
    run(spark, land, root)
    assert sent(root) == [0, 1, 2, 3]


def test_crash_before_the_commit_sends_again_and_loses_nothing(spark, place, monkeypatch):
    land, root = place

    def crash(*_, **__):
        raise RuntimeError("down")
    commit = S.commit
    monkeypatch.setattr(S, "commit", crash)
    with pytest.raises(Exception, match="down"):
        run(spark, land, root, transport=failing("u2"))
    monkeypatch.setattr(S, "commit", commit)
    run(spark, land, root)                                  # the batch runs again, under the same batch ids
    assert sent(root) == [0, 1, 2, 3] and S.load(spark, f"{root}/state").count() == 4
    run(spark, land, root)
    assert sent(root) == [0, 1, 2, 3]


def test_events_without_a_key_and_refused_ones(spark, place):
    land, root = place
    run(spark, land, root, transport=failing("u1") + "&status=400")
    assert sent(root) == [0, 2, 3] and S.load(spark, f"{root}/state").count() == 4      # a dead letter is settled
    run(spark, land, root)
    assert sent(root) == [0, 2, 3]


@pytest.mark.parametrize("parent", ["plain", "scans"])
def test_compliance_stream_reads_host_details_wherever_they_lie(spark, tmp_root, parent):
    land, root = os.path.join(tmp_root, "data", parent, "land"), os.path.join(tmp_root, "r")
    write_lines(os.path.join(land, "scans"), [json.dumps({"id": 1, "name": "s", "status": "completed",
                                                          "last_modification_date": 5})])
    write_lines(os.path.join(land, "scan_details"), [json.dumps({"scan_id": 1, "hosts": [{"host_id": 7, "hostname": "h"}]})])
    write_lines(os.path.join(land, "host_details"), [json.dumps({"scan_id": 1, "host_id": 7, "compliance": [
        {"plugin_id": 5}, {"plugin_id": 6}]})])
    stream_documents(spark, R.REGISTRY["compliance"], f"{land}/host_details", root, now=NOW,
                     transport="python:failing_transport:FailingFolder:{outbox}?fail_match=%22plugin_id%22%3A5", batch_size=1)
    stream_documents(spark, R.REGISTRY["compliance"], f"{land}/host_details", root, now=NOW)
    got = sorted(json.loads(x)["event"]["compliance_data"]["plugin_id"]
                 for p in glob.glob(os.path.join(root, "outbox", "run=*", "feed=compliance", "*.json.gz"))
                 for x in gzip.decompress(open(p, "rb").read()).decode().split("\n"))
    assert got == [5, 6]
