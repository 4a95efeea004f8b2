"""Snapshot feeds as streams: nothing is reported gone before a snapshot is complete."""

import glob
import gzip
import json
import os

from vigil.operators import state as S
from vigil.plans import registry as R
from vigil.streaming.runner import stream_documents

NOW = 1_800_000_000
SPEC = R.REGISTRY["deleted_asset"]


def put(land, snapshot, name, ids):
    folder = os.path.join(land, f"snapshot={snapshot}")
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("".join(json.dumps({"id": i, "has_plugin_results": True}) + "\n" for i in ids))


def manifest(land, snapshot, n):
    folder = os.path.join(land, f"snapshot={snapshot}")
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, "manifest.json"), "w") as f:
        f.write(json.dumps({"records": n}) + "\n")


def gone(root, run="*"):
    return sorted(json.loads(x)["event"]["asset_id"]
                  for p in glob.glob(os.path.join(root, "outbox", f"run={run}", "feed=deleted_asset", "*.json.gz"))
                  for x in gzip.decompress(open(p, "rb").read()).decode().split("\n"))


def run(spark, land, root, n, **kw):
    stream_documents(spark, SPEC, land, root, now=NOW + n, emit="once", **kw)


def test_no_deletion_before_the_snapshot_is_complete(spark, tmp_root):
    land, root = os.path.join(tmp_root, "land"), os.path.join(tmp_root, "r")
    put(land, "001", "a.json", ["a", "b", "c", "d"])
    manifest(land, "001", 4)
    run(spark, land, root, 1)
    assert gone(root) == [] and S.load(spark, f"{root}/state").count() == 4
    manifest(land, "002", 3)                        # the manifest may come first
    put(land, "002", "a.json", ["a"])
    run(spark, land, root, 2)
    assert gone(root) == [] and S.load(spark, f"{root}/state").count() == 4
    put(land, "002", "b.json", ["b", "e"])
    run(spark, land, root, 3, batch_size=1,
        transport="python:failing_transport:FailingFolder:{outbox}?fail_match=%22c%22")
    assert gone(root) == ["d"]                      # c was refused: it waits
    run(spark, land, root, 4)
    assert gone(root) == ["c", "d"]
    assert sorted(r.item_id for r in S.load(spark, f"{root}/state").collect()) == ["a", "b", "e"]
    assert not glob.glob(os.path.join(root, "staged", "batch=*", "snapshot=*"))
    run(spark, land, root, 5)
    assert gone(root) == ["c", "d"]


def test_a_newer_snapshot_supersedes_and_many_files_add_up(spark, tmp_root):
    land, root = os.path.join(tmp_root, "land"), os.path.join(tmp_root, "r")
    put(land, "001", "a.json", ["a", "b"])
    manifest(land, "001", 2)
    run(spark, land, root, 1)
    put(land, "002", "a.json", ["a"])               # never completed
    put(land, "003", "a.json", ["b"])
    put(land, "003", "b.json", ["c"])
    manifest(land, "003", 2)
    run(spark, land, root, 2, max_files_per_trigger=1)
    assert gone(root) == ["a"]
    manifest(land, "002", 1)                        # too late: an older snapshot says nothing any more
    run(spark, land, root, 3)
    assert gone(root) == ["a"] and sorted(r.item_id for r in S.load(spark, f"{root}/state").collect()) == ["b", "c"]
