import datetime
import os
import random

import pytest
from pyspark.sql import functions as F

import drayage
from drayage.operators import transfer
from drayage.operators.transfer import fetch
from drayage.sources import files

BODIES = {"d/a": random.Random(1).randbytes(1000), "d/b": b"", "d/c": b"x", "d/e/f": random.Random(2).randbytes(5003)}


class Store:
    """Bodies in memory; responses are cut short or fail as told."""

    def __init__(self, bodies, longest=None, fail_first=0, fail_key=None, counter=None):
        self.bodies, self.longest, self.fail_key = bodies, longest, fail_key
        self.fail_first, self.counter = fail_first, counter

    def read(self, key, offset, length):
        if key == self.fail_key:
            raise OSError("no connection")
        if self.fail_first:
            self.fail_first -= 1
            yield self.bodies[key][offset:offset + 1]
            raise OSError("reset")
        yield self.bodies[key][offset:offset + min(length, self.longest or length)]


def run_fetch(store, length, key="k"):
    got = bytearray(length)

    def write(position, piece):
        got[position:position + len(piece)] = piece
    return bytes(got), fetch(store, key, 0, length, write), got


def test_fetch_resumes_short_responses():
    body = random.Random(0).randbytes(95)
    _, result, got = run_fetch(Store({"k": body}, longest=10), 95)
    assert got == body and (result["status"], result["tries"], result["responses"]) == ("done", 1, 10)


def test_fetch_gives_up_after_six_tries_of_ten_responses():
    _, result, _ = run_fetch(Store({"k": bytes(101)}, longest=10), 101)
    assert (result["status"], result["tries"], result["responses"]) == ("failed", 6, 60)


def test_fetch_starts_over_after_an_error():
    body = bytes(range(50))
    _, result, got = run_fetch(Store({"k": body}, fail_first=5), 50)
    assert got == body and (result["status"], result["tries"]) == ("done", 6)
    _, result, _ = run_fetch(Store({"k": body}, fail_first=6), 50)
    assert result["status"] == "failed" and result["error"] == "reset"


@pytest.fixture
def planned(objects):
    some = objects([(k, len(b)) for k, b in BODIES.items()] + [("d/dir/", 0)])
    plan = drayage.build_plan(some, chunk_size=100)
    return some, plan, drayage.map_download_targets(some, "d/", "bucket", "out")


def stored(root):
    found = {}
    for folder, _, names in os.walk(root):
        for name in names:
            path = os.path.join(folder, name)
            with open(path, "rb") as source:
                found[os.path.relpath(path, root)] = source.read()
    return found


EXPECTED = {"out" + k[1:]: b for k, b in BODIES.items()}


@pytest.mark.parametrize("store", [Store(BODIES), Store(BODIES, longest=30), Store(BODIES, fail_first=2)])
def test_multipart(planned, tmp_path, store):
    _, plan, targets = planned
    result = drayage.copy_multipart(plan, targets, store, str(tmp_path))
    assert {r["status"] for r in result.objects.collect()} == {"done", "marker"}
    assert stored(tmp_path) == EXPECTED and (tmp_path / "out/dir").is_dir()
    assert not (tmp_path / ".uploads").exists()
    assert result.parts.count() == plan.count()
    chunks = drayage.finished_chunks(result.parts)
    assert drayage.throughput(chunks).first()["n_bytes"] == sum(map(len, BODIES.values()))
    ticks = drayage.progress_ticks(chunks, "1 hour", 7000, 99).orderBy("tick_start").collect()
    assert ticks[-1]["finished_text"] == f"{plan.count()} / 99"


def test_whole_objects(planned, tmp_path):
    some, plan, targets = planned
    (tmp_path / "out/e/f").mkdir(parents=True)
    (tmp_path / "out/a").write_bytes(b"old")
    got = {r["key"]: r for r in drayage.copy_objects(some, targets, Store(BODIES, fail_first=1), str(tmp_path)).collect()}
    assert {k: r["status"] for k, r in got.items()} == {
        "d/a": "done", "d/b": "done", "d/c": "done", "d/e/f": "skipped_directory", "d/dir/": "marker"}
    assert stored(tmp_path) == {k: b for k, b in EXPECTED.items() if k != "out/e/f"}


def test_a_whole_plan(planned, tmp_path):
    _, plan, targets = planned
    result = drayage.copy_plan(plan, targets, Store(BODIES), str(tmp_path), on_failure="fail")
    assert result.count() == 5 and stored(tmp_path) == EXPECTED


def test_failures_are_reported_or_raised(planned, tmp_path):
    some, plan, targets = planned
    broken = Store(BODIES, fail_key="d/a")
    got = {r["key"]: r for r in drayage.copy_multipart(plan, targets, broken, str(tmp_path)).objects.collect()}
    assert got["d/a"]["status"] == "failed" and got["d/a"]["error"] == "no connection"
    assert got["d/e/f"]["status"] == "done" and "out/a" not in stored(tmp_path)
    got = {r["key"]: r for r in drayage.copy_objects(some, targets.where("key <> 'd/c'"), broken, str(tmp_path)).collect()}
    assert (got["d/a"]["status"], got["d/a"]["tries"]) == ("failed", 6) and got["d/c"]["error"] == "missing_target"
    with pytest.raises(drayage.TransferFailed, match="no connection"):
        drayage.copy_objects(some, targets, broken, str(tmp_path), on_failure="fail")
    assert {k: b for k, b in stored(tmp_path).items() if not k.startswith(".uploads")} == {
        k: b for k, b in EXPECTED.items() if k != "out/a"}


def test_targets_outside_the_root_are_refused(objects, tmp_path):
    some = objects([("k", 3)])
    targets = some.select("key", F.lit("../../escape").alias("target"))
    store = Store({"k": b"abc"})
    assert "leaves the root" in drayage.copy_objects(some, targets, store, str(tmp_path)).first()["error"]
    result = drayage.copy_multipart(drayage.build_plan(some, chunk_size=2), targets, store, str(tmp_path))
    assert "leaves the root" in result.objects.first()["error"]


def test_parts_that_failed_are_sent_again(planned, tmp_path):
    _, plan, targets = planned
    first = drayage.copy_multipart(plan, targets, Store(BODIES, fail_key="d/e/f"), str(tmp_path), "run")
    assert "out/e/f" not in stored(tmp_path)
    failed = first.parts.where("status = 'failed'").select("key", "part_number")
    second = drayage.copy_multipart(plan.join(failed, ["key", "part_number"], "left_semi"), targets, Store(BODIES),
                                    str(tmp_path), "run")
    assert second.parts.count() == failed.count() == 51
    assert stored(tmp_path) == EXPECTED


def test_nodes_of_a_grid_fill_one_target(planned, tmp_path):
    _, plan, targets = planned
    done = [drayage.copy_multipart(drayage.grid_slice(plan, 3, node), targets, Store(BODIES), str(tmp_path), "run")
            for node in (1, 2, 3)]
    statuses = {r["status"] for part in done for r in part.objects.where("key = 'd/e/f'").collect()}
    assert statuses == {"partial"} and "out/e/f" not in stored(tmp_path)
    parts = done[0].parts.unionByName(done[1].parts).unionByName(done[2].parts)
    assert {r["status"] for r in drayage.publish_copies(parts, str(tmp_path)).collect()} == {"done", "marker"}
    assert stored(tmp_path) == EXPECTED


def test_split_files_join_to_the_source(planned, tmp_path):
    _, plan, _ = planned
    nodes = 5
    drayage.write_split(drayage.grid_assign(plan, nodes), nodes, Store(BODIES), str(tmp_path), on_failure="fail")
    found = stored(tmp_path)
    for key, body in BODIES.items():
        assert b"".join(found.get(f"node={n}/{key}", b"") for n in range(1, nodes + 1)) == body


def test_multipart_targets_are_mounted(planned):
    _, plan, targets = planned
    with pytest.raises(ValueError, match="mounted"):
        drayage.copy_multipart(plan, targets, Store(BODIES), "s3://bucket/x")


def test_stale_uploads_are_removed_on_request(spark, planned, tmp_path):
    _, plan, targets = planned
    root = str(tmp_path)
    assert drayage.list_uploads(spark, root).count() == 0
    drayage.copy_multipart(plan, targets, Store(BODIES, fail_key="d/a"), root, "run")
    uploads = drayage.list_uploads(spark, root)
    assert uploads.count() == 1
    fresh = drayage.stale_uploads(uploads, F.current_timestamp())
    assert fresh.count() == 0
    stale = drayage.stale_uploads(uploads, F.current_timestamp() + F.make_dt_interval(F.lit(8)))
    assert [r["action"] for r in drayage.clean_parts(stale, root).collect()] == ["would_remove"]
    assert drayage.list_uploads(spark, root).count() == 1
    assert [r["action"] for r in drayage.clean_parts(stale, root, dry_run=False).collect()] == ["removed"]
    assert [r["action"] for r in drayage.clean_parts(stale, root, dry_run=False).collect()] == ["absent"]
    assert drayage.list_uploads(spark, root).count() == 0


def test_stale_means_strictly_older(spark):
    uploads = spark.sql("select 'k' key, n upload_id, timestamp_ntz'2024-01-24 00:00:00' + make_dt_interval(0,0,0,n) initiated "
                        "from values (-1), (0), (1) t(n)")
    got = drayage.stale_uploads(uploads, "2024-01-31 00:00:00").collect()
    assert [(r["upload_id"], r["initiated_text"]) for r in got] == [(-1, "23-01-2024 23:59:59")]
    evil = spark.createDataFrame([("k", "../x")], "key string, upload_id string")
    assert drayage.clean_parts(evil, "/tmp", dry_run=True).first()["action"] == "failed"


def test_keys_that_share_a_target_are_refused(objects, spark, tmp_path):
    bodies = {"x": b"A" * 64, "y": b"B" * 64, "z": b"C" * 64}
    some = objects([(k, 64) for k in bodies])
    targets = spark.createDataFrame([("x", "same"), ("y", "./same/"), ("z", "a//b"), ("z", "c")],
                                    "key string, target string")
    (tmp_path / "whole").mkdir()
    whole = drayage.copy_objects(some, targets, Store(bodies), str(tmp_path / "whole")).collect()
    parts = drayage.copy_multipart(drayage.build_plan(some, chunk_size=1), targets, Store(bodies), str(tmp_path / "cut"))
    for rows in (whole, parts.objects.collect()):
        assert sorted((r["key"], r["target"], r["status"], r["error"]) for r in rows) == [
            ("x", "same", "failed", "shared_target"), ("y", "./same/", "failed", "shared_target"),
            ("z", "a//b", "done", None), ("z", "c", "done", None)]
    assert stored(tmp_path / "whole") == stored(tmp_path / "cut") == {"a/b": bodies["z"], "c": bodies["z"]}


def test_sources_that_grew_or_shrank(objects, tmp_path):
    bodies = {"grown": bytes(10), "same": bytes(4), "shrunk": bytes(3)}
    some = objects([(k, 4) for k in bodies])
    targets = some.select("key", F.col("key").alias("target"))
    (tmp_path / "grown").write_bytes(b"GOOD")
    whole = drayage.copy_objects(some, targets, Store(bodies), str(tmp_path))
    assert {r["key"]: r["status"] for r in whole.collect()} == {"grown": "interrupted", "same": "done", "shrunk": "failed"}
    cut = drayage.copy_multipart(drayage.build_plan(some, chunk_size=3), targets, Store(bodies), str(tmp_path))
    assert {r["key"]: r["status"] for r in cut.objects.collect()} == {"grown": "interrupted", "same": "done", "shrunk": "failed"}
    assert {k: v for k, v in stored(tmp_path).items() if not k.startswith(".uploads")} == {"grown": b"GOOD", "same": bytes(4)}


def test_roots_that_are_not_shared(tmp_path):
    with files.shared_root(str(tmp_path)) as check:
        check()
        (token,) = (tmp_path / ".uploads").iterdir()
        token.unlink()
        with pytest.raises(OSError, match="share"):
            check()


def test_short_responses(objects, spark):
    some = objects([(k, len(b)) for k, b in BODIES.items()])
    ranges = drayage.read_ranges(drayage.plan_parts(some, 900), Store(BODIES, longest=100)).orderBy("key", "part_number")
    got = {}
    for row in ranges.collect():
        got[row["key"]] = got.get(row["key"], b"") + bytes(row["body"])
    assert got == BODIES
    with pytest.raises(Exception, match="bytes after 10 responses"):
        drayage.read_ranges(drayage.plan_parts(objects([("d/a", 2000)]), 2000), Store(BODIES)).collect()


def test_status_rows_of_a_running_copy(spark, planned, tmp_path):
    _, plan, targets = planned
    status, state = str(tmp_path / "status"), str(tmp_path / "state")
    stream = drayage.running_copy(spark, status)

    def seen():
        drayage.run_progress_stream(stream, "1 hour", str(tmp_path / "ticks"), state).awaitTermination()
        ticks = spark.read.parquet(str(tmp_path / "ticks")).agg(F.sum("n_bytes"), F.sum("n_chunks")).first()
        return ticks[0], ticks[1]

    drayage.copy_plan(plan, targets, Store(BODIES), str(tmp_path / "out"), status_root=status)
    whole = sum(map(len, BODIES.values()))
    chunks = plan.where("is_multipart").count() + sum(1 for b in BODIES.values() if len(b) <= 100)
    assert seen() == (whole, chunks)
    assert all(name.endswith(".json") for name in os.listdir(status))
    failed = drayage.copy_multipart(plan, targets, Store(BODIES, fail_key="d/a"), str(tmp_path / "again"), status_root=status)
    assert seen() == (2 * whole - 1000, chunks + failed.parts.where("status = 'done'").count())


def test_a_task_that_runs_again_writes_the_same_status_files(spark, tmp_path):
    rows = [{"key": f"k{i}", "bytes": i, "status": "done", "started": datetime.datetime.now(datetime.timezone.utc),
             "finished": datetime.datetime.now(datetime.timezone.utc)} for i in range(3)]
    for _ in range(2):
        transfer._note(rows, str(tmp_path), "copied-x-000000-000000.json", "run")
    assert [n for n in os.listdir(tmp_path) if n.endswith(".json")] == ["copied-x-000000-000000.json"]
    assert spark.read.schema(transfer.STATUS_DDL).json(str(tmp_path)).select("started").distinct().first()[0] is not None


def test_uploads_are_dealt_out_to_folders(spark, objects, tmp_path):
    """All uploads in one folder made tasks wait for each other; a folder has a 256th of them now, and cleaning knows where."""
    plan = drayage.build_plan(objects([(f"k{i}", 20) for i in range(40)]), chunk_size=10).where("part_number = 1")
    targets = plan.selectExpr("key", "concat('t/', key) target")
    drayage.copy_multipart(plan, targets, Store({f"k{i}": bytes(20) for i in range(40)}), str(tmp_path), "r")
    assert len(os.listdir(tmp_path / ".uploads")) > 20
    (tmp_path / ".uploads/0123456789ab/worker-x").mkdir(parents=True)      # of a stopped job
    (tmp_path / ".uploads/0123456789ab/worker-x/left").write_bytes(b"1")
    uploads = drayage.list_uploads(spark, str(tmp_path))
    assert uploads.count() == 41 and uploads.where("initiated is null or length(upload_id) not in (12, 32)").count() == 0
    shard = sorted(os.listdir(tmp_path / ".uploads"))[-1]
    report = uploads.select("key", "upload_id").unionByName(spark.createDataFrame([("x", shard)], "key string, upload_id string"))
    done = drayage.clean_parts(report, str(tmp_path), dry_run=False)
    assert {(r["action"], r["count"]) for r in done.groupBy("action").count().collect()} == {("removed", 41), ("absent", 1)}
    assert not (tmp_path / ".uploads").exists()
