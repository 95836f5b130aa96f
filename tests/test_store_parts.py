"""Chunked copies into targets that can't be written at offsets."""

import json
import os

import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F

import drayage
from drayage.operators import store_parts, transfer
from drayage.settings import STAGING_DIR
from drayage.sources import files
from test_transfer import BODIES, Store


class Flaky:
    """A local file system that gives up before one of its steps, as a killed task would."""

    def __init__(self, method, marker):
        self.method, self.marker, self.fs = method, marker, pafs.LocalFileSystem()

    def __getattr__(self, name):
        if name in ("fs", "method", "marker"):
            raise AttributeError(name)

        def call(*args, **kwargs):
            if name == self.method and any(self.marker in str(a) for a in args):
                raise OSError("killed")
            return getattr(self.fs, name)(*args, **kwargs)
        return call

    def __reduce__(self):
        return Flaky, (self.method, self.marker)


def opened(method="", marker="\0"):
    return lambda root: (Flaky(method, marker), root)


@pytest.fixture
def plan(spark, objects):
    return drayage.build_plan(objects([(k, len(v)) for k, v in BODIES.items()] + [("dir/", 0)]), chunk_size=100, unique_keys=True)


def targets_of(spark):
    return spark.createDataFrame([(k, f"t/{k}") for k in [*BODIES, "dir/"]], "key string, target string")


def complete(dest):
    for key, body in BODIES.items():
        with open(f"{dest}/t/{key}", "rb") as got:
            assert got.read() == body
    assert os.path.isdir(f"{dest}/t/dir") and not os.path.isdir(f"{dest}/{STAGING_DIR}") or not os.listdir(f"{dest}/{STAGING_DIR}")


@pytest.mark.parametrize("fan_in", [2, 7, 64])
def test_parts_are_put_together(spark, tmp_path, plan, fan_in):
    dest = str(tmp_path / "dest")
    os.makedirs(dest)
    got = drayage.copy_parts(plan, targets_of(spark), Store(BODIES, longest=60), dest, fan_in=fan_in, open_dest=opened())
    assert {r["target"]: r["status"] for r in got.objects.collect()} == {**{f"t/{k}": "done" for k in BODIES}, "t/dir/": "marker"}
    complete(dest)


@pytest.mark.parametrize("method,marker", [
    ("open_output_stream", "/t/"), ("move", "00-00000007"), ("move", "02-00000001"), ("open_input_stream", "01-00000003"), ("move", "/t/d/e/f"),
    ("delete_dir", STAGING_DIR)])
def test_a_job_that_stops_anywhere_goes_on(spark, tmp_path, plan, method, marker):
    dest = str(tmp_path / "dest")
    os.makedirs(dest)
    first = drayage.copy_parts(plan, targets_of(spark), Store(BODIES), dest, "again", fan_in=3, open_dest=opened(method, marker))
    failed = {r["target"] for r in first.objects.where("status = 'failed'").collect()}
    assert failed or marker == "/t/"
    sent = first.parts.where("status = 'done'").count()
    second = drayage.copy_parts(plan, targets_of(spark), Store(BODIES), dest, "again", on_failure="fail", fan_in=3, open_dest=opened())
    complete(dest)
    kept = second.parts.where("tries = 0").count()
    if failed and method != "delete_dir":
        assert 0 < kept <= sent      # of the uploads that were complete the parts are gone and are sent again
    assert {r["status"] for r in second.objects.collect()} == {"done", "marker"}


def test_failing_sources_shared_targets_and_slices(spark, tmp_path, plan):
    dest = str(tmp_path / "dest")
    os.makedirs(dest)
    got = drayage.copy_parts(plan, targets_of(spark), Store(BODIES, fail_key="d/c"), dest, "r", open_dest=opened())
    assert {r["target"]: r["status"] for r in got.objects.collect()}["t/d/c"] == "failed" and not os.path.exists(dest + "/t/d/c")
    shared = spark.createDataFrame([("d/a", "x"), ("d/c", "./x")], "key string, target string")
    got = drayage.copy_parts(plan.where("key in ('d/a', 'd/c')"), shared, Store(BODIES), dest, open_dest=opened())
    assert {r["error"] for r in got.objects.collect()} == {"shared_target"} and not os.path.exists(dest + "/x")
    half = drayage.copy_parts(plan.where("part_number <= 3 and key = 'd/a'"), targets_of(spark), Store(BODIES), dest, "h", open_dest=opened())
    assert [r["status"] for r in half.objects.collect()] == ["partial"]
    rest = drayage.copy_parts(plan.where("part_number > 3 and key = 'd/a'"), targets_of(spark), Store(BODIES), dest, "h", open_dest=opened())
    os.unlink(dest + "/t/d/a")
    whole = drayage.operators.commit_parts(half.parts.unionByName(rest.parts), dest, open_dest=opened())
    assert [r["status"] for r in whole.collect()] == ["done"] and open(dest + "/t/d/a", "rb").read() == BODIES["d/a"]


def test_grown_sources_and_cleaning(spark, tmp_path, plan):
    dest = str(tmp_path / "dest")
    os.makedirs(dest)
    grown = {**BODIES, "d/a": BODIES["d/a"] + b"more"}
    got = drayage.copy_parts(plan.where("key = 'd/a'"), targets_of(spark), Store(grown), dest, "g", open_dest=opened())
    assert [r["status"] for r in got.objects.collect()] == ["interrupted"] and not os.path.exists(dest + "/t/d/a")
    uploads = drayage.list_uploads(spark, dest)
    assert uploads.count() == 1
    report = drayage.stale_uploads(uploads, "2100-01-01 00:00:00")
    assert [r["action"] for r in drayage.clean_parts(report, dest, open_dest=opened()).collect()] == ["would_remove"]
    assert [r["action"] for r in drayage.clean_parts(report, dest, False, opened()).collect()] == ["removed"]
    assert drayage.list_uploads(spark, dest).count() == 0


def test_tree_has_bounded_nodes():
    with pytest.raises(ValueError):
        store_parts.commit_parts(None, "x", fan_in=1)


class Tagging(Flaky):
    """A local file system that keeps the metadata of an object in a file beside it."""

    def __init__(self):
        super().__init__("", "\0")

    def open_output_stream(self, path, metadata=None):
        if metadata:
            with open(f"{path}.tags", "w") as out:
                json.dump(metadata, out)
        return self.fs.open_output_stream(path)

    def move(self, source, target):
        self.fs.move(source, target)
        if os.path.exists(f"{source}.tags"):
            self.fs.move(f"{source}.tags", f"{target}.tags")

    def __reduce__(self):
        return Tagging, ()


def tags(path):
    with open(f"{path}.tags") as got:
        return json.load(got)


def test_metadata_reaches_the_objects_put_together(spark, tmp_path, plan):
    dest = str(tmp_path / "dest")
    os.makedirs(dest)
    told = drayage.attach_metadata(plan, [("project", "a\u00e9"), ("Content-Type", "text/plain")])
    drayage.copy_parts(told, targets_of(spark), Store(BODIES), dest, fan_in=2, open_dest=lambda root: (Tagging(), root), on_failure="fail")
    assert {len(body) > 100 for body in BODIES.values()} == {True, False}
    for key in BODIES:
        assert tags(f"{dest}/t/{key}") == {"project": "a\u00e9", "Content-Type": "text/plain"}
    complete(dest)


def test_metadata_of_whole_objects(spark, objects, tmp_path, monkeypatch):
    source, dest = {"k": b"body"}, str(tmp_path)
    monkeypatch.setattr(files, "open_root", lambda uri: (Tagging(), dest))
    monkeypatch.setattr(transfer, "open_root", lambda uri: (Tagging(), dest))
    twice = drayage.attach_metadata(objects([("k", 3)]), [("n", "old")]).unionByName(
        drayage.attach_metadata(objects([("k", 4)]), [("n", "new")]))
    targets = spark.createDataFrame([("k", "t/k")], "key string, target string")
    work = [row.asDict() for row in transfer._plain_work(twice, targets).collect()]
    assert [row["metadata"] for row in work] == ['{"n":"new"}']
    assert transfer._copy_whole(Store(source), work[0], "stand-in://dest", "run")["status"] == "done"
    assert tags(f"{dest}/t/k") == {"n": "new"}
    plain = [row.asDict() for row in transfer._plain_work(twice.drop("metadata"), targets).collect()]
    assert transfer.metadata_of(plain[0]) == {}
    odd = twice.withColumn("metadata", F.lit("text of another kind"))
    assert [row["metadata"] for row in transfer._plain_work(odd, targets).collect()] == [None]


def test_a_part_appears_by_three_calls_of_the_store(tmp_path):
    calls = []

    class Counted:
        def __getattr__(self, name):
            return lambda *args, **names: (calls.append(name), getattr(pafs.LocalFileSystem(), name)(*args, **names))[1]

    with store_parts._appearing(Counted(), str(tmp_path), "up/00") as (out, keep):
        out.write(b"x")
        keep()
    assert calls == ["create_dir", "open_output_stream", "move"] and (tmp_path / "up/00").read_bytes() == b"x"
    with store_parts._appearing(Counted(), str(tmp_path), "up/01") as (out, keep):
        out.write(b"x")
    assert os.listdir(tmp_path / "up") == ["00"]


class Watched(Flaky):
    """A local file system that notes, before each move, the files of unfinished uploads by their folders."""

    def __init__(self, dest):
        super().__init__("", "\0")
        self.dest = dest

    def move(self, source, target):
        staged = [(folder, n) for folder, _, names in os.walk(f"{self.dest}/{STAGING_DIR}") for n in names if not n.startswith("shared-")]
        with open(f"{self.dest}.seen", "a") as seen:
            seen.write(json.dumps(staged) + "\n")
        self.fs.move(source, target)

    def __reduce__(self):
        return Watched, (self.dest,)


def many_bodies():
    return {f"m/{i:02d}": bytes([i]) * (100 * (i % 7) + 50) for i in range(40)}


def test_staged_files_are_those_of_one_wave(spark, objects, tmp_path, monkeypatch):
    monkeypatch.setattr(store_parts, "WAVE_FILES", 60)
    bodies, dest = many_bodies(), str(tmp_path / "dest")
    os.makedirs(dest)
    plan = drayage.build_plan(objects([(k, len(v)) for k, v in bodies.items()]), chunk_size=100, unique_keys=True)
    targets = spark.createDataFrame([(k, f"t/{k}") for k in bodies], "key string, target string")
    got = drayage.copy_parts(plan, targets, Store(bodies), dest, fan_in=2, open_dest=lambda root: (Watched(dest), root), on_failure="fail")
    for key, body in bodies.items():
        with open(f"{dest}/t/{key}", "rb") as copied:
            assert copied.read() == body
    uploads = [len({folder for folder, _ in json.loads(line)}) for line in open(f"{dest}.seen")]
    assert 1 < max(uploads) < len(bodies) / 2
    assert got.parts.count() == got.parts.select("target", "part_number").distinct().count() == plan.count()
    assert sorted((r["target"], r["status"]) for r in got.objects.collect()) == sorted((f"t/{k}", "done") for k in bodies)
    assert not os.path.exists(f"{dest}/{STAGING_DIR}")


def test_waves_report_failures_at_the_end_and_go_on(spark, objects, tmp_path, monkeypatch):
    monkeypatch.setattr(store_parts, "WAVE_FILES", 60)
    bodies, dest = many_bodies(), str(tmp_path / "dest")
    os.makedirs(dest)
    plan = drayage.build_plan(objects([(k, len(v)) for k, v in bodies.items()]), chunk_size=100, unique_keys=True)
    targets = spark.createDataFrame([(k, f"t/{k}") for k in bodies if k != "m/03"], "key string, target string")
    with pytest.raises(transfer.TransferFailed):
        drayage.copy_parts(plan, targets, Store(bodies, fail_key="m/20"), dest, "r", open_dest=opened(), on_failure="fail")
    assert sorted(os.listdir(f"{dest}/t/m")) == sorted(k[2:] for k in bodies if k not in ("m/03", "m/20"))
    plan = plan.where("key = 'm/20'")
    got = drayage.copy_parts(plan, targets, Store(bodies), dest, "r", open_dest=opened(), on_failure="fail")
    assert [(r["target"], r["bytes"], r["status"]) for r in got.objects.collect()] == [("t/m/20", 650, "done")]


def test_what_is_put_together_is_removed(tmp_path):
    fs, root, upload = pafs.LocalFileSystem(), str(tmp_path), "ab" + "0" * 30
    row = {"key": "k", "target": "t/k", "upload_id": upload, "n_parts": 7, "target_size": 65, "input_offset": 0, "at_end": False}
    body = bytes(range(65))

    def put(again=True):
        return [store_parts._put_part(fs, root, Store({"k": body}), {
            **row, "part_number": n + 1, "input_offset": 10 * n, "part_size": min(10, 65 - 10 * n)}, 2, again)["tries"] for n in range(7)]

    def join(level, number):
        size = min(10 * 2 ** level, 65 - number * 10 * 2 ** level)
        below = -(-7 // 2 ** (level - 1))
        return store_parts._join_node(fs, root, {**row, "level": level, "number": number, "height": 3, "part_size": size,
                                                 "n_children": min(2, below - 2 * number)}, 2)

    def names():
        return sorted(n for n in os.listdir(f"{root}/{STAGING_DIR}/ab/{upload}") if n != transfer.INITIATED)
    assert put() == [1] * 7 and len(names()) == 7
    with open(f"{root}/{STAGING_DIR}/ab/{upload}/{transfer.INITIATED}", "w") as out:
        out.write("{}")
    for level, many in ((1, 4), (2, 2), (3, 1)):
        for number in range(many):
            assert join(level, number) == {"status": "done", "bytes": min(10 * 2 ** level, 65 - number * 10 * 2 ** level)}
        assert names() == [f"{level:02d}-{n:08d}" for n in range(many)]
        assert put() == [0] * 7 and len(names()) == many       # a later call finds them in the nodes
        assert all(join(lower, n)["status"] == "done" for lower in range(1, level) for n in range(-(-7 // 2 ** lower)))
    with open(f"{root}/{store_parts.place_of(upload, 3, 0)}", "rb") as whole:
        assert whole.read() == body
    os.unlink(f"{root}/{store_parts.place_of(upload, 3, 0)}")
    assert put() == [1] * 7 and join(1, 0)["status"] == "done" and put() == [0] * 7
