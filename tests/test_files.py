import os
import random

import pyarrow as pa
import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F

import drayage
from drayage.operators import transfer
from drayage.sources import files as sources_files, listing
from drayage.sources.files import below, local_path


@pytest.fixture
def tree(tmp_path):
    files = {"a/b/x.txt": b"xyz", "a/b/empty": b"", "a/bc": b"1", "a/sp ace/ü%20+.bin": bytes(range(256)) * 5,
             "top": b"t", ".uploads/run/part": b"unfinished", "z/.uploads": b"ordinary"}
    for key, body in files.items():
        path = tmp_path / key
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(body)
    (tmp_path / "a/void").mkdir()
    return str(tmp_path), files


def listed(df):
    return {r["key"]: (r["size"], r["is_marker"]) for r in df.collect()}


def test_listing(spark, tree):
    root, files = tree
    expected = {key: (len(body), False) for key, body in files.items()} | {"a/void/": (0, True)}
    assert listed(drayage.list_objects(spark, root)) == expected
    assert listed(drayage.list_objects(spark, "file://" + root)) == expected
    own = {key: value for key, value in expected.items() if not key.startswith(".uploads/")}
    assert listed(drayage.list_objects(spark, root, staging=False)) == own


def test_links_and_pipes(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d/f").write_bytes(b"abc")
    (tmp_path / "file").symlink_to(tmp_path / "d/f")
    (tmp_path / "folder").symlink_to(tmp_path / "d")
    os.mkfifo(tmp_path / "pipe")
    found = drayage.walk(spark, str(tmp_path))
    assert listed(drayage.objects_of(found)) == {"d/f": (3, False), "file": (3, False)}
    assert {(r["key"], r["error"]) for r in drayage.listing_errors(found).collect()} == {
        ("folder", "not a regular file"), ("pipe", "not a regular file")}


def test_listing_in_many_rounds(spark, tree, monkeypatch):
    root, files = tree
    monkeypatch.setattr(listing, "DIRECTORIES_PER_ROUND", 1)
    monkeypatch.setattr(listing, "SIZES_PER_DIRECTORY", 0)
    plan = drayage.walk(spark, root)
    expected = {key: (len(body), False) for key, body in files.items()} | {"a/void/": (0, True)}
    assert listed(drayage.objects_of(plan)) == expected


@pytest.mark.parametrize("per_round,sizes", [(1, 0), (2, 1), (100, 1000)])
def test_scanning_in_one_process(tree, per_round, sizes):
    root, files = tree
    frontier, found = [""], []
    while frontier:
        rows = [r for b in listing._scanner(root, "", per_round, sizes)([pa.RecordBatch.from_pydict({"key": frontier})])
                for r in b.to_pylist()]
        found += [r for r in rows if r["kind"] != "dir"]
        frontier = [r["key"] for r in rows if r["kind"] == "dir"]
    assert sorted(r["key"] for r in found) == sorted([*files, "a/void/"])
    names = [r["key"] for r in found if r["kind"] == "name"]
    sized = [r for b in listing._stat(root)([pa.RecordBatch.from_pydict({"key": names})]) for r in b.to_pylist()]
    assert {r["key"]: r["size"] for r in [*found, *sized] if r["kind"] == "file"} == {k: len(b) for k, b in files.items()}


def test_remote_stores_are_listed_and_written_through_their_file_system(tree, tmp_path_factory, monkeypatch):
    """The code for URIs that aren't mounted, on a file system of pyarrow."""
    root, files = tree
    for module in (listing, sources_files, transfer):
        monkeypatch.setattr(module, "local_path", lambda uri: None)
        monkeypatch.setattr(module, "open_root", lambda uri: (pafs.LocalFileSystem(), uri))
    start = [pa.RecordBatch.from_pydict({"key": [""]})]
    rows = [r for b in listing._scanner(root, "", 100, 0)(start) for r in b.to_pylist()]
    assert {r["key"]: r["size"] for r in rows} == {k: len(b) for k, b in files.items()} | {"a/void/": 0}
    dest = str(tmp_path_factory.mktemp("dest"))
    row = {"key": "a/b/x.txt", "target": "x", "target_size": 3}
    assert transfer._copy_whole(sources_files.FileRanges(root), row, dest, "run")["status"] == "done"
    with open(f"{dest}/x", "rb") as copied:
        assert copied.read() == b"xyz"


@pytest.mark.parametrize("prefix", ["a/", "a/b", "a/b/", "top", "a/void/", "nothing/", "z"])
def test_listing_below_a_prefix(spark, tree, prefix):
    root, files = tree
    keys = set(files) | {"a/void/"}
    got = listed(drayage.list_objects(spark, root, prefix))
    assert set(got) == {k for k in keys if k.startswith(prefix) and len(k) > len(prefix)}


def test_unreadable_entries_are_reported(spark, tree):
    root, files = tree
    os.symlink("gone", os.path.join(root, "dangling"))
    entries = drayage.walk(spark, root)
    assert set(listed(drayage.objects_of(entries))) == set(files) | {"a/void/"}
    assert [r["key"] for r in drayage.listing_errors(entries).collect()] == ["dangling"]
    missing = drayage.walk(spark, root + "/no-such-root")
    assert drayage.listing_errors(missing).count() == 1 and drayage.objects_of(missing).count() == 0


@pytest.mark.parametrize("chunk", [1, 7, 256, 5000])
def test_ranges_put_together_are_the_files(spark, tree, chunk):
    root, files = tree
    plan = drayage.plan_parts(drayage.list_objects(spark, root).where(~F.col("is_marker")), chunk)
    got = {key: {} for key in files}
    for row in drayage.read_ranges(plan, root).collect():
        assert row["bytes_read"] == row["part_size"] == len(row["body"])
        end = row["input_offset"] + row["part_size"] - 1
        assert row["range_header"] == (f"bytes={row['input_offset']}-{end}" if row["part_size"] else None)
        got[row["key"]][row["input_offset"]] = bytes(row["body"])
    assert {key: b"".join(parts[o] for o in sorted(parts)) for key, parts in got.items()} == files


def test_ranges_leave_a_task_in_small_batches(spark, tmp_path, monkeypatch):
    (tmp_path / "f").write_bytes(random.Random(1).randbytes(10_000))
    monkeypatch.setattr("drayage.sources.ranges.BATCH_BYTES", 500)
    plan = drayage.plan_parts(drayage.list_objects(spark, str(tmp_path)), 100)
    body = b"".join(bytes(r["body"]) for r in drayage.read_ranges(plan, str(tmp_path)).orderBy("part_number").collect())
    assert body == (tmp_path / "f").read_bytes()


@pytest.mark.parametrize("chunk", [1, 3, 10, 1000])
def test_slices_of_bodies(spark, chunk):
    bodies = {f"k{n}": random.Random(n).randbytes(n) for n in (0, 1, 9, 10, 11, 99, 100, 101)}
    objects = spark.createDataFrame([(k, bytearray(b)) for k, b in bodies.items()], "key string, body binary")
    rows = drayage.slice_bodies(objects, chunk).orderBy("key", "part_number").collect()
    plan = drayage.plan_parts(objects.selectExpr("key", "octet_length(body) as size"), chunk)
    columns = ("key", "part_number", "input_offset", "output_offset", "part_size", "n_parts")
    assert [tuple(r[c] for c in columns) for r in rows] == \
        [tuple(r) for r in plan.select(*columns).orderBy("key", "part_number").collect()]
    for key, body in bodies.items():
        assert b"".join(bytes(r["body"]) for r in rows if r["key"] == key) == body


def test_paths_stay_below_the_root():
    assert below("/r", "a/b") == "/r/a/b" and below("/r", "a/b/") == "/r/a/b" and below("/r", "/a") == "/r/a"
    for bad in ("../x", "a/../../x", ".."):
        with pytest.raises(ValueError):
            below("/r", bad)
    assert local_path("s3://bucket/x") is None and local_path("file:/x/") == "/x"


def test_every_process_has_a_staging_folder_of_its_own(tmp_path, monkeypatch):
    """One folder that all tasks make and leave their files in made a job of 256,410 files seven times as slow."""
    root, pid = str(tmp_path), os.getpid()
    for number, process in enumerate((pid, pid + 1, pid)):
        monkeypatch.setattr(os, "getpid", lambda: process)
        with sources_files.new_file(root, f"d/{number}", "run") as out:
            out.keep = bool(out.write(b"x"))
            (folder,) = [at for at, _, names in os.walk(f"{root}/.uploads/run") if names]
            assert os.path.dirname(folder) == f"{root}/.uploads/run"
    assert len(os.listdir(f"{root}/.uploads/run")) == 2 and len(os.listdir(f"{root}/d")) == 3
    sources_files.end_run(root, "run")
    sources_files.drop_staging(root)
    assert sorted(os.listdir(root)) == ["d"]
