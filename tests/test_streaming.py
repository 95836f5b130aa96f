import os
import time

import pytest

import drayage
from drayage.operators.transfer import TransferFailed


def test_open_ticks_wait_for_the_watermark(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.sql("select timestamp'2024-01-01 00:00:00' + make_dt_interval(0,0,m) ts, 10L bytes "
              "from values (0), (1), (7), (12), (26) t(m)").coalesce(1).write.parquet(source)
    stream = spark.readStream.schema("ts timestamp, bytes bigint").parquet(source)
    drayage.run_progress_stream(stream, "5 minutes", str(tmp_path / "out"), str(tmp_path / "state"),
                                watermark="10 minutes").awaitTermination()
    got = [(r["tick_start"].minute, r["n_bytes"], r["n_chunks"])
           for r in spark.read.parquet(str(tmp_path / "out")).orderBy("tick_start").collect()]
    assert got == [(0, 20, 2), (5, 10, 1), (10, 10, 1)]


def test_ticks_with_known_totals(spark):
    done = spark.sql("select timestamp'2024-01-01 00:00:00' + make_dt_interval(0,0,0,s) ts, 5L bytes "
                     "from values (1), (16), (17) t(s)")
    got = [(r["written_text"], r["finished_text"]) for r in
           drayage.progress_ticks(done, "15 seconds", 100, 9).orderBy("tick_start").collect()]
    assert got == [("100 5", "1 / 9"), ("100 15", "3 / 9")]


def test_each_object_is_copied_once(spark, tmp_path):
    source, dest, state = (str(tmp_path / n) for n in ("src", "dst", "state"))
    os.makedirs(source + "/sub dir")

    def put(key, body):
        with open(os.path.join(source, key), "wb") as out:
            out.write(body)

    def run():
        return sorted((r["key"], r["bytes"]) for r in drayage.incremental_copy(spark, source, dest, state).collect())

    put("a", b"1")
    put("sub dir/ü%20+", b"22")
    put("empty", b"")
    first = run()
    assert first == [("a", 1), ("empty", 0), ("sub dir/ü%20+", 2)]
    put("b", b"333")
    put("empty2", b"")
    second = run()
    assert second == sorted(first + [("b", 3), ("empty2", 0)])
    assert run() == second
    assert sorted(os.listdir(dest)) == ["a", "b", "empty", "empty2", "sub dir"]


def test_new_objects_by_listing(spark, tmp_path):
    source, dest, state = (str(tmp_path / n) for n in ("src", "dst", "state"))
    os.makedirs(source + "/d")
    for name, count in (("d/a", 1), ("d/b", 2), ("e", 3)):
        with open(f"{source}/{name}", "w") as out:
            out.write("x")
        assert drayage.copy_new(spark, source, dest, state).count() == count
    assert drayage.copy_new(spark, source, dest, state).count() == 3
    os.unlink(source + "/e")
    assert drayage.copy_new(spark, source, dest, state).count() == 3 and os.path.exists(dest + "/e")


def test_only_empty_objects(spark, tmp_path):
    source, dest, state = (str(tmp_path / n) for n in ("src", "dst", "state"))
    os.makedirs(source)
    open(source + "/e", "w").close()
    assert drayage.incremental_copy(spark, source, dest, state).count() == 1
    assert drayage.incremental_copy(spark, source, dest, state).count() == 1


def test_old_hidden_and_changed_objects(spark, tmp_path):
    source, dest, state = (str(tmp_path / n) for n in ("src", "dst", "state"))

    def put(key, body=b"x", age=0):
        os.makedirs(os.path.dirname(os.path.join(source, key)), exist_ok=True)
        with open(os.path.join(source, key), "wb") as out:
            out.write(body)
        os.utime(os.path.join(source, key), (time.time() - age,) * 2)

    put("n.txt")
    assert drayage.incremental_copy(spark, source, dest, state).count() == 1
    for key, age in (("old", 30 * 86400), ("_h/b.txt", 1), (".d/c.txt", 1)):
        put(key, b"x", age)
    put("n.txt", b"yy", -5)
    assert {r["key"] for r in drayage.incremental_copy(spark, source, dest, state).collect()} == {
        "n.txt", "old", "_h/b.txt", ".d/c.txt"}
    put("n.txt", b"yy", 60)
    again = drayage.incremental_copy(spark, source, dest, state, changed=True)
    assert sorted(r["bytes"] for r in again.where("key = 'n.txt'").collect()) == [1, 2]
    with open(dest + "/n.txt", "rb") as copied:
        assert copied.read() == b"yy"
    assert drayage.incremental_copy(spark, source, dest, state, changed=True).count() == 5


def test_a_failure_leaves_the_other_copies_in_the_ledger(spark, tmp_path):
    source, dest, state = (str(tmp_path / n) for n in ("src", "dst", "state"))
    os.makedirs(source + "/blocked")
    os.makedirs(dest)
    for key in ("blocked/a.txt", "c.txt"):
        with open(f"{source}/{key}", "w") as out:
            out.write("x")
    open(dest + "/blocked", "w").close()
    for _ in range(2):
        with pytest.raises(TransferFailed):
            drayage.incremental_copy(spark, source, dest, state)
        assert [r["key"] for r in drayage.copy_new(spark, source, dest, state, only="false").collect()] == ["c.txt"]
        copied = os.stat(dest + "/c.txt")
        os.utime(dest + "/c.txt", (1, 1))       # a second copy would set another time
    assert copied.st_mtime == 1
    os.unlink(dest + "/blocked")
    assert {r["key"] for r in drayage.incremental_copy(spark, source, dest, state).collect()} == {"blocked/a.txt", "c.txt"}
    assert os.stat(dest + "/c.txt").st_mtime == 1
