import hashlib
import random

import pytest

import drayage
from drayage.operators import accounting


def simulate(log, size):
    """The nested loops of a transfer, step by step: 6 tries of up to 10 responses."""
    log, place = list(log), 0
    result = {"tries": 0, "responses": 0, "fetched": 0, "wasted": 0, "in_place": 0, "status": "pending"}
    for attempt in range(6):
        if place == len(log):
            return result
        result["tries"] += 1
        got = 0
        for response in range(10):
            if place == len(log):
                result["fetched"] += got
                result["in_place"] = got
                return result
            n_bytes, failed = log[place]
            place += 1
            result["responses"] += 1
            if failed:
                break
            got = min(got + n_bytes, size)
            if got == size:
                result.update(status="done", in_place=got)
                result["fetched"] += got
                return result
        result["fetched"] += got
        result["wasted"] += got
    result["status"] = "failed"
    return result


def test_accounting_equals_a_simulation(spark):
    random.seed(3)
    size, logs = 100, {}
    for chunk in range(400):
        rate, step = random.choice([0.0, 0.1, 0.5]), random.choice([3, 15, 60, 200])
        logs[chunk] = [(random.randrange(0, step), random.random() < rate) for _ in range(random.randrange(1, 90))]
    rows = [(c, t, n, f) for c, log in logs.items() for t, (n, f) in enumerate(log)]
    random.shuffle(rows)
    attempts = spark.createDataFrame(rows, "chunk_id int, attempt_ts int, bytes_read bigint, failed boolean")
    got = {r["chunk_id"]: r.asDict() for r in drayage.attempt_accounting(attempts, size).collect()}
    assert set(r["status"] for r in got.values()) == {"done", "failed", "pending"}
    for chunk, log in logs.items():
        want, row = simulate(log, size), got[chunk]
        assert (row["status"], row["tries"], row["responses"], row["bytes_fetched"], row["bytes_wasted"],
                row["bytes_in_place"]) == (want["status"], want["tries"], want["responses"], want["fetched"],
                                           want["wasted"], want["in_place"]), (chunk, log)


def test_remaining_ranges_take_sizes_from_the_plan(spark):
    plan = spark.createDataFrame([(1, 0, 100), (2, 100, 100), (3, 200, 50), (4, 250, 10)],
                                 "chunk_id int, input_offset bigint, part_size bigint")
    attempts = spark.createDataFrame([(1, 1, 100, False), (2, 1, 30, False), (2, 2, 20, False), (3, 1, 40, True),
                                      (9, 1, 5, False)],
                                     "chunk_id int, attempt_ts int, bytes_read bigint, failed boolean")
    got = {tuple(r) for r in drayage.remaining_ranges(plan, attempts).select(
        "chunk_id", "remaining_offset", "remaining_size").collect()}
    assert got == {(2, 150, 50), (3, 200, 50), (4, 250, 10)}


@pytest.mark.parametrize("n,text", [(0, "0B"), (1000, "1000B"), (1001, "1.00KB"), (10**6, "1000.00KB"),
                                    (10**6 + 1, "1.00MB"), (10**9, "1000.00MB"), (1_125_000_000, "1.12GB")])
def test_byte_texts(objects, n, text):
    plan = drayage.build_plan(objects([("k", n)]), chunk_size=2**40)
    assert drayage.transfer_summary(plan).first()["total_text"] == text


def test_summary_of_nothing(objects):
    row = drayage.transfer_summary(drayage.build_plan(objects([]))).first()
    assert (row["total_bytes"], row["n_objects"], row["total_text"]) == (0, 0, "0B")


def test_speed_below_a_second_is_unknown(spark):
    done = spark.sql("select timestamp'2024-01-01 00:00:00' + make_dt_interval(0,0,0,n) ts, g, 3000L bytes "
                     "from values ('a', 0.0), ('a', 0.9), ('b', 0.0), ('b', 2.9) t(g, n)")
    got = {r["g"]: (r["seconds"], r["bytes_per_second"], r["speed_text"]) for r in drayage.throughput(done, "g").collect()}
    assert got == {"a": (0, None, "unknown"), "b": (2, 3000, "3.00KB/s")}


def test_time_runs_from_the_first_start(spark):
    done = spark.sql("select timestamp'2024-01-01 00:00:10' ts, timestamp'2024-01-01 00:00:00' started, 500L bytes")
    assert drayage.throughput(done).first()["bytes_per_second"] == 50


def test_manifest(spark):
    parts = spark.createDataFrame([("a", 2, 2, "t2"), ("a", 1, 2, "t1"), ("a", 1, 2, "t1"), ("b", 1, 2, "x"),
                                   ("c", 1, 2, "y"), ("c", 2, 2, None)],
                                  "key string, part_number int, n_parts int, tag string")
    got = {r["key"]: (r["status"], r["n_tagged"], [m["tag"] for m in r["manifest"]])
           for r in drayage.complete_manifest(parts).collect()}
    assert got == {"a": ("complete", 2, ["t1", "t2"]), "b": ("incomplete", 1, ["x"]), "c": ("incomplete", 1, ["y"])}
    long = spark.createDataFrame([("a", 1, 10_001, "t")], "key string, part_number int, n_parts int, tag string")
    row = drayage.complete_manifest(long).first()
    assert (row["status"], row["n_tagged"], row["n_parts"], row["manifest"]) == ("incomplete", 1, 10_001, None)
    assert [tuple(r) for r in drayage.manifest_parts(long).collect()] == [("a", 1, 10_001, "t")]


def test_reassembly_in_any_order(spark):
    bodies = {f"k{i}": bytes(random.Random(i).randbytes(i * 37)) for i in range(12)}
    objects = spark.createDataFrame([(k, bytearray(b)) for k, b in bodies.items()], "key string, body binary")
    parts = drayage.slice_bodies(objects, 10).orderBy("body")
    got = {r["key"]: bytes(r["body"]) for r in drayage.reassemble(parts).collect()}
    assert got == bodies


def test_reassembly_above_a_cell(spark, monkeypatch):
    monkeypatch.setattr(accounting, "MAX_REASSEMBLED_BYTES", 100)
    bodies = {"a": bytes(range(256)), "b": b"", "c": b"x" * 100}
    objects = spark.createDataFrame([(k, bytearray(b)) for k, b in bodies.items()], "key string, body binary")
    parts = drayage.slice_bodies(objects, 10)
    got = {r["key"]: (r["size"], r["body"]) for r in drayage.reassemble(parts).collect()}
    assert got == {"a": (256, None), "b": (0, b""), "c": (100, b"x" * 100)}
    blocks = drayage.reassemble_blocks(parts, 40).orderBy("key", "block").collect()
    assert {k: b"".join(r["body"] for r in blocks if r["key"] == k) for k in bodies} == bodies
    assert [r["size"] for r in blocks if r["key"] == "a"] == [40] * 6 + [16]


def test_verification(objects):
    got = {r["key"]: r["status"] for r in drayage.verify_transfer(
        objects([("a", 1), ("b", 2), ("c", 3)]), objects([("a", 1), ("b", 1), ("d", 4)])).collect()}
    assert got == {"a": "ok", "b": "interrupted", "c": "missing", "d": "extra"}


def test_nodes_without_chunks_are_reported(objects):
    plan = drayage.grid_assign(drayage.build_plan(objects([("a", 10), ("b", 20)])), 4)
    got = {r["node"]: (r["n_chunks"], r["n_bytes"], r["estimated_bytes"], r["deviation"])
           for r in drayage.node_summary(plan, 4).collect()}
    assert got == {1: (1, 10, 7, 3), 2: (0, 0, 7, -7), 3: (1, 20, 7, 13), 4: (0, 0, 7, -7)}


def tree(leaves, fan_in):
    nodes = [hashlib.md5(body).hexdigest() for body in leaves]
    while len(nodes) > 1:
        nodes = [hashlib.md5("".join(nodes[i:i + fan_in]).encode()).hexdigest() for i in range(0, len(nodes), fan_in)]
    return nodes[0]


@pytest.mark.parametrize("fan_in", [2, 3, 10])
def test_digest_trees(spark, fan_in):
    rng = random.Random(fan_in)
    bodies = {f"k{n}": [rng.randbytes(rng.randint(0, 9)) for _ in range(n)] for n in (1, 2, 3, 4, 8, 9, 10, 27, 28, 100)}
    rows = [(key, i, len(leaves), sum(map(len, leaves)), body) for key, leaves in bodies.items() for i, body in enumerate(leaves, 1)]
    rows += [row for row in rows if row[1] == 2]     # parts that were sent twice
    rows += [("lacks the first", 2, 2, 5, b"x"), ("lacks the middle", 1, 30, 5, b"x"), ("lacks the middle", 30, 30, 5, b"x"),
             ("empty", 1, 1, 0, None)]
    parts = spark.createDataFrame(rows, "key string, part_number int, n_parts int, object_size bigint, body binary")
    got = {r["key"]: r for r in drayage.object_digests(parts, fan_in).collect()}
    assert {key: got[key]["tree_digest"] for key in bodies} == {key: tree(leaves, fan_in) for key, leaves in bodies.items()}
    assert all((got[key]["n_parts"], got[key]["status"]) == (len(leaves), "complete") for key, leaves in bodies.items())
    assert got["empty"]["tree_digest"] == hashlib.md5(b"").hexdigest() and len(got) == len(bodies) + 3
    assert all((got[key]["status"], got[key]["tree_digest"]) == ("incomplete", None) for key in ("lacks the first", "lacks the middle"))


def test_digest_trees_of_nothing(spark):
    parts = spark.createDataFrame([], "key string, part_number int, n_parts int, object_size bigint, body binary")
    assert drayage.object_digests(parts).collect() == []
    with pytest.raises(ValueError):
        drayage.object_digests(parts, 1)


def test_digests_and_blocks_on_both_sides_of_the_bound(spark, monkeypatch):
    objects = spark.createDataFrame([("small", b"abc" * 10), ("large", b"xyz" * 500)], "key string, body binary")
    parts = drayage.slice_bodies(drayage.objects_from_table(objects, "key", "body"), 64)
    before = {r["key"]: r["tree_digest"] for r in drayage.object_digests(parts, 4).collect()}
    monkeypatch.setattr(accounting, "MAX_REASSEMBLED_BYTES", 100)
    assert {r["key"]: r["tree_digest"] for r in drayage.object_digests(parts, 4).collect()} == before
    assert {r["key"]: r["body_md5"] is None for r in drayage.reassemble(parts).collect()} == {"small": False, "large": True}
    # Blocks of one part are the leaves of the tree.
    blocks = drayage.reassemble_blocks(parts, 64).collect()
    for key in before:
        leaves = [bytes(r["body"]) for r in sorted(blocks, key=lambda r: r["block"]) if r["key"] == key]
        assert tree(leaves, 4) == before[key]
