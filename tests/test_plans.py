import random

import pytest
from pyspark.sql import Window, functions as F

import drayage
from drayage.plans import chunking, indexing

C = 1000


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).orderBy(*columns).collect()]


def brute_plan(sizes, chunk):
    """The flat list by its definition."""
    plan = []
    for key in sorted(sizes, key=lambda k: k.encode()):
        position, part = 0, 1
        while position < sizes[key] or part == 1:
            length = min(chunk, sizes[key] - position)
            plan.append((len(plan), key, part, position, length))
            position, part = position + length, part + 1
    return plan


EDGES = {"a": 0, "b": 1, "c": C, "d": C + 1, "e": 2 * C, "f": 7 * C + 3, "dir/": 0}


def test_parts_of_edge_sizes(objects):
    got = rows(drayage.plan_parts(objects(list(EDGES.items())), C), "key", "part_number", "input_offset", "part_size")
    assert got == sorted(p[1:] for p in brute_plan(EDGES, C))


def test_spread_parts_are_the_same(objects):
    some = objects([("giant", 70_000), ("b", 3)])
    columns = ("key", "part_number", "input_offset", "part_size", "n_parts")
    assert rows(drayage.plan_parts(some, 1, spread=3), *columns) == rows(drayage.plan_parts(some, 1), *columns)


def test_parts_with_base_offset(objects):
    parts = drayage.plan_parts(objects([("w", 2500)]), C, base_offset=10_000)
    assert rows(parts, "part_number", "input_offset", "output_offset", "part_size") == [
        (1, 10_000, 10_000, 1000), (2, 11_000, 11_000, 1000), (3, 12_000, 12_000, 500)]


@pytest.mark.parametrize("direction,size,expected", [
    ("download", C, False), ("download", C + 1, True), ("download", 0, False),
    ("upload", 5_242_879, False), ("upload", 5_242_880, True), ("upload", 6_000_000, True)])
def test_classification(objects, direction, size, expected):
    chunk = C if direction == "download" else None
    assert drayage.classify_transfer(objects([("k", size)]), direction, chunk).first()["is_multipart"] is expected


def test_large_upload_may_have_one_part(objects):
    plan = drayage.build_plan(objects([("k", 6_000_000)]), "upload")
    assert rows(plan, "n_parts", "is_multipart") == [(1, True)]


@pytest.mark.parametrize("requested,direction,expected", [
    (None, "upload", 26_214_400), ("x", "upload", 26_214_400), (5_242_879, "upload", 26_214_400),
    ("5242880", "upload", 5_242_880), (100, "download", 100), ("x", "download", 26_214_400)])
def test_chunk_size_rule(requested, direction, expected):
    assert drayage.effective_chunk_size(requested, direction) == expected


def test_bad_parameters(objects):
    some = objects([("k", 1)])
    with pytest.raises(ValueError):
        drayage.effective_chunk_size(0)
    with pytest.raises(ValueError):
        drayage.build_plan(some, "sideways")
    plan = drayage.build_plan(some)
    for nodes, node in ((0, 1), (3, 0), (3, 4)):
        with pytest.raises(ValueError):
            drayage.grid_slice(plan, nodes, node)
    with pytest.raises(ValueError):
        drayage.plan_transfer(some, feature="zip", n_nodes=2)
    with pytest.raises(ValueError):
        drayage.plan_transfer(some, feature="split")


def test_objects_that_cannot_be_planned_do_not_stop_the_others(objects):
    some = objects([("large", 5_242_880 * 10_000 + 1), ("k", 1), ("none", None), ("vast", 2**62)])
    plan = drayage.build_plan(some, "upload", 5_242_880)
    assert {r["key"]: r["n"] for r in plan.groupBy("key").agg(F.count("*").alias("n")).collect()} == {
        "large": 10_001, "k": 1}
    errors = drayage.plan_errors(some, "upload", 5_242_880)
    assert {r["key"]: r["plan_error"] for r in errors.collect()} == {
        "large": "above_upload_limit", "none": "missing_size", "vast": "too_many_parts"}
    parts = drayage.plan_parts(objects([("k", 5), ("none", None), ("empty", 0)]), 2)
    assert sorted((r["key"], r["part_size"]) for r in parts.collect()) == [("empty", 0), ("k", 1), ("k", 2), ("k", 2)]


def test_plan_over_many_key_ranges(objects, monkeypatch):
    monkeypatch.setattr(indexing, "OBJECTS_PER_BUCKET", 20)
    random.seed(7)
    sizes = {f"{random.choice('äzZ/a-')}{random.random()}": random.randrange(0, 5 * C) for _ in range(3000)}
    plan = drayage.build_plan(objects(list(sizes.items())), chunk_size=C)
    assert rows(plan, "chunk_idx", "key", "part_number", "input_offset", "part_size") == brute_plan(sizes, C)
    assert plan.select("n_chunks").distinct().collect() == [(len(brute_plan(sizes, C)),)]


@pytest.mark.parametrize("count", [0, 1, 5])
def test_bucket_of_few_and_no_bounds(spark, count):
    bounds = [f"k{n:02}" for n in range(count)]
    keys = ["", "k00", "k005", "k01", "k04", "z"]
    df = spark.createDataFrame([(k,) for k in keys], "key string").withColumn("b", indexing._bucket(F.col("key"), bounds))
    assert {r["key"]: r["b"] for r in df.collect()} == {k: sum(b <= k for b in bounds) for k in keys}


def test_repeated_keys_collapse(spark, objects):
    plan = drayage.build_plan(objects([("a", 5), ("a", 9), ("b", 1)] + [("hot", 3)] * 500), chunk_size=C)
    assert rows(plan, "chunk_idx", "key", "object_size") == [(0, "a", 9), (1, "b", 1), (2, "hot", 3)]
    timed = spark.createDataFrame([("a", 9, 1), ("a", 5, 2)], "key string, size bigint, mtime int")
    assert rows(drayage.unique_objects(timed), "key", "size") == [("a", 5)]


def test_empty_inventory(objects):
    plan = drayage.build_plan(objects([]))
    assert drayage.grid_assign(plan, 3).count() == 0
    assert drayage.grid_slice(plan, 3, 1).count() == 0
    assert [r["n_chunks"] for r in drayage.node_summary(drayage.grid_assign(plan, 3), 3).collect()] == [0, 0, 0]


def test_giant_object_is_exploded_in_blocks(objects, monkeypatch):
    monkeypatch.setattr(chunking, "PART_BLOCK", 8)
    monkeypatch.setattr(indexing, "PART_BLOCK", 8)
    sizes = {"giant": 1003, "small": 3, "x": 80}
    plan = drayage.build_plan(objects(list(sizes.items())), chunk_size=10)
    assert rows(plan, "chunk_idx", "key", "part_number", "input_offset", "part_size") == brute_plan(sizes, 10)


@pytest.mark.parametrize("n,nodes", [(0, 3), (1, 5), (7, 25), (21, 19), (10, 5), (10, 3), (199, 59)])
def test_slices_are_exact_and_complete(objects, n, nodes):
    plan = drayage.build_plan(objects([(f"k{i:03}", 1) for i in range(n)]))
    assigned = dict(drayage.grid_assign(plan, nodes).select("chunk_idx", "node").collect())
    expected = {i: k for k in range(1, nodes + 1)
                for i in range(-(-n * (k - 1) // nodes), -(-n * k // nodes))}
    assert assigned == expected
    sizes = [list(expected.values()).count(k) for k in range(1, nodes + 1)]
    assert max(sizes) - min(sizes) <= 1
    for node in {1, nodes // 2 + 1, nodes}:
        got = {r["chunk_idx"] for r in drayage.grid_slice(plan, nodes, node).collect()}
        assert got == {i for i, k in expected.items() if k == node}


def test_assignment_of_a_plan_without_length(objects):
    plan = drayage.build_plan(objects([(f"k{i}", 1) for i in range(10)]))
    assert rows(drayage.grid_assign(plan.drop("n_chunks"), 3), "chunk_idx", "node") == \
        rows(drayage.grid_assign(plan, 3), "chunk_idx", "node")


@pytest.mark.parametrize("nodes", [1, 2, 7, 40, 400])
def test_split_offsets_equal_windows(objects, nodes):
    random.seed(nodes)
    sizes = [(f"k{i}", random.choice([0, 1, C, C + 1, random.randrange(30 * C)])) for i in range(15)]
    assigned = drayage.grid_assign(drayage.build_plan(objects(sizes), chunk_size=C), nodes)
    group = Window.partitionBy("key", "node")
    expected = (assigned.withColumn("output_offset", F.col("input_offset") - F.min("input_offset").over(group))
                .withColumn("node_size", F.sum("part_size").over(group))
                .withColumn("node_parts", F.count("*").over(group).cast("int")))
    columns = ("key", "node", "part_number", "output_offset", "node_size", "node_parts")
    assert rows(drayage.split_rebase(assigned, nodes), *columns) == rows(expected, *columns)


def test_split_of_a_window_of_a_larger_object(objects):
    parts = drayage.grid_assign(drayage.build_plan(objects([("k", 5 * C)]), chunk_size=C), 2)
    moved = parts.withColumn("input_offset", F.col("input_offset") + 777)
    columns = ("node", "part_number", "output_offset", "node_size")
    assert rows(drayage.split_rebase(moved, 2, base_offset=777), *columns) == \
        rows(drayage.split_rebase(parts, 2), *columns)


def test_facade(objects):
    some = objects([("p/a", 2500), ("p/b", 10)])
    targets = drayage.map_download_targets(some, "p/", "bucket", "out")
    plan = drayage.plan_transfer(some, chunk_size=C, n_nodes=2, feature="split", targets=targets,
                                 metadata=[("k", "1"), ("k", "2")])
    assert rows(plan, "key", "part_number", "node", "output_offset", "target") == [
        ("p/a", 1, 1, 0, "out/a"), ("p/a", 2, 1, 1000, "out/a"), ("p/a", 3, 2, 0, "out/a"), ("p/b", 1, 2, 0, "out/b")]
    assert plan.first()["metadata"] == {"k": "2"}
