import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import drayage
from drayage.sources import fastq
from drayage.materialize import snapshot
from drayage.sources.fastq import LINES, _record_batches


def make(rng, n_pairs, single=False, longest=60):
    """Interleaved pairs with awkward qualities; returns records in order."""
    records = []
    for i in range(n_pairs):
        for mate in ("1", "2"):
            length = rng.randrange(1, longest)
            seq = "".join(rng.choice("ACGT") for _ in range(length))
            qual = "".join(rng.choice("@/+2IJ#") for _ in range(length))
            if rng.random() < 0.4:
                qual = "@" + qual[1:]
            name = f"@r{i}" + ("" if single else f"/{mate}") + rng.choice(["", " x/2 y"])
            records.append((name, seq, rng.choice(["+", "+" + name[1:]]), qual))
    return records


def text(records):
    return "".join("\n".join(r) + "\n" for r in records)


def expected_rows(records):
    rows, offset = [], 0
    for number, record in enumerate(records):
        length = sum(map(len, record)) + 4
        rows.append((number, offset, length, *record))
        offset += length
    return rows


@pytest.fixture(scope="module")
def reads(tmp_path_factory):
    root = tmp_path_factory.mktemp("reads")
    rng = random.Random(11)
    files = {"a.fastq": make(rng, 60), "b.fastq": make(rng, 3, longest=900), "c.fastq": make(rng, 20, single=True)}
    for name, records in files.items():
        (root / name).write_text(text(records))
    return str(root), files


@pytest.mark.parametrize("chunk", [1, 13, 100, 1021, 10**6])
def test_records_whatever_the_chunks(spark, reads, chunk):
    root, files = reads
    if chunk == 1:
        files = {"b.fastq": files["b.fastq"][:2]}
        objects = spark.createDataFrame([("b.fastq", len(text(files["b.fastq"])))], "key string, size bigint")
    else:
        objects = drayage.list_objects(spark, root)
    got = drayage.read_fastq_objects(objects, root, chunk)
    assert got.where("problem is not null").count() == (0 if chunk > 1 else 0)
    columns = ("rec_no", "start_offset", "byte_len", "header", "seq", "plus", "qual")
    by_file = {}
    for row in got.collect():
        by_file.setdefault(row["key"], []).append(tuple(row[c] for c in columns))
    assert {k: sorted(v) for k, v in by_file.items()} == {k: expected_rows(v) for k, v in files.items()}


def one_file(spark, tmp_path, content, chunk=16, **options):
    (tmp_path / "f").write_bytes(content)
    return drayage.read_fastq(spark, str(tmp_path), chunk_size=chunk, **options).orderBy("rec_no").collect()


@pytest.mark.parametrize("content,expected", [
    (b"@a/1\nAC\n+\n@I\n@a/2\nGT\n+\nII", [(0, None, 13), (1, None, 12)]),
    (b"@a\nAC\n+\nII\n@b\nAC\n+\n", [(0, None, 11), (1, "truncated", 8)]),
    (b"@a\nAC\n+\nII\n\n", [(0, None, 11), (1, "truncated", 1)]),
    (b"@a\nAC\n+\nII\nb\nAC\n+\nII\n@c\nAC\nx\nII\n", [(0, None, 11), (1, "header", 10), (2, "plus", 11)]),
    (b"@a\r\nAC\r\n+\r\nII\r\n", [(0, None, 15)]),
    (b"@", [(0, "truncated", 1)])])
@pytest.mark.parametrize("chunk", [1, 5, 100])
def test_odd_files(spark, tmp_path, content, expected, chunk):
    rows = one_file(spark, tmp_path, content, chunk)
    assert [(r["rec_no"], r["problem"], r["byte_len"]) for r in rows] == expected
    assert sum(r["byte_len"] for r in rows) == len(content)


@pytest.mark.parametrize("header,read_id,mate", [
    ("@r1/1", "r1", "1"), ("@r1/2 c", "r1", "2"), ("@r1", "r1", None), ("@r/3", "r/3", None), ("@a/b/2", "a/b", "2"),
    ("@r1 2:N:0:A", "r1", "c2"), ("@r1 x/2", "r1", None), ("@", None, None), ("@/1", None, "1"), ("x/1", None, None),
    ("@r\t1:Y", "r", "c1"), ("@r 1", "r", None), ("@r 3:", "r", None), ("@r/1 2:", "r", "1"), ("", None, None),
    ("@ 1:", None, None), ("@r/1\r", "r", "1"), ("@é/2", "é", "2")])
@pytest.mark.parametrize("comments", [False, True])
def test_read_ids(spark, tmp_path, header, read_id, mate, comments):
    expected = (read_id, mate[-1] if mate and (comments or mate[0] != "c") else None)
    row = drayage.with_read_ids(spark.createDataFrame([(header,)], "header string"), comments).first()
    assert (row["read_id"], row["mate"]) == expected
    batches = _record_batches("k", 0, 0, f"{header}\nA\n+\nI\n".encode(), LINES, comments)
    parsed = [row for batch in batches for row in batch.to_pylist()]
    assert [(r["read_id"], r["mate"], r["header"]) for r in parsed] == [(*expected, header)]


def test_lines_that_nobody_needs(spark, reads):
    root, files = reads
    row = drayage.read_fastq(spark, root, "a", lines=("header",)).where("rec_no = 0").first()
    assert row["header"] == files["a.fastq"][0][0] and row["seq"] is None and row["qual"] is None
    with pytest.raises(ValueError):
        drayage.read_fastq(spark, root, lines=("nothing",))


def boundaries_by_definition(records, chunk, size, nodes_of_parts):
    starts = {}
    for part, node in sorted(nodes_of_parts.items()):
        starts.setdefault(node, (part - 1) * chunk)
    rows = expected_rows(records)
    mates = [r[0].split()[0][-2:] for r in records]
    aligned = {node: max([row[1] for row, mate in zip(rows, mates) if row[1] < b and mate != "/2"], default=0) if b else 0
               for node, b in starts.items()}
    ordered = sorted(aligned)
    ends = [aligned[n] for n in ordered[1:]] + [size]
    return {(node, aligned[node], end) for node, end in zip(ordered, ends)}


@pytest.mark.parametrize("chunk,nodes", [(40, 7), (100, 1), (100, 31), (333, 1000), (64, 100)])
def test_boundaries_and_splits(spark, reads, tmp_path, chunk, nodes):
    root, files = reads
    objects = drayage.list_objects(spark, root)
    records = snapshot(drayage.read_fastq_objects(objects, root, 500), "records")
    assigned = drayage.grid_assign(drayage.build_plan(objects, chunk_size=chunk), nodes)
    parts = {}
    for row in assigned.collect():
        parts.setdefault(row["key"], {})[row["part_number"]] = row["node"]
    bounds = snapshot(drayage.fastq_boundaries(records, assigned, chunk), "bounds")
    got = {}
    for row in bounds.collect():
        got.setdefault(row["key"], set()).add((row["node"], row["start"], row["end"]))
    assert got == {key: boundaries_by_definition(files[key], chunk, len(text(files[key])), parts[key]) for key in files}
    assert sorted(map(tuple, drayage.locate_boundaries(objects, assigned, root, chunk).collect())) == \
        sorted(map(tuple, bounds.collect()))

    split = drayage.fastq_split(records, bounds).select("key", "rec_no", "start_offset", "read_id", "node").collect()
    assert len(split) == sum(map(len, files.values()))
    for row in split:
        assert row["node"] == max(n for n, start, _ in got[row["key"]] if start <= row["start_offset"])
    for key in ("a.fastq", "b.fastq"):
        pairs = {}
        for row in split:
            if row["key"] == key:
                pairs.setdefault(row["read_id"], set()).add(row["node"])
        assert all(len(found) == 1 for found in pairs.values())

    if chunk != 64:
        done = drayage.write_split(assigned, nodes, root, str(tmp_path), bounds, chunk, on_failure="fail")
        assert {r["status"] for r in done.objects.collect()} == {"done"}
        for key, records in files.items():
            slices = [(tmp_path / f"node={n}" / key).read_text() for n, s, e in sorted(got[key]) if e > s]
            assert "".join(slices) == text(records)
            assert all(s.startswith("@r") and s.count("\n") % 4 == 0 for s in slices)


def test_boundaries_need_the_chunk_size_of_the_plan(spark, reads):
    root, _ = reads
    objects = drayage.list_objects(spark, root)
    assigned = drayage.grid_assign(drayage.build_plan(objects, chunk_size=64), 3)
    with pytest.raises(Exception, match="chunk_size"):
        drayage.fastq_boundaries(drayage.read_fastq_objects(objects, root), assigned, 100).collect()


def test_split_over_several_spans(spark):
    bounds = spark.createDataFrame([("k", 1, 0, 3), ("k", 2, 3, 3), ("k", 4, 3, 47), ("k", 5, 47, 60)],
                                   "key string, node int, start bigint, end bigint")
    records = spark.createDataFrame([("k", s) for s in (0, 2, 3, 9, 10, 30, 46, 47, 59)] + [("other", 60)],
                                    "key string, start_offset bigint")
    got = {r["start_offset"]: r["node"] for r in drayage.fastq_split(records, bounds).collect()}
    assert got == {0: 1, 2: 1, 3: 4, 9: 4, 10: 4, 30: 4, 46: 4, 47: 5, 59: 5, 60: None}


def test_split_equals_search_in_uneven_ranges(spark):
    rng, ranges, wanted = random.Random(7), [], {}
    for key in ("a", "b", "c"):
        cuts = sorted(rng.choices(range(5000), k=12) + rng.choices(range(40), k=8))     # some ranges are empty, many are short
        bounds = [0, *cuts, 5000]
        ranges += [(key, node, low, high) for node, (low, high) in enumerate(zip(bounds, bounds[1:]), 1)]
        for at in range(0, 5000, 7):
            wanted[key, at] = [node for k, node, low, high in ranges if k == key and low <= at < high]
    records = spark.createDataFrame(list(wanted), "key string, start_offset bigint").withColumn("end", F.lit("kept"))
    bounds = spark.createDataFrame(ranges, "key string, node int, start bigint, end bigint")
    split = drayage.fastq_split(records, bounds)
    assert split.columns == ["key", "start_offset", "end", "node"]
    rows = split.collect()
    assert len(rows) == len(wanted) and {(r["key"], r["start_offset"]): [r["node"]] for r in rows} == wanted
    assert not [field for field in split.schema if field.dataType.typeName() == "array"]
    plan = split._jdf.queryExecution().optimizedPlan().toString()
    assert "array" not in plan.lower() and "collect_list" not in plan
    none = drayage.fastq_split(records, bounds.where("false")).collect()
    assert len(none) == len(wanted) and all(r["node"] is None for r in none)


def test_pairs(spark):
    records = spark.createDataFrame([("f", "a", "1", 0), ("f", "a", "2", 9), ("f", "b", "1", 20), ("f", "c", "2", 30),
                                     ("f", "d", None, 40), ("g", "b", "2", 0)],
                                    "key string, read_id string, mate string, start_offset bigint")
    got = {(r["key"], r["read_id"]): (r["r1"], r["r2"], r["status"]) for r in drayage.pair_mates(records).collect()}
    assert got == {("f", "a"): (0, 9, "paired"), ("f", "b"): (20, None, "orphan_1"), ("f", "c"): (None, 30, "orphan_2"),
                   ("f", "d"): (None, None, "unpaired"), ("g", "b"): (None, 0, "orphan_2")}


class Cut:
    """Text files in memory, at most ``longest`` bytes per response."""

    def __init__(self, bodies, longest):
        self.bodies, self.longest = bodies, longest

    def read(self, key, offset, length):
        yield self.bodies[key][offset:offset + min(length, self.longest)]


@pytest.mark.parametrize("longest", [120, 10_000])
def test_short_responses_and_many_blocks(spark, monkeypatch, longest):
    monkeypatch.setattr(fastq, "COUNT_BLOCK", 3)
    body = "".join(f"@r{i}\nACGT{i}\n+\nIIII{i}\n" for i in range(300)).encode()
    objects = spark.createDataFrame([("a", len(body))], "key string, size bigint")
    got = drayage.read_fastq_objects(objects, Cut({"a": body}, longest), 500).orderBy("rec_no").collect()
    assert [(r["rec_no"], r["seq"], r["problem"]) for r in got] == [(i, f"ACGT{i}", None) for i in range(300)]
    assert sum(r["byte_len"] for r in got) == len(body)


def test_records_too_long_to_hold(monkeypatch):
    monkeypatch.setattr(fastq, "MAX_OVERHANG", 5_000)
    body = b"@a\nAC\n+\nII\n@b\n" + b"A" * 20_000 + b"\n+\nI\n@c\nG\n+\nI\n"
    chunk = {"key": "k", "input_offset": 0, "part_size": 100, "lines_before": 0, "at_line_start": True}
    (rows,) = [[r for b in fastq._parser(Cut({"k": body}, 10**6), fastq.LINES, False)(
        [pa.RecordBatch.from_pylist([chunk])]) for r in b.to_pylist()]]
    assert [(r["rec_no"], r["start_offset"], r["byte_len"], r["problem"], r["seq"]) for r in rows] == [
        (0, 0, 11, None, "AC"), (1, 11, 20_008, "too_long", None)]
