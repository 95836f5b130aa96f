"""Hard negatives and near-duplicate vectors against brute force."""

import math

import numpy as np
import pytest

from drayage.llm import negatives, quantised

SCHEMA = "vec_id long, embedding array<double>, label int, score double, n int"


def table(spark, rows):
    return spark.createDataFrame([(*r, 0.5, 1) for r in rows], SCHEMA)


def clustered(n, dims, labels, seed, spread=0.05):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(0, 1, (6, dims))
    rows = []
    for i in range(n):
        v = centres[i % 6] + rnd.normal(0, spread, dims) if i % 3 else rnd.normal(0, 1, dims) * rnd.choice([0.2, 1, 3])
        rows.append((i, [float(x) for x in v], int(rnd.integers(labels))))
    return rows


ODD = [(9001, None, 1), (9002, [float("nan")] * 8, 1), (9003, [None] + [1.0] * 7, 1), (9004, [0.0] * 8, 1), (9005, [1.0] * 8, None),
       (9006, [], 1), (9007, [1.0] * 3, 1), (9008, [2.0] * 3, 1), (9009, [float("inf")] * 8, 1), (9010, [1e200] * 8, 1), (9011, [1.0] * 8, 1)]


def brute_links(rows, threshold):
    usable = [v is not None and k is not None and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v, k in rows]
    units = [np.array(v) / max(map(abs, v)) if ok else None for ok, (_, v, _) in zip(usable, rows)]
    units = [None if u is None else u / np.sqrt(u @ u) for u in units]
    n, parents, counts = len(rows), list(range(len(rows))), [0] * len(rows)

    def root(x):
        return x if parents[x] == x else root(parents[x])
    for i in range(n):
        for j in range(n):
            if i != j and usable[i] and usable[j] and rows[i][2] == rows[j][2] and len(units[i]) == len(units[j]) and units[i] @ units[j] >= threshold:
                counts[i] += 1
                parents[root(max(i, j))] = root(min(i, j))
    least = {}
    for i in range(n):
        if rows[i][0] is not None:
            least[root(i)] = min(least.get(root(i), 1 << 62), rows[i][0])
    return sorted(((rows[i][0], counts[i], least.get(root(i)), rows[i][0] == least.get(root(i))) for i in range(n)), key=str)


@pytest.mark.parametrize("list_rows,block", [(4096, 4096), (12, 5)])
def test_near_vectors(spark, list_rows, block):
    rows = clustered(240, 8, 3, 1) + ODD
    rows += [(10_000, rows[5][1], rows[5][2]), (10_001, [3 * x for x in rows[5][1]], rows[5][2]), (5, rows[5][1], rows[5][2]),
             (None, rows[7][1], rows[7][2]), (None, [5.0, -1.0, 0.0], 2)]
    got = quantised.near_vectors(table(spark, rows), list_rows=list_rows, block=block)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_links(rows, 0.98)


def test_probes_and_codes_lose_nothing():
    rnd = np.random.default_rng(3)
    points = quantised.unit(rnd.normal(0, 1, (400, 16)))
    near = quantised.unit(points + rnd.normal(0, 0.045, points.shape))
    model = quantised.Quantiser(points[:200], 12)
    radius = np.sqrt(2 - 2 * 0.98)
    own, other = model.lists(points), model.lists(near)
    for i in np.flatnonzero((points * near).sum(1) >= 0.98):
        assert model.probes(points[i:i + 1], own[i], radius)[0, other[i]]
        codes, errors = model.encode(near[i:i + 1], other[i])
        assert model.table_distances(points[i:i + 1], other[i], codes)[0, 0] <= (radius + errors[0] + quantised.SLACK) ** 2
    everything = model.table_distances(points[:50], 0, model.encode(near[:50], 0)[0])
    assert everything == pytest.approx(quantised.squares(points[:50], np.array([
        model.coarse[0] + np.concatenate([b[c] for b, c in zip(model.codebooks, code)]) for code in model.encode(near[:50], 0)[0]])), abs=1e-9)


def brute_negatives(rows, every, positives=5, wanted=3):
    usable = [(i, [math.floor(256 * x) for x in v], k) for i, v, k in rows
              if i is not None and k is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    anchors, out = {}, []
    for i, v, k in ((i, v, k) for i, v, k in rows if (i, k) != (None, None)):
        if i is not None and i % every == 0 and k is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            anchors[i] = max(anchors.get(i, (-1, [])), (k, v))
    for own, (label, v) in anchors.items():
        q = [math.floor(256 * x) for x in v]
        scored = sorted(((-sum(a * b for a, b in zip(q, u)), i, k) for i, u, k in usable if i != own and len(u) == len(q)))
        for s, i, _ in [x for x in scored if x[2] == label][:positives]:
            fit = [(t, j) for t, j, k in scored if k != label and -50 * s <= -100 * t <= -95 * s][:wanted]
            out += [(own, i, rank, j, -s, -t) for rank, (t, j) in enumerate(fit, 1)]
    return sorted(out)


@pytest.mark.parametrize("block,anchors,cell", [(4096, 512, 8), (7, 3, 2)])
def test_hard_negatives(spark, monkeypatch, block, anchors, cell):
    monkeypatch.setattr(negatives, "BLOCK", block)
    monkeypatch.setattr(negatives, "ANCHORS", anchors)
    monkeypatch.setattr(negatives, "CELL", cell)
    rows = clustered(300, 8, 3, 2, 0.3) + [r for r in ODD if r[0] != 9010]
    rows += [(400, rows[20][1], 1), (401, rows[20][1], 1), (402, rows[20][1], 2), (30, rows[31][1], 0), (60, [9.0] * 8, 2),
             (None, [1.0] * 8, 1), (500, [0.0] * 8, 1), (510, [2.0, 1.0, 0.5], 0), (511, [2.0, 1.0, 0.4], 0), (512, [1.5, 0.5, 0.5], 2)]
    df = table(spark, rows)
    got = negatives.hard_negatives(df, df.where("vec_id % 10 = 0"))
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == brute_negatives(rows, 10)


def test_scores_beyond_exact_doubles():
    vectors = np.array([[2.0 ** 30, 1.0], [2.0 ** 30, 2.0], [-2.0 ** 30, 5.0], [2.0 ** 40, 2.0 ** 40]])
    bucket = negatives.Bucket(np.arange(4), vectors)
    assert bucket.scores(np.array([2.0 ** 30, 1.0])).tolist() == [2 ** 60 + 1, 2 ** 60 + 2, -2 ** 60 + 5, (1 << 63) - 1]
    assert negatives.best_positives([bucket], np.array([2.0 ** 30, 1.0]), 9, 2)[1].tolist() == [3, 1]


def test_ranges_hold_what_they_promise():
    rnd = np.random.default_rng(5)
    a, b = (quantised.unit(rnd.normal(0, 1, (3000, 4))) for _ in range(2))
    cosines = (a * b).sum(1)
    for cosine in (-0.5, 0.0, 0.3, 0.9, 0.999):
        for f in range(4):
            for i in np.flatnonzero(cosines >= cosine)[:200]:
                low, high = negatives.feasible(a[i, f], cosine)
                assert low <= b[i, f] <= high
    bucket = negatives.Bucket(np.arange(3000), b)
    pruned = [len(bucket.candidates(a[i], 0.95)) for i in range(50)]
    assert max(pruned) < 1500
    for i in range(50):
        assert set(np.flatnonzero(b @ a[i] >= 0.95)) <= set(bucket.candidates(a[i], 0.95).tolist())


def test_empty_vector_tables(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert quantised.near_vectors(none).count() == 0 and negatives.hard_negatives(none, none).count() == 0
    one = spark.createDataFrame([(50, [1.0, 2.0], 1), (51, None, 1)], none.schema)
    assert negatives.hard_negatives(one, one).count() == 0
    assert sorted(map(tuple, quantised.near_vectors(one).collect())) == [(50, 0, 50, True), (51, 0, 51, True)]
