"""Near-duplicate vectors by product quantisation: coarse inverted lists, residual codes, table lookups, exact rerank.

A vector goes to the list of its nearest coarse centroid; what is left of it is coded by subspace. Two vectors of one label at a
cosine of the threshold or more are at most ``radius`` apart when they have length one. That bounds where the other one can be,
so the index is searched without loss: a list is probed unless it lies beyond the plane halfway between its centroid and
the own one by more than the radius, and a code is a candidate if its table distance is no more than the radius and the
coding error of its vector, which is kept. Candidates are compared in double precision. The sample that the centroids are
fitted to bears on the work, not on the links.

Equal vectors of a label are one class with a count. Classes of a list are packed in blocks; a pair of blocks is a task's
work, which returns sums per class and the links of a spanning forest, never the pairs.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..materialize import snapshot
from .common import table
from .components import components
from .vectors import by_length, from_bytes, grouped_blocks, is_whole, stacked, to_bytes

THRESHOLD = 0.98
SAMPLE, ROUNDS = 8192, 8                    # vectors that centroids are fitted to, per length; rounds of fitting
LISTS, LIST_ROWS, MAX_LISTS = 1, 2048, 1024     # at least, rows of a label per list, at most
SUBSPACES, CODES = 8, 256
BLOCK, QUERIES, PAIRS = 4096, 256, 16_384   # rows of a block; of them looked up at once; candidates compared at once
DENSE = 0.1                                 # share of candidates from which all are compared at once
SLACK = 1e-6                                # more than what rounding can do to a distance
_BLOCKS = "label bigint, dims int, list int, ids binary, weights binary, kind string, data binary, codes binary, errors binary, needs array<int>"


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows divided by their length; components are scaled first, so that squares neither overflow nor vanish."""
    scaled = vectors / np.abs(vectors).max(1, initial=0, keepdims=True)
    return scaled / np.sqrt((scaled ** 2).sum(1, keepdims=True))


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of two matrices."""
    return np.maximum((a ** 2).sum(1)[:, None] - 2 * (a @ b.T) + (b ** 2).sum(1), 0)


def centroids(points: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Lloyd's rounds from points chosen at random; centroids without points stay where they are."""
    n = max(1, min(n, len(points)))
    found = points[np.random.default_rng(seed).permutation(len(points))[:n]].copy()
    for _ in range(ROUNDS):
        nearest = squares(points, found).argmin(1)
        order = np.argsort(nearest, kind="stable")
        held, first = np.unique(nearest[order], return_index=True)
        found[held] = np.add.reduceat(points[order], first, axis=0) / np.diff(np.append(first, len(order)))[:, None]
    return found


class Quantiser:
    """Coarse centroids and, per subspace of the residuals, the centroids that codes stand for."""

    def __init__(self, sample: np.ndarray, n_lists: int):
        self.coarse = centroids(sample, n_lists)
        left = sample - self.coarse[squares(sample, self.coarse).argmin(1)]
        self.parts = [p for p in np.array_split(np.arange(sample.shape[1]), SUBSPACES) if len(p)]
        self.codebooks = [centroids(left[:, p], CODES, seed=i + 1) for i, p in enumerate(self.parts)]

    def lists(self, vectors: np.ndarray) -> np.ndarray:
        return squares(vectors, self.coarse).argmin(1)

    def probes(self, vectors: np.ndarray, own: int, radius: float) -> np.ndarray:
        """For each row, of the list ``own``, the lists that can hold a vector within ``radius``."""
        far = squares(vectors, self.coarse)
        between = np.sqrt(squares(self.coarse[own:own + 1], self.coarse))
        beyond = (far - far[:, own:own + 1]) / (2 * np.where(between > 0, between, np.inf))
        needed = beyond <= radius + SLACK
        needed[:, own] = True
        return needed

    def encode(self, vectors: np.ndarray, own: int) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the residuals, and how far each vector is from what its codes stand for."""
        left = vectors - self.coarse[own]
        codes = np.stack([squares(left[:, p], book).argmin(1) for p, book in zip(self.parts, self.codebooks)], 1)
        error = sum(((left[:, p] - book[c]) ** 2).sum(1) for p, book, c in zip(self.parts, self.codebooks, codes.T))
        return codes.astype(np.uint8), np.sqrt(error)

    def table_distances(self, queries: np.ndarray, own: int, codes: np.ndarray) -> np.ndarray:
        """Squared distances of whole queries to coded vectors of a list, added up from a table per subspace."""
        left = queries - self.coarse[own]
        total = np.zeros((len(queries), len(codes)))
        for i, (p, book) in enumerate(zip(self.parts, self.codebooks)):
            total += np.take(squares(left[:, p], book), codes[:, i], axis=1)
        return total


def linked(queries, vectors, candidates, threshold):
    """Which candidates, a matrix of flags, are pairs at a cosine of ``threshold`` or more."""
    if candidates.mean() > DENSE:
        return candidates & (queries @ vectors.T >= threshold)
    rows, columns = np.nonzero(candidates)
    found = np.zeros_like(candidates)
    for a in range(0, len(rows), PAIRS):
        r, c = rows[a:a + PAIRS], columns[a:a + PAIRS]
        found[r, c] = np.einsum("ij,ij->i", queries[r], vectors[c]) >= threshold
    return found


class _Forest:
    def __init__(self, n):
        self.parents = list(range(n))

    def root(self, x):
        while self.parents[x] != x:
            self.parents[x] = x = self.parents[self.parents[x]]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.parents[max(a, b)] = min(a, b)


def join_all(forest, links, rows, columns):
    """Joins what a matrix of links connects; ``rows`` and ``columns`` are the nodes that it is between."""
    used_rows, used_columns = np.flatnonzero(links.any(1)), np.flatnonzero(links.any(0))
    if not len(used_rows):
        return
    links = links[np.ix_(used_rows, used_columns)]
    of_rows, of_columns = rows[used_rows].copy(), columns[used_columns].copy()
    most = max(of_rows.max(), of_columns.max()) + 1
    while True:
        now_rows = np.minimum(of_rows, np.where(links, of_columns, most).min(1))
        now_columns = np.minimum(of_columns, np.where(links, now_rows[:, None], most).min(0))
        if (now_rows == of_rows).all() and (now_columns == of_columns).all():
            break
        of_rows, of_columns = now_rows, now_columns
    for node, least in zip(rows[used_rows].tolist() + columns[used_columns].tolist(), of_rows.tolist() + of_columns.tolist()):
        if node != least:
            forest.join(node, least)


def _block(packed: pa.Table):
    row = packed.slice(0, 1).to_pylist()[0]
    ids = np.frombuffer(row["ids"], np.int64)
    return (row["dims"], row["list"], ids, np.frombuffer(row["weights"], np.int64),
            unit(from_bytes(row["kind"], row["data"], len(ids))), np.frombuffer(row["codes"], np.uint8).reshape(len(ids), -1),
            np.frombuffer(row["errors"], np.float64))


def search_blocks(a, b, quantisers, threshold, radius):
    """Links between the rows of two blocks, or within one if they are the same: (ids, linked rows), (ids, ids of a forest)."""
    dims, own, ids, weights, vectors, _, _ = a
    _, other, other_ids, other_weights, other_vectors, codes, errors = b
    model, same = quantisers[dims], a is b
    n = len(ids)
    nodes = np.arange(n) if same else np.arange(n, n + len(other_ids))
    forest = _Forest(n if same else n + len(other_ids))
    counts, other_counts = np.zeros(n, np.int64), np.zeros(len(other_ids), np.int64)
    for start in range(0, n, QUERIES):
        rows = np.arange(start, min(start + QUERIES, n))
        rows = rows[model.probes(vectors[rows], own, radius)[:, other]]
        if not len(rows):
            continue
        near = model.table_distances(vectors[rows], other, codes) <= (radius + errors + SLACK) ** 2
        if same:
            near[np.arange(len(rows)), rows] = False
        if not near.any():
            continue
        links = linked(vectors[rows], other_vectors, near, threshold)
        counts[rows] += links @ other_weights
        if not same:
            other_counts += weights[rows] @ links
        join_all(forest, links, rows, nodes)
    every = ids if same else np.concatenate((ids, other_ids))
    roots = np.array([forest.root(x) for x in range(len(every))], np.int64)
    joined = np.flatnonzero(roots != np.arange(len(every)))
    totals = counts if same else np.concatenate((counts, other_counts))
    counted = np.flatnonzero(totals)
    return every[counted], totals[counted], every[joined], every[roots[joined]]


def _search(quantisers, threshold, radius):
    schema = pa.schema([("is_link", pa.bool_()), ("a", pa.int64()), ("b", pa.int64())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        a = _block(left)
        same = left.column("bid")[0].as_py() == right.column("bid")[0].as_py()
        counted, totals, ends, roots = search_blocks(a, a if same else _block(right), quantisers, threshold, radius)
        return pa.table([pa.array(np.repeat([False, True], [len(counted), len(ends)])), pa.array(np.concatenate((counted, ends))),
                         pa.array(np.concatenate((totals, roots)))], schema=schema)
    return run


def fit_quantisers(classes: DataFrame, sample: int = SAMPLE, list_rows: int = LIST_ROWS) -> dict:
    """{length: quantiser}, fitted on the driver to at most ``sample`` vectors of each length, those of the least hashes.

    The number of lists grows with the largest label, up to MAX_LISTS.
    """
    shapes = classes.groupBy("dims", "label").agg(F.count("*").alias("n")).groupBy("dims").agg(
        F.max("n").alias("largest"), F.sum("n").alias("total")).collect()
    found = {}
    for shape in shapes:
        share = min(1.0, 1.5 * sample / shape["total"] + 64 / shape["total"])
        near = F.pmod(F.xxhash64("h1", "h2"), F.lit(1 << 30)) < int(share * (1 << 30))
        points = classes.where((F.col("dims") == shape["dims"]) & near).orderBy(F.xxhash64("h1", "h2"), "cid").limit(sample).select("embedding").toArrow()
        points = unit(stacked(points.column(0)))
        if len(points):
            found[shape["dims"]] = Quantiser(points, min(MAX_LISTS, max(LISTS, round(shape["largest"] / list_rows))))
    return found


def _assign(quantisers):
    def run(batches):
        for batch in batches:
            for dims, rows in by_length(batch, "embedding"):
                lists = quantisers[dims].lists(unit(stacked(rows.column("embedding"))))
                yield rows.append_column("list", pa.array(lists, pa.int32()))
    return run


def _pack(quantisers, radius):
    def run(rows: pa.Table) -> pa.Table:
        label, dims, own = (rows.column(c)[0].as_py() for c in ("label", "dims", "list"))
        raw = stacked(rows.column("embedding"))
        vectors, model = unit(raw), quantisers[dims]
        codes, errors = model.encode(vectors, own)
        kind, data = to_bytes(raw)
        needs = np.flatnonzero(model.probes(vectors, own, radius).any(0)).tolist()
        ids, weights = (rows.column(c).to_numpy().astype(np.int64).tobytes() for c in ("cid", "weight"))
        return pa.Table.from_pylist([dict(label=label, dims=dims, list=own, ids=ids, weights=weights, kind=kind, data=data,
                                          codes=codes.tobytes(), errors=errors.tobytes(), needs=needs)], schema=pa.schema(
            [("label", pa.int64()), ("dims", pa.int32()), ("list", pa.int32()), ("ids", pa.binary()), ("weights", pa.binary()),
             ("kind", pa.string()), ("data", pa.binary()), ("codes", pa.binary()), ("errors", pa.binary()), ("needs", pa.list_(pa.int32()))]))
    return run


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE, list_rows: int = LIST_ROWS,
                 block: int = BLOCK) -> DataFrame:
    """``vectors(vec_id, embedding, label)`` -> ``(vec_id, n_links, component_id, kept)``, one row per row of ``vectors``.

    Two rows are linked if their labels are equal and not null, their vectors have one length and their cosine is ``threshold``
    (above 0) or more. ``n_links`` counts the other rows linked directly, ``component_id`` is the smallest vec_id that links reach,
    and ``kept`` says whether that is the own one. Vectors that are null, empty or zero or hold null or non-finite components link with
    nothing and are kept. Repeated rows, and equal vectors, are linked with each other. A null vec_id is never the smallest; rows
    with a null id are kept where no other row is in reach. An empty table gives no rows.
    """
    radius = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    usable = F.col("label").isNotNull() & is_whole("embedding") & F.exists("embedding", lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"), "embedding").withColumn(
        "usable", F.coalesce(usable, F.lit(False)))
    hashes = [F.xxhash64("label", "embedding").alias("h1"), F.xxhash64(F.lit(1), "label", "embedding").alias("h2")]
    # a class is known by its label and 128 bits of hash; its number holds because the table is written once
    classes = snapshot(rows.where("usable").select("vec_id", "label", "embedding", *hashes).groupBy("label", "h1", "h2").agg(
        F.first("embedding").alias("embedding"), F.count("*").alias("weight"), F.min("vec_id").alias("first_id")).withColumn(
        "dims", F.size("embedding")).withColumn("cid", F.monotonically_increasing_id()), "vector-classes")
    quantisers = fit_quantisers(classes, sample, list_rows)

    listed = classes.select("label", "dims", "cid", "weight", "embedding").mapInArrow(
        _assign(quantisers), f"label bigint, dims int, cid bigint, weight bigint, embedding {classes.schema['embedding'].dataType.simpleString()}, list int")
    listed = snapshot(listed, "vector-lists")
    packed = grouped_blocks(listed.withColumn("row_hash", F.xxhash64("cid")), ["label", "dims", "list"], block).groupBy(
        "label", "dims", "list", "block").applyInArrow(_pack(quantisers, radius), _BLOCKS)
    packed = snapshot(packed.withColumn("bid", F.monotonically_increasing_id()), "vector-blocks")

    # a link is found from either end, so a pair of lists is searched from the smaller one
    places = packed.select("label", "dims", "list", "bid")
    other = places.select("label", "dims", F.col("list").alias("other_list"), F.col("bid").alias("other"))
    pairs = packed.select("label", "dims", "list", "bid", F.explode("needs").alias("other_list")).where("other_list >= list").join(
        other, ["label", "dims", "other_list"]).where("other_list > list or other >= bid").select("bid", "other")
    pairs = snapshot(pairs, "vector-block-pairs")
    data = ["dims", "list", "ids", "weights", "kind", "data", "codes", "errors"]
    left = pairs.join(packed.select("bid", *data), "bid")
    right = pairs.toDF("first_bid", "bid").join(packed.select("bid", *data).toDF("bid", *data), "bid")
    searched = left.groupBy("bid", "other").cogroup(right.groupBy("first_bid", "bid")).applyInArrow(
        _search(quantisers, threshold, radius), "is_link boolean, a bigint, b bigint")
    searched = snapshot(searched, "vector-links")

    counts = searched.where("not is_link").groupBy(F.col("a").alias("cid")).agg(F.sum("b").alias("near"))
    found = components(searched.where("is_link").select("a", "b")).withColumnRenamed("node", "cid")
    placed = classes.select("cid", "label", "h1", "h2", "weight", "first_id").join(found, "cid", "left").join(counts, "cid", "left").withColumn(
        "component", F.coalesce("component", "cid"))
    least = placed.groupBy("component").agg(F.min("first_id").alias("component_id"))
    known = snapshot(placed.join(least, "component").select(
        "label", "h1", "h2", (F.coalesce("near", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id",
        F.lit(True).alias("usable")), "vector-components")
    return rows.select("vec_id", "label", "usable", *hashes).join(known, ["label", "h1", "h2", "usable"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id")).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op12_quantised(spark, sf_dir):
    return near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))


ORACLE = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
u AS (SELECT vec_id, label, e FROM v WHERE label IS NOT NULL AND e IS NOT NULL
      AND list_bool_and(list_transform(e, lambda x: x IS NOT NULL AND isfinite(x))) AND list_bool_or(list_transform(e, lambda x: x <> 0))),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id
      WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a),
c AS (SELECT a, min(b) AS b FROM r GROUP BY a)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, least(v.vec_id, coalesce(c.b, v.vec_id)) AS component_id,
       least(v.vec_id, coalesce(c.b, v.vec_id)) = v.vec_id AS kept
FROM v LEFT JOIN n ON n.a = v.vec_id LEFT JOIN c ON c.a = v.vec_id
"""
