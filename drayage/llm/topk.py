"""Exact top-k inner-product search over vectors in vertical layout, by branch and bound.

Vectors are packed into blocks of columns. A group of blocks meets a group of queries in one task: groups are dealt out
as a grid, so that no task holds more than CELL vectors and QUERIES queries. Inner products grow by STEP dimensions at a
time. After each step what is left of a product is at most the product of the norms that are left; candidates that can't
reach the k-th score any more are dropped, and the survivors are compacted.
"""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .common import table
from .vectors import is_whole

K, SCALE, STEP = 10, 1024, 16
BLOCK, CELL, QUERIES = 2048, 16_384, 1024   # vectors of a block and of a group; queries of a group
_PACKED = "dims int, part int, n int, ids binary, data binary"
_LONG = (-(1 << 63), (1 << 63) - 1)


def _usable(batch):
    """{dimensions: (ids, vectors)} of the rows whose vector is there and holds finite numbers only."""
    vectors = batch.column(1)
    sizes = np.array([-1 if x is None else x for x in vectors.value_lengths().to_pylist()], np.int64)
    values = vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)    # a null becomes nan
    starts = np.concatenate(([0], np.cumsum(np.maximum(sizes, 0))[:-1]))
    ids = batch.column(0).to_numpy(zero_copy_only=False)
    for dims in np.unique(sizes[sizes >= 0]):
        rows = np.flatnonzero(sizes == dims)
        found = values[starts[rows][:, None] + np.arange(dims)]
        fine = np.isfinite(found).all(1)
        yield int(dims), ids[rows][fine].astype(np.int64), found[fine]


def _pack(parts: int, scale: int, rows: int):
    """Blocks of up to ``rows`` vectors: floor(scale * x), dimension by dimension."""
    def read(batches):
        at = TaskContext.get().partitionId() * 7919
        for batch in batches:
            for dims, ids, vectors in _usable(batch):
                for i in range(0, len(ids), rows):
                    data = np.floor(scale * vectors[i:i + rows])
                    n = len(data)
                    yield pa.RecordBatch.from_pylist([{"dims": dims, "part": at % parts, "n": n,
                                                       "ids": ids[i:i + rows].tobytes(), "data": data.T.tobytes()}],
                                                     schema=pa.schema([("dims", pa.int32()), ("part", pa.int32()), ("n", pa.int32()),
                                                                       ("ids", pa.binary()), ("data", pa.binary())]))
                    at += 1
    return read


def _blocks(packed):
    for dims, n, ids, data in zip(*(packed.column(c).to_pylist() for c in ("dims", "n", "ids", "data"))):
        yield np.frombuffer(ids, np.int64), np.frombuffer(data, np.float64).reshape(dims, n)


def _best(scores, ids, k):
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def search_block(query, own_id, ids, columns, tails, best, k=K, step=STEP):
    """Improves ``best``, (scores, ids), of one query by a block; columns are dimensions, tails the norms left after steps."""
    scores, found = best
    alive = np.flatnonzero(ids != own_id)
    partial = np.zeros(len(alive))
    for i, a in enumerate(range(0, len(query), step)):
        partial += query[a:a + step] @ (columns[a:a + step] if len(alive) == columns.shape[1] else columns[a:a + step, alive])
        left = np.sqrt((query[a + step:] ** 2).sum()) * tails[i + 1][alive]
        left += 1 + 1e-9 * (np.abs(partial) + left)     # more than rounding of the bound can be
        sure = np.concatenate((scores, partial - left))
        if len(sure) > k:
            stay = partial + left >= -np.partition(-sure, k - 1)[k - 1]
            if not stay.all():
                alive, partial = alive[stay], partial[stay]
    return _best(np.concatenate((scores, partial)), np.concatenate((found, ids[alive])), k)


def _nearest_long(x):
    return min(max(x, _LONG[0]), _LONG[1])


def _search(k, step):
    def run(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        out = ([], [], [])
        for query_ids, query_columns in _blocks(queries):
            best = [(np.zeros(0), np.zeros(0, np.int64))] * len(query_ids)
            big = [None] * len(query_ids)
            reach = np.abs(query_columns).max(initial=0)
            for ids, columns in _blocks(vectors):
                # sums of products have to be exact in doubles; beyond, they are added up as integers of any size
                exact = len(columns) * reach * np.abs(columns).max(initial=0) < 2 ** 52
                squares = columns ** 2
                tails = [np.sqrt(squares[a:].sum(0)) for a in range(0, len(columns) + step, step)]
                for j, own in enumerate(query_ids.tolist()):
                    if exact and big[j] is None:
                        best[j] = search_block(query_columns[:, j], own, ids, columns, tails, best[j], k, step)
                    else:
                        big[j] = (big[j] or [(int(s), int(i)) for s, i in zip(*best[j])]) + [
                            (_nearest_long(sum(int(x) * int(y) for x, y in zip(query_columns[:, j], columns[:, c]))), i)
                            for c, i in enumerate(ids.tolist()) if i != own]
                        big[j] = sorted(big[j], key=lambda x: (-x[0], x[1]))[:k]
            for own, found, large in zip(query_ids.tolist(), best, big):
                pairs = large if large is not None else zip(found[0].astype(np.int64).tolist(), found[1].tolist())
                for s, i in pairs:
                    out[0].append(own)
                    out[1].append(i)
                    out[2].append(s)
        return pa.table([pa.array(x, pa.int64()) for x in out], names=["query_id", "vec_id", "score"])
    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, scale: int = SCALE, step: int = STEP) -> DataFrame:
    """``(vec_id, embedding)`` twice -> ``(query_id, rank, vec_id, score)``: the k highest scores of each query, from 1.

    The score is the inner product of floor(scale * x), exact; beyond a long it is the nearest long, and ranks as that. Ties go to smaller
    vec_ids. A query meets every row with another id and as many dimensions; rows that repeat are several candidates.
    Of several usable query rows with one id the greatest vector, component by component, is the query. Vectors that are null or hold null or non-finite
    components take no part, neither do rows without an id. A query without candidates has no rows.
    """
    def usable(rows):
        return rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).where(
            F.col("vec_id").isNotNull() & is_whole("embedding"))
    vectors = usable(vectors)
    queries = usable(queries).groupBy("vec_id").agg(F.max("embedding").alias("embedding"))
    parts = max(1, -(-vectors.count() // CELL))
    groups = max(1, -(-queries.count() // QUERIES))
    left = vectors.mapInArrow(_pack(parts, scale, BLOCK), _PACKED).select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("query_part"))
    right = queries.mapInArrow(_pack(groups, scale, QUERIES), _PACKED).withColumnRenamed("part", "query_part").select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    keys = ["dims", "part", "query_part"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        _search(k, step), "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def op1_topk(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0))


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
           FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
q AS (SELECT vec_id, max(e) AS e FROM v WHERE vec_id % 100 = 0 GROUP BY vec_id),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
      FROM q JOIN v c ON q.vec_id <> c.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM
  (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10
"""
