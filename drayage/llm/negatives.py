"""Hard negatives by exact inner-product search with length buckets and coordinate pruning.

Vectors of a label lie in buckets of similar length. A bucket has, per coordinate, the list of its normalised values in order. If
a product with a vector of a bucket is to reach a threshold, the cosine has to reach threshold / (own length x greatest length);
then each coordinate of the other vector lies in a range around the anchor's, which is narrow where the anchor's coordinate is
large. The ranges of a few focus coordinates are looked up in the lists and intersected, and what is in all of them is
verified exactly. The threshold rises while better ones are found, and buckets that are too short are passed over.

First each anchor finds its positives among the rows of its label, then, per positive, the best rows of other labels in a window of
scores below that of the positive. Blocks of a bucket meet groups of anchors of one label in cells, one task's work each.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..materialize import snapshot
from .common import table
from .vectors import by_length, from_bytes, grouped_blocks, is_whole, stacked, to_bytes

SCALE, POSITIVES, NEGATIVES = 256, 5, 3
LOW, HIGH, WHOLE = 50, 95, 100          # per cent of the positive's score that a negative's lies between
LENGTH_STEP = 1.2                       # greatest length of a bucket divided by its least
FOCUS, SEEDS = 4, 32                    # coordinates whose ranges are intersected; rows that give a first threshold
BLOCK, ANCHORS, CELL = 4096, 512, 8     # rows of a block, anchors of a group, blocks of a cell
EXACT, ROUNDING = 2 ** 53, 1e-9         # below it sums of products are exact in doubles; what thresholds are loosened by
_BLOCKS = "dims int, label bigint, longest double, ids binary, kind string, data binary"


def feasible(x: float, cosine: float) -> tuple[float, float]:
    """Between what a coordinate of a direction lies that has this cosine or more with one whose coordinate is ``x``.

    As angles to the axis the two differ by no more than the angle between the directions.
    """
    angle, most = np.arccos(np.clip(x, -1, 1)), np.arccos(np.clip(cosine, -1, 1))
    return float(np.cos(min(np.pi, angle + most))) - 1e-6, float(np.cos(max(0.0, angle - most))) + 1e-6


class Bucket:
    """Vectors of similar length in whole numbers, with their sorted coordinate lists, made when they are asked for."""

    def __init__(self, ids, vectors):
        self.ids, self.vectors = ids, vectors
        lengths = np.sqrt((vectors ** 2).sum(1))
        self.longest = float(lengths.max(initial=0))
        self.reach = np.abs(vectors).max(initial=0)
        self.directions = vectors / np.where(lengths > 0, lengths, 1)[:, None]
        self.lists = {}

    def coordinate(self, f):
        if f not in self.lists:
            order = np.argsort(self.directions[:, f], kind="stable")
            self.lists[f] = order, self.directions[order, f]
        return self.lists[f]

    def seeds(self, direction, n=SEEDS):
        """Rows at the end of the list of the anchor's strongest coordinate."""
        f = int(np.abs(direction).argmax())
        order, _ = self.coordinate(f)
        return order[-n:] if direction[f] > 0 else order[:n]

    def candidates(self, direction, cosine, focus=FOCUS):
        """Rows whose coordinates all lie in the ranges for ``cosine`` or more with a direction; all where the bound says nothing."""
        n = len(self.ids)
        if cosine > 1 + ROUNDING:
            return np.zeros(0, np.int64)
        if cosine <= 0 or not direction.any():
            return np.arange(n)
        cosine, hits, used = min(cosine, 1.0), np.zeros(n, np.int16), 0
        for f in np.argsort(-np.abs(direction), kind="stable")[:focus].tolist():
            order, values = self.coordinate(f)
            low, high = feasible(float(direction[f]), cosine)
            a, b = np.searchsorted(values, low, "left"), np.searchsorted(values, high, "right")
            if b - a < n:
                hits[order[a:b]] += 1
                used += 1
        return np.flatnonzero(hits == used)

    def scores(self, anchor, rows=None):
        """Inner products as whole numbers: of any size if need be, the nearest long beyond a long."""
        vectors = self.vectors if rows is None else self.vectors[rows]
        if len(anchor) * np.abs(anchor).max(initial=0) * self.reach < EXACT:
            return (vectors @ anchor).astype(np.int64)
        least, most = -(1 << 63), (1 << 63) - 1
        whole = [int(x) for x in anchor]
        return np.array([min(max(sum(a * int(b) for a, b in zip(whole, v)), least), most) for v in vectors], np.int64)

    def reaching(self, anchor, length, direction, threshold):
        """(scores, ids) of the rows whose score with an anchor is ``threshold`` or more, best first; all of them without one."""
        if threshold is None:
            rows = np.arange(len(self.ids))
        else:
            most = length * self.longest
            cosine = threshold / most * (1 - ROUNDING) if most > 0 else 0.0 if threshold <= 0 else np.inf
            rows = self.candidates(direction, cosine)
        scores, ids = self.scores(anchor, rows), self.ids[rows]
        if threshold is not None:
            fine = scores >= threshold
            scores, ids = scores[fine], ids[fine]
        order = np.lexsort((ids, ~scores))     # ~ turns the order of whole numbers round without overflow
        return scores[order], ids[order]

    def first_scores(self, anchor, direction, own):
        """Scores of a few rows that are likely to be good, best first."""
        rows = self.seeds(direction)
        scores = self.scores(anchor, rows[self.ids[rows] != own])
        return np.sort(scores)[::-1]


def within(scores, low, high, n):
    """Slice of the first ``n`` of falling scores that lie in a window."""
    a, b = (len(scores) - int(np.searchsorted(scores[::-1], x, side)) for x, side in ((high, "right"), (low, "left")))
    return slice(a, max(a, min(b, a + n)))


def merged(best, scores, ids, n):
    scores, ids = np.concatenate((best[0], scores)), np.concatenate((best[1], ids))
    order = np.lexsort((ids, ~scores))[:n]
    return scores[order], ids[order]


def _none():
    return np.zeros(0, np.int64), np.zeros(0, np.int64)


def best_positives(buckets, anchor, own, n):
    """The ``n`` best rows with another id, from buckets in falling order of length."""
    length = float(np.sqrt((anchor ** 2).sum()))
    direction = anchor / (length or 1)
    best = _none()
    for bucket in buckets:
        threshold = int(best[0][-1]) if len(best[0]) == n else None
        if threshold is None:
            first = bucket.first_scores(anchor, direction, own)
            threshold = int(first[n - 1]) if len(first) >= n else None
        scores, ids = bucket.reaching(anchor, length, direction, threshold)
        other = ids != own
        best = merged(best, scores[other][:n], ids[other][:n], n)
    return best


def best_in_windows(buckets, anchor, own, windows, n):
    """For each window (low, high) of scores the ``n`` best rows with another id in it."""
    length = float(np.sqrt((anchor ** 2).sum()))
    direction = anchor / (length or 1)
    best = [_none() for _ in windows]
    for bucket in buckets:
        first, floors = bucket.first_scores(anchor, direction, own), []
        for (low, high), found in zip(windows, best):
            if low <= high:
                sure = first[within(first, low, high, n)]
                floors.append(max([low, *(int(x[-1]) for x in (sure, found[0]) if len(x) == n)]))
        if not floors:
            break
        scores, ids = bucket.reaching(anchor, length, direction, min(floors))
        other = ids != own
        scores, ids = scores[other], ids[other]
        for i, (low, high) in enumerate(windows):
            part = within(scores, low, high, n)
            best[i] = merged(best[i], scores[part], ids[part], n)
    return best


def window_of(positive_score, low, high, whole):
    """The least and the greatest score of a negative: low * p <= whole * x <= high * p in whole numbers."""
    return -(-low * positive_score // whole), high * positive_score // whole


def _anchors(table: pa.Table):
    row = table.slice(0, 1).to_pylist()[0]
    ids = np.frombuffer(row["ids"], np.int64)
    vectors = from_bytes(row["kind"], row["data"], len(ids))
    positives = row.get("positives") or [[]] * len(ids)
    return zip(ids.tolist(), vectors, positives)


def _buckets(table: pa.Table):
    rows = sorted(table.select(["longest", "ids", "kind", "data"]).to_pylist(), key=lambda r: -r["longest"])
    ids = [np.frombuffer(r["ids"], np.int64) for r in rows]
    return [Bucket(i, from_bytes(r["kind"], r["data"], len(i))) for r, i in zip(rows, ids)]


def _find_positives(n):
    def run(blocks: pa.Table, anchors: pa.Table) -> pa.Table:
        out, buckets = ([], [], []), _buckets(blocks)
        for own, anchor, _ in _anchors(anchors):
            scores, ids = best_positives(buckets, anchor, own, n)
            for column, values in zip(out, ([own] * len(ids), ids.tolist(), scores.tolist())):
                column += values
        return pa.table([pa.array(x, pa.int64()) for x in out], names=["anchor_id", "positive_id", "positive_score"])
    return run


def _find_negatives(n, low, high, whole):
    def run(blocks: pa.Table, anchors: pa.Table) -> pa.Table:
        out, buckets = ([], [], [], []), _buckets(blocks)
        for own, anchor, positives in _anchors(anchors):
            windows = [window_of(p["positive_score"], low, high, whole) for p in positives]
            for p, (scores, ids) in zip(positives, best_in_windows(buckets, anchor, own, windows, n)):
                for column, values in zip(out, ([own] * len(ids), [p["place"]] * len(ids), ids.tolist(), scores.tolist())):
                    column += values
        return pa.table([pa.array(x, pa.int64()) for x in out], names=["anchor_id", "place", "negative_id", "negative_score"])
    return run


def _scaled(scale):
    """Adds the bucket of a vector's length."""
    def run(batches):
        for batch in batches:
            for dims, rows in by_length(batch, "embedding"):
                whole = np.floor(scale * stacked(rows.column("embedding")))
                with np.errstate(over="ignore"):
                    lengths = np.sqrt((whole ** 2).sum(1))
                steps = np.where(lengths > 0, np.floor(np.log(np.maximum(lengths, 1)) / np.log(LENGTH_STEP)), -1)
                steps = np.where(np.isfinite(steps), steps, 1 << 20).astype(np.int32)
                yield rows.append_column("dims", pa.array(np.full(len(whole), dims, np.int32))).append_column("step", pa.array(steps))
    return run


def _pack(scale, of_anchors=False):
    def run(rows: pa.Table) -> pa.Table:
        dims, label = rows.column("dims")[0].as_py(), rows.column("label")[0].as_py()
        whole = np.floor(scale * stacked(rows.column("embedding")))
        kind, data = to_bytes(whole)
        with np.errstate(over="ignore"):
            longest = float(np.sqrt((whole ** 2).sum(1)).max(initial=0))
        row = dict(dims=dims, label=label, longest=longest, ids=rows.column("vec_id").to_numpy().astype(np.int64).tobytes(), kind=kind, data=data)
        schema = [("dims", pa.int32()), ("label", pa.int64()), ("longest", pa.float64()), ("ids", pa.binary()), ("kind", pa.string()), ("data", pa.binary())]
        if of_anchors:
            row["positives"] = [x or [] for x in rows.column("positives").to_pylist()]
            scores = [p["positive_score"] for x in row["positives"] for p in x]
            row["least_score"] = min(scores, default=None)
            schema += [("positives", pa.list_(pa.list_(pa.struct([("place", pa.int32()), ("positive_id", pa.int64()), ("positive_score", pa.int64())])))),
                       ("least_score", pa.int64())]
        return pa.Table.from_pylist([row], schema=pa.schema(schema))
    return run


def _cells(blocks: DataFrame, groups: DataFrame, meet, find, schema: str) -> DataFrame:
    """Runs ``find`` on groups of anchors with up to CELL of the blocks that they ``meet``, longest first."""
    near = groups.select("gid", F.col("dims").alias("g_dims"), F.col("label").alias("g_label"), F.col("longest").alias("g_longest"),
                         *[c for c in ("least_score",) if c in groups.columns])
    order = Window.partitionBy("gid").orderBy(F.desc("longest"), "bid")
    pairs = snapshot(blocks.select("bid", "dims", "label", "longest").join(near, meet).select(
        "gid", "bid", F.floor((F.row_number().over(order) - 1) / CELL).alias("slot")), "vector-cells")
    left = pairs.join(blocks.drop("dims", "label"), "bid")
    right = pairs.select("gid", "slot").distinct().toDF("gid", "slot").join(groups.drop("dims", "label"), "gid")
    return left.groupBy("gid", "slot").cogroup(right.groupBy("gid", "slot")).applyInArrow(find, schema)


def hard_negatives(vectors: DataFrame, anchors: DataFrame, n_positives: int = POSITIVES, n_negatives: int = NEGATIVES,
                   low: int = LOW, high: int = HIGH, whole: int = WHOLE, scale: int = SCALE) -> DataFrame:
    """``(vec_id, embedding, label)`` twice -> ``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    A score is the inner product of floor(scale * x), exact (beyond a long: the nearest long). The positives of an anchor are
    the ``n_positives`` best rows of its label with another id, ties to smaller ids. For each of them the rows of other labels whose score x
    fits ``low * p <= whole * x <= high * p`` are ranked in the same way, and the first ``n_negatives`` are returned. A negative p
    has no such rows. Rows with a null id, label or vector, or a null or non-finite component, take no part; rows whose
    vectors have another length than the anchor's aren't compared with it. Rows that repeat are several candidates, and several positives;
    of several anchor rows with one id the one with the greatest label, then vector, counts. Anchors without positives, and positives without
    negatives, have no rows.
    """
    def usable(rows):
        return rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & is_whole("embedding")).select(
            F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"), "embedding")
    kind = vectors.schema["embedding"].dataType.simpleString()
    rows = usable(vectors).mapInArrow(_scaled(scale), f"vec_id bigint, label bigint, embedding {kind}, dims int, step int")
    rows = rows.withColumn("row_hash", F.xxhash64("vec_id", "embedding"))
    blocks = grouped_blocks(rows, ["dims", "label", "step"], BLOCK).groupBy("dims", "label", "step", "block").applyInArrow(_pack(scale), _BLOCKS)
    blocks = snapshot(blocks.withColumn("bid", F.monotonically_increasing_id()), "vector-buckets")

    chosen = usable(anchors).groupBy("vec_id").agg(F.max(F.struct("label", "embedding")).alias("a")).select("vec_id", "a.label", "a.embedding")
    chosen = snapshot(chosen.withColumn("dims", F.size("embedding")), "anchors")
    grouped = f"{_BLOCKS}, positives array<array<struct<place:int,positive_id:bigint,positive_score:bigint>>>, least_score bigint"

    def groups_of(rows):
        dealt = grouped_blocks(rows.withColumn("row_hash", F.xxhash64("vec_id")), ["dims", "label"], ANCHORS)
        return snapshot(dealt.groupBy("dims", "label", "block").applyInArrow(_pack(scale, True), grouped).withColumn(
            "gid", F.monotonically_increasing_id()), "anchor-groups")
    nothing = F.lit(None).cast("array<struct<place:int,positive_id:bigint,positive_score:bigint>>")
    groups = groups_of(chosen.withColumn("positives", nothing)).drop("positives", "least_score")
    same = (F.col("dims") == F.col("g_dims")) & (F.col("label") == F.col("g_label"))
    found = _cells(blocks, groups, same, _find_positives(n_positives), "anchor_id bigint, positive_id bigint, positive_score bigint")
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    positives = snapshot(found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n_positives), "positives")

    lists = positives.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.sort_array(F.collect_list(F.struct("place", "positive_id", "positive_score"))).alias("positives"))
    groups = groups_of(chosen.join(lists, "vec_id"))
    reach = F.col("longest") * F.col("g_longest") * (1 + 2 * ROUNDING) >= F.col("least_score") * F.lit(low / whole)
    others = (F.col("dims") == F.col("g_dims")) & (F.col("label") != F.col("g_label")) & reach
    found = _cells(blocks, groups, others, _find_negatives(n_negatives, low, high, whole),
                   "anchor_id bigint, place bigint, negative_id bigint, negative_score bigint")
    order = Window.partitionBy("anchor_id", "place").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n_negatives)
    return ranked.join(positives, ["anchor_id", "place"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op11_negatives(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.when(
        F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"))
    return hard_negatives(vectors, vectors.where(F.col("vec_id") % 50 == 0))


ORACLE = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
s AS (SELECT q.vec_id AS anchor_id, c.vec_id, q.label = c.label AS same, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank,
             vec_id AS negative_id, positive_score, score AS negative_score
      FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""
