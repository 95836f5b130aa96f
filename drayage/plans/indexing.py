"""The flat, globally indexed chunk list."""

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..materialize import snapshot
from ..settings import check_direction, effective_chunk_size
from .chunking import PART_BLOCK, explode_parts, multipart_flag, part_columns, part_count, plannable

OBJECTS_PER_BUCKET = 100_000
MIN_BUCKETS, MAX_BUCKETS = 8, 4_096
SAMPLES_PER_BUCKET = 16
_HASH_SPACE = 1 << 40


def unique_objects(objects: DataFrame) -> DataFrame:
    """One row (key, size) per key. The latest mtime wins, then the larger size.

    The aggregate combines on the map side, so a key with very many copies shuffles one row per task.
    """
    size = F.col("size").cast("bigint")
    if "mtime" in objects.columns:
        newest = F.max(F.struct(F.col("mtime"), size.alias("size"))).getField("size")
    else:
        newest = F.max(size)
    return objects.groupBy("key").agg(newest.alias("size"))


def build_plan(objects: DataFrame, direction: str = "download", chunk_size=None,
               unique_keys: bool = False) -> DataFrame:
    """All chunks of all objects as one list, indexed 0.. in the order (key, part_number).

    Columns: key, object_size, part_number, input_offset, output_offset, part_size, n_parts, is_multipart, chunk_idx,
    n_chunks (the length of the list, on each row).

    No global sort: keys are cut into ranges by sampled bounds, the chunks per range are summed, and a running sum per
    range starts from the sum of the ranges before it. Only objects are shuffled and ordered, chunks never are.
    Objects without a size are left out: :func:`plan_errors` reports them, and uploads of too many parts.
    ``unique_keys`` states that no key repeats (a listing, a primary key) and saves the de-duplication.
    """
    check_direction(direction)
    chunk = effective_chunk_size(chunk_size, direction)
    listed = objects.select("key", F.col("size").cast("bigint").alias("size"))
    # Sizes may come from bodies; the snapshot reads them once and all later passes see the same inventory.
    sized = snapshot(plannable(listed if unique_keys else unique_objects(objects), chunk), "objects")

    n_objects = sized.count()
    bounds = _key_bounds(sized, n_objects)
    parted = sized.select("key", "size", part_count(F.col("size"), chunk).alias("n_parts"),
                          _bucket(F.col("key"), bounds).alias("bucket"))

    totals = {row["bucket"]: row for row in _bucket_totals(parted)}
    starts, n_chunks = [], 0
    for bucket in range(len(bounds) + 1):
        starts.append(n_chunks)
        n_chunks += totals[bucket]["chunks"] if bucket in totals else 0
    max_parts = max((row["largest"] for row in totals.values()), default=1)

    in_bucket = Window.partitionBy("bucket").orderBy("key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    start = F.element_at(F.lit(starts).cast("array<bigint>"), F.col("bucket") + 1)
    placed = parted.select("key", "size", "n_parts",
                           (start + F.sum("n_parts").over(in_bucket) - F.col("n_parts")).alias("first_idx"))
    chunks = explode_parts(placed, max_parts, _spread(placed, n_objects, n_chunks, max_parts))
    size, part = F.col("size"), F.col("part")
    return chunks.select("key", size.alias("object_size"), *part_columns(size, part, chunk),
                         F.col("n_parts").cast("int").alias("n_parts"),
                         multipart_flag(size, direction, chunk).alias("is_multipart"),
                         (F.col("first_idx") + part - 1).alias("chunk_idx"),
                         F.lit(n_chunks).cast("bigint").alias("n_chunks"))


def _bucket_totals(parted: DataFrame) -> list:
    """At most MAX_BUCKETS rows reach the driver, whatever the inventory holds."""
    return parted.groupBy("bucket").agg(F.sum("n_parts").alias("chunks"), F.max("n_parts").alias("largest")).collect()


def _spread(placed: DataFrame, n_objects: int, n_chunks: int, max_parts: int):
    """Shuffle before the explode only if it multiplies rows a lot or one object alone is large."""
    if max_parts <= PART_BLOCK and n_chunks <= 64 * max(n_objects, 1):
        return None
    cores = placed.sparkSession.sparkContext.defaultParallelism
    return int(min(max(cores, n_chunks // 1_000_000), 20_000))


def _key_bounds(sized: DataFrame, n_objects: int) -> list[str]:
    """Ascending keys that cut the inventory into ranges of about equal numbers of objects.

    The sample is picked by hash of the key, so it is the same each time. Keys are distinct here, so about as many are
    picked as are wanted, a number that doesn't grow with the inventory. The bounds decide about balance only, any set of them gives the same index.
    """
    buckets = min(max(-(-n_objects // OBJECTS_PER_BUCKET), MIN_BUCKETS), MAX_BUCKETS)
    wanted = buckets * SAMPLES_PER_BUCKET
    keys = sized.select("key")
    if n_objects > wanted:
        threshold = math.ceil(_HASH_SPACE * wanted / n_objects)
        keys = keys.where(F.pmod(F.xxhash64("key"), F.lit(_HASH_SPACE)) < threshold)
    sample = sorted({row["key"] for row in keys.collect()})
    step = max(len(sample) // buckets, 1)
    return sample[step::step][:buckets - 1]


def _bucket(key: Column, bounds: list[str]) -> Column:
    """Number of bounds at or below the key, found through groups of bounds to compare about 2*sqrt(n) of them."""
    if not bounds:
        return F.lit(0)
    width = math.isqrt(len(bounds) - 1) + 1
    groups = [bounds[i:i + width] for i in range(0, len(bounds), width)]
    group = F.size(F.filter(F.lit([g[0] for g in groups]), lambda bound: bound <= key))
    inside = F.element_at(F.array(*[F.lit(g) for g in groups]), group)
    position = (group - 1) * width + F.size(F.filter(inside, lambda bound: bound <= key))
    return F.when(group == 0, F.lit(0)).otherwise(position)
