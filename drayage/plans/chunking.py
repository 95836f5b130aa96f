"""Cutting objects into chunks."""

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import ceil_div, int_div
from ..settings import MAX_UPLOAD_PARTS, MIN_UPLOAD_CHUNK_SIZE, check_direction, effective_chunk_size

PART_BLOCK = 65_536
MAX_PARTS = 2**31 - 1


def multipart_flag(size: Column, direction: str, chunk_size: int) -> Column:
    """Downloads are cut above the chunk size. Uploads are multipart from the fixed minimum on, even with one part."""
    if check_direction(direction) == "upload":
        return size >= MIN_UPLOAD_CHUNK_SIZE
    return size > chunk_size


def part_count(size: Column, chunk_size: int) -> Column:
    """An empty object is one empty part."""
    return F.greatest(F.lit(1).cast("bigint"), ceil_div(size, chunk_size))


def classify_transfer(objects: DataFrame, direction: str = "download", chunk_size=None) -> DataFrame:
    """``objects`` + ``is_multipart``."""
    size = effective_chunk_size(chunk_size, direction)
    return objects.withColumn("is_multipart", multipart_flag(F.col("size"), direction, size))


def part_columns(size: Column, part: Column, chunk_size: int, base_offset=0) -> list[Column]:
    """Offsets and size of part number ``part``, in closed form."""
    offset = (part - 1) * chunk_size
    base = base_offset if isinstance(base_offset, Column) else F.lit(base_offset).cast("bigint")
    return [part.cast("int").alias("part_number"),
            (offset + base).alias("input_offset"),
            (offset + base).alias("output_offset"),
            F.least(F.lit(chunk_size).cast("bigint"), size - offset).alias("part_size")]


def explode_parts(df: DataFrame, max_parts=None, spread=None) -> DataFrame:
    """One row per part number 1..n_parts, in a column ``part``.

    Blocks of parts are exploded first, so no row ever holds more than ``PART_BLOCK`` numbers (and one number per
    block). ``spread`` shuffles the blocks to that many tasks; it is worth it when few objects hold most of the parts.
    ``max_parts`` is the known largest n_parts, which saves the block level for ordinary inventories.
    """
    if max_parts is not None and max_parts <= PART_BLOCK and not spread:
        return df.withColumn("part", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n_parts"))))
    last_block = int_div(F.col("n_parts") - 1, F.lit(PART_BLOCK).cast("bigint"))
    blocks = df.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), last_block)))
    if spread:
        blocks = blocks.repartition(spread, "key", "block")
    first = F.col("block") * PART_BLOCK + 1
    last = F.least(F.col("n_parts"), F.col("block") * PART_BLOCK + PART_BLOCK)
    return blocks.withColumn("part", F.explode(F.sequence(first, last))).drop("block")


def plannable(objects: DataFrame, chunk_size: int) -> DataFrame:
    """Objects that have a size, below 2^31 chunks; :func:`plan_errors` reports the others."""
    return objects.where((F.col("size") >= 0) & (part_count(F.col("size"), chunk_size) <= MAX_PARTS))


def plan_errors(objects: DataFrame, direction: str = "download", chunk_size=None) -> DataFrame:
    """What a plan leaves out, or the store will refuse: key, size, plan_error.

    ``missing_size`` (no such object, or a negative size) and ``too_many_parts`` (above 2^31 - 1) aren't planned.
    ``above_upload_limit`` is planned, as other chunks of the same upload may do; a store takes 10,000 parts.
    """
    chunk = effective_chunk_size(chunk_size, check_direction(direction))
    size = F.col("size").cast("bigint")
    parts = part_count(size, chunk)
    error = F.when(size.isNull() | (size < 0), "missing_size").when(parts > MAX_PARTS, "too_many_parts")
    if direction == "upload":
        error = error.when(parts > MAX_UPLOAD_PARTS, "above_upload_limit")
    return objects.select("key", size.alias("size"), error.alias("plan_error")).where("plan_error is not null")


def plan_parts(objects: DataFrame, chunk_size=None, base_offset=0, spread: int = None) -> DataFrame:
    """Parts of each object: key, part_number, input_offset, output_offset, part_size, n_parts.

    Objects without a size are left out, see :func:`plan_errors`.
    ``base_offset`` (number or column) shifts both offsets when the object is a window of a larger one. ``spread``
    deals blocks of 65,536 parts out to that many tasks, for inventories in which few objects hold most of the parts.
    """
    chunk = effective_chunk_size(chunk_size)
    if isinstance(base_offset, Column):
        sized = objects.select("key", F.col("size").cast("bigint").alias("size"),
                               base_offset.cast("bigint").alias("base"))
        base = F.col("base")
    else:
        sized = objects.select("key", F.col("size").cast("bigint").alias("size"))
        base = base_offset
    sized = plannable(sized, chunk)
    parts = explode_parts(sized.withColumn("n_parts", part_count(F.col("size"), chunk)), spread=spread)
    return parts.select("key", *part_columns(F.col("size"), F.col("part"), chunk, base),
                        F.col("n_parts").cast("int").alias("n_parts"))
