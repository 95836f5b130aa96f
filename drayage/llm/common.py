"""What several operators need."""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..materialize import broadcast_if_bounded

LOWEST_ID = -(1 << 63)
BATCH_BYTES, GATHERED_BYTES = 8 << 20, 24 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(text) -> Column:
    """The bytes of a text, a column or its name; null is empty."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(text.cast("binary"), F.lit(b"").cast("binary"))


def bucket(doc_id, modulus: int) -> Column:
    """crc32 of the id as text, modulo; -1 for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus, F.lit(-1).cast("bigint"))


def bucket_of(doc_id: int, modulus: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % modulus


def row_key(docs: DataFrame) -> list[Column]:
    """What tells documents apart, also where an id is null or occurs twice: the id and a hash of the text."""
    return [F.coalesce(docs["doc_id"].cast("bigint"), F.lit(LOWEST_ID)).alias("key_id"),
            F.hash(utf8(docs["text"])).cast("bigint").alias("key_hash")]


def matching(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` that are in ``keys(key_id, key_hash)``, distinct, or aren't: ``semi`` or ``anti``. Keys are
    broadcast if they are counted to be few, else both sides are shuffled."""
    key_id, key_hash = row_key(docs)
    few = broadcast_if_bounded(keys)
    return docs.join(few, (key_id == few["key_id"]) & (key_hash == few["key_hash"]), f"left_{how}")


def small_batches(spark: SparkSession) -> None:
    """Bounds the Arrow batches of this session by their bytes: texts are long, and JVM and worker hold several each."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def gathered(batches, most: int = GATHERED_BYTES):
    """Puts batches together until they have ``most`` bytes, for work that gains from seeing more rows at once."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= most:
            whole, held, size = pa.Table.from_batches(held).combine_chunks(), [], 0
            yield from whole.to_batches()
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def bit_table(keys: DataFrame, key: str, n_keys: int, most: int = 1 << 26) -> np.ndarray:
    """Bits, packed, of the longs in a column, at their value modulo the number of bits: a power of two, 16 for each key at
    least but no more than ``most`` (8 MB). Made by Spark's bitmaps, of which the driver gets one per 32,768 bits."""
    size = 1 << 15
    while size < min(16 * n_keys, most):
        size *= 2
    at = F.col(key).bitwiseAND(F.lit(size - 1)) + 1
    rows = keys.groupBy(F.bitmap_bucket_number(at).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
    table = np.zeros(size // 8, np.uint8)
    for row in rows.collect():
        start = (row["part"] - 1) * 4096
        table[start:start + 4096] = np.frombuffer(row["bits"], np.uint8)
    return table


def has_bit(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether longs may be among the keys of a :func:`bit_table`; always true for those that are."""
    at = keys.view(np.uint64) & np.uint64(8 * len(table) - 1)
    return (table[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
