"""Rows with vectors: which take part, and blocks of them as bytes."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def is_whole(embedding: str) -> Column:
    """Whether a vector is there and holds finite numbers only."""
    return F.coalesce(F.col(embedding).isNotNull() & F.forall(
        embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def stacked(column) -> np.ndarray:
    """The vectors of an Arrow column, all of one length, as rows of doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1 if len(column) and len(column[0]) else 0)


def by_length(batch: pa.RecordBatch, embedding: str):
    """(length, rows of the batch) for each length of its vectors."""
    sizes = batch.column(embedding).value_lengths().to_numpy(zero_copy_only=False)
    for size in np.unique(sizes):
        yield int(size), batch.filter(pa.array(sizes == size))


def to_bytes(values: np.ndarray) -> tuple[str, bytes]:
    """(type, bytes) in the narrowest of a few types that holds ``values`` exactly."""
    for kind in ("<i2", "<i4", "<f4"):
        with np.errstate(invalid="ignore", over="ignore"):
            small = values.astype(kind)
        if (small == values).all():
            return kind, small.tobytes()
    return "<f8", values.astype("<f8").tobytes()


def from_bytes(kind: str, data: bytes, rows: int) -> np.ndarray:
    values = np.frombuffer(data, kind).astype(np.float64)
    return values.reshape(rows, len(values) // max(1, rows))


def grouped_blocks(rows: DataFrame, keys: list[str], size: int) -> DataFrame:
    """``rows(.., row_hash)`` + block: groups of the keys are dealt out in blocks of about ``size`` rows by ``row_hash``.

    Groups are counted with a map-side combine and the counts joined back; the join is split where a group is hot.
    """
    counts = rows.groupBy(*keys).agg(F.count("*").alias("n_rows"))
    return rows.join(counts, keys).withColumn(
        "block", F.pmod("row_hash", F.ceil(F.col("n_rows") / F.lit(size))).cast("int")).drop("n_rows", "row_hash")
