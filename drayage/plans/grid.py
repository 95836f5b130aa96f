"""Balanced assignment of an indexed plan to nodes."""

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import ceil_div, int_div


def _check_nodes(n_nodes: int):
    if n_nodes < 1:
        raise ValueError("at least one node is needed")


def slice_start(n_chunks: Column, n_nodes: int, node: Column) -> Column:
    """First chunk index of a node; the start of the next node is its end."""
    return ceil_div(n_chunks * (node - 1), F.lit(n_nodes).cast("bigint"))


def grid_assign(plan: DataFrame, n_nodes: int) -> DataFrame:
    """``plan`` + ``node`` (1-based): slices of the chunk list whose lengths differ by one at most.

    A projection on a complete plan. A plan without ``n_chunks`` gets its length from a scalar subquery.
    """
    _check_nodes(n_nodes)
    if "n_chunks" in plan.columns:
        length = F.col("n_chunks")
    else:
        length = plan.agg(F.count("*")).scalar()
    node = int_div(F.col("chunk_idx") * F.lit(n_nodes).cast("bigint"), length) + 1
    return plan.withColumn("node", node.cast("int"))


def grid_slice(plan: DataFrame, n_nodes: int, node: int) -> DataFrame:
    """Chunks of one node, as a range of chunk indexes that reaches the scan of a stored plan."""
    _check_nodes(n_nodes)
    if not 1 <= node <= n_nodes:
        raise ValueError(f"node is 1..{n_nodes}, not {node}")
    head = plan.select("n_chunks").head(1)
    length = head[0]["n_chunks"] if head else 0
    first = -(-length * (node - 1) // n_nodes)
    end = -(-length * node // n_nodes)
    return plan.where((F.col("chunk_idx") >= first) & (F.col("chunk_idx") < end))


def split_rebase(assigned: DataFrame, n_nodes: int, base_offset: int = 0) -> DataFrame:
    """Offsets in the smaller file each node writes for a key: ``node_size``, ``node_parts``, new ``output_offset``.

    The slice of a node and the parts of a key are both ranges of chunk indexes, so the first byte and the length of
    their intersection follow from the columns of the row itself. It needs the assignment of a complete plan; nothing
    is grouped or shuffled, even if one object holds most of the chunks.
    """
    _check_nodes(n_nodes)
    part, n_parts, length = F.col("part_number"), F.col("n_parts"), F.col("n_chunks")
    key_first = F.col("chunk_idx") - part + 1
    node = F.col("node").cast("bigint")
    first = F.greatest(key_first, slice_start(length, n_nodes, node)) - key_first
    end = F.least(key_first + n_parts, slice_start(length, n_nodes, node + 1)) - key_first
    chunk = (F.when(n_parts == 1, F.col("object_size"))
             .when(part == 1, F.col("part_size"))
             .otherwise(int_div(F.col("input_offset") - base_offset, F.greatest(part - 1, F.lit(1)).cast("bigint"))))
    with_slice = assigned.withColumns({"_start": first * chunk, "_parts": end - first,
                                       "_end": F.least(F.col("object_size"), end * chunk)})
    return (with_slice
            .withColumns({"output_offset": F.col("input_offset") - base_offset - F.col("_start"),
                          "node_size": F.col("_end") - F.col("_start"),
                          "node_parts": F.col("_parts").cast("int")})
            .drop("_start", "_end", "_parts"))
