"""Record-aligned splits of FASTQ files and mate pairs."""

import functools

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import int_div
from ..materialize import broadcast_if_bounded, snapshot
from ..plans.chunking import plan_parts
from ..settings import effective_chunk_size
from ..sources.fastq import line_positions, parse_records


def fastq_boundaries(records: DataFrame, assigned: DataFrame, chunk_size=None) -> DataFrame:
    """Byte range of each node that has chunks of a key: key, node, start, end.

    A node starts at the latest record before its first chunk that isn't a second mate; the first node starts at 0,
    and each node ends where the next one starts. Ranges may be empty. ``chunk_size`` is that of the plan.

    Records shrink to one candidate per chunk on the map side. Only rows per chunk are joined, and only rows per node
    are ordered.
    """
    chunk = effective_chunk_size(chunk_size)
    return _ranges_of_nodes(_last_starts(records, chunk), assigned, chunk)


def _last_starts(records: DataFrame, chunk: int) -> DataFrame:
    """Latest start per chunk of a record that isn't a second mate: key, part_number, candidate."""
    part = (int_div(F.col("start_offset"), F.lit(chunk).cast("bigint")) + 1).cast("int")
    return (records.where(~F.col("mate").eqNullSafe("2"))
            .groupBy("key", part.alias("part_number")).agg(F.max("start_offset").alias("candidate")))


def _ranges_of_nodes(candidates: DataFrame, assigned: DataFrame, chunk: int) -> DataFrame:
    candidates = candidates.groupBy("key", "part_number").agg(F.max("candidate").alias("candidate"))
    misaligned = F.raise_error(F.lit("chunk_size isn't that of the plan"))
    chunks = assigned.select("key", "node", "object_size", F.when(
        F.col("input_offset") == (F.col("part_number") - 1).cast("bigint") * chunk, F.col("part_number"))
        .otherwise(misaligned.cast("int")).alias("part_number"))
    per_node = (chunks.join(candidates, ["key", "part_number"], "left")
                .groupBy("key", "node").agg(F.max("candidate").alias("candidate"),
                                            F.max("object_size").alias("object_size")))
    in_key = Window.partitionBy("key").orderBy("node")
    before = in_key.rowsBetween(Window.unboundedPreceding, -1)
    starts = per_node.withColumn("start", F.coalesce(F.max("candidate").over(before), F.lit(0).cast("bigint")))
    return starts.select("key", "node", "start",
                         F.coalesce(F.lead("start").over(in_key), F.col("object_size")).alias("end"))


def locate_boundaries(objects: DataFrame, assigned: DataFrame, source, chunk_size=None,
                      positions: DataFrame = None) -> DataFrame:
    """:func:`fastq_boundaries` straight from files: counts all lines, but parses only chunks before a node's start.

    Where the chunk before a start holds no usable record start (it is inside a very long record), twice as many chunks
    before it are searched, and so on, so the result is that of parsing everything. ``chunk_size`` is that of the plan.
    ``positions`` of an earlier :func:`line_positions` with this chunk size save the count.
    """
    chunk = effective_chunk_size(chunk_size)
    positions = line_positions(objects, source, chunk) if positions is None else positions
    firsts = assigned.groupBy("key", "node").agg(F.min("part_number").alias("first"))
    wanted = snapshot(firsts.where(F.col("first") > 1).select("key", (F.col("first") - 1).alias("upto")), "node-starts")
    found, width = [], 1
    while not found or not wanted.isEmpty():
        low = F.greatest(F.lit(1), F.col("upto") - (width - 1))
        searched = wanted.select("key", "upto", F.explode(F.sequence(low, F.col("upto"))).alias("part_number"))
        near = positions.join(searched, ["key", "part_number"], "left_semi")
        latest = snapshot(_last_starts(parse_records(near, source, lines=()), chunk), "record-starts")
        found.append(latest)
        hits = searched.join(latest, ["key", "part_number"], "left_semi").select("key", "upto")
        missed = wanted.join(hits, ["key", "upto"], "left_anti").where(F.col("upto") > width)
        wanted = snapshot(missed.select("key", (F.col("upto") - width).alias("upto")).distinct(), "record-search")
        width *= 2
    return _ranges_of_nodes(functools.reduce(DataFrame.unionByName, found), assigned, chunk)


def aligned_parts(boundaries: DataFrame, chunk_size=None) -> DataFrame:
    """Chunks of the record-aligned ranges of nodes: key, node, part_number, node_parts, input_offset, output_offset (in
    the file of the node), part_size, node_size. Empty ranges have none."""
    ranges = boundaries.where(F.col("end") > F.col("start"))
    keyed = ranges.select(F.struct("key", "node", "start", "end").alias("key"),
                          (F.col("end") - F.col("start")).alias("size"))
    parts = plan_parts(keyed, chunk_size, F.col("key.start"))
    return parts.select("key.key", "key.node", "part_number", F.col("n_parts").alias("node_parts"), "input_offset",
                        (F.col("output_offset") - F.col("key.start")).alias("output_offset"), "part_size",
                        (F.col("key.end") - F.col("key.start")).alias("node_size"))


def fastq_split(records: DataFrame, boundaries: DataFrame) -> DataFrame:
    """``records`` + node: the node in whose aligned range the record starts; null for files without nodes.

    Ranges are cut at multiples of their mean size, which makes three pieces per range at most, however large the files
    are. A record meets the pieces between its two multiples, one to three where ranges are about equal. The pieces are
    broadcast if they are counted to be few; else both sides are shuffled by key and multiple, which also cuts a file that holds
    most of the records.
    """
    ranges = snapshot(boundaries.where(F.col("end") > F.col("start")).select("key", "start", "end", "node"), "node-ranges")
    width = F.lit(int(ranges.agg(F.avg(F.col("end") - F.col("start"))).first()[0] or 0) + 1).cast("bigint")
    pieces = F.sequence(int_div(F.col("start"), width), int_div(F.col("end") - 1, width))
    cut = ranges.select(F.col("key").alias("_key"), F.col("start").alias("_start"), F.col("end").alias("_end"), "node",
                        F.explode(pieces).alias("_piece"))
    near = broadcast_if_bounded(snapshot(cut, "node-pieces"))
    at = F.col("start_offset")
    inside = ((F.col("key") == F.col("_key")) & (int_div(at, width) == F.col("_piece"))
              & (F.col("_start") <= at) & (at < F.col("_end")))
    return records.join(near, inside, "left").drop("_key", "_piece", "_start", "_end")


def pair_mates(records: DataFrame) -> DataFrame:
    """Mates by read id within a file: key, read_id, r1, r2 (start offsets), status.

    ``paired``, ``orphan_1``, ``orphan_2`` or ``unpaired`` (no mate mark). Text lines aren't needed: records read with
    ``lines=()`` will do.
    """
    def start(mate):
        return F.max(F.when(F.col("mate") == mate, F.col("start_offset")))

    pairs = records.groupBy("key", "read_id").agg(start("1").alias("r1"), start("2").alias("r2"))
    status = (F.when(F.col("r1").isNotNull() & F.col("r2").isNotNull(), "paired")
              .when(F.col("r1").isNotNull(), "orphan_1").when(F.col("r2").isNotNull(), "orphan_2")
              .otherwise("unpaired"))
    return pairs.withColumn("status", status)
