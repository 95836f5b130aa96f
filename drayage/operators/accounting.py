"""Summaries, retry bookkeeping, manifests and checks of executed plans."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import format_bytes, int_div
from ..materialize import snapshot
from ..plans.indexing import unique_objects
from ..settings import MAX_RESPONSES_PER_TRY, MAX_TRIES, MAX_UPLOAD_PARTS

MAX_REASSEMBLED_BYTES = 1 << 30
REASSEMBLED_BLOCK = 64 << 20
DIGEST_FAN_IN = 1_000


def transfer_summary(plan: DataFrame) -> DataFrame:
    """One row: total_bytes, n_objects, n_chunks, n_singles, n_multiparts, total_text.

    Chunks are summed per key first, on the map side, so a slice counts the objects it has any chunk of.
    """
    per_key = plan.groupBy("key").agg(F.sum("part_size").alias("n_bytes"), F.count("*").alias("n"),
                                      F.max("is_multipart").alias("is_multipart"))
    zero = F.lit(0).cast("bigint")
    summed = per_key.agg(F.coalesce(F.sum("n_bytes"), zero).alias("total_bytes"), F.count("*").alias("n_objects"),
                         F.coalesce(F.sum("n"), zero).alias("n_chunks"),
                         F.count(F.when(~F.col("is_multipart"), 1)).alias("n_singles"),
                         F.count(F.when(F.col("is_multipart"), 1)).alias("n_multiparts"))
    return summed.withColumn("total_text", format_bytes(F.col("total_bytes")))


def node_summary(assigned: DataFrame, n_nodes: int) -> DataFrame:
    """One row per node, also for nodes without chunks.

    node, n_chunks, n_bytes, first_idx, last_idx, estimated_bytes (total div N), deviation, skew (bytes over the mean).
    """
    spark = assigned.sparkSession
    per_node = assigned.groupBy("node").agg(F.count("*").alias("n_chunks"), F.sum("part_size").alias("n_bytes"),
                                            F.min("chunk_idx").alias("first_idx"),
                                            F.max("chunk_idx").alias("last_idx"))
    nodes = spark.range(1, n_nodes + 1).select(F.col("id").cast("int").alias("node"))
    zero = F.lit(0).cast("bigint")
    filled = nodes.join(per_node, "node", "left").select(
        "node", F.coalesce("n_chunks", zero).alias("n_chunks"), F.coalesce("n_bytes", zero).alias("n_bytes"),
        "first_idx", "last_idx")
    # The window runs over one row per node, not over the plan.
    total = F.sum("n_bytes").over(Window.partitionBy())
    return (filled.withColumn("estimated_bytes", int_div(total, F.lit(n_nodes).cast("bigint")))
            .withColumn("deviation", F.col("n_bytes") - F.col("estimated_bytes"))
            .withColumn("skew", F.when(total > 0, F.col("n_bytes") * F.lit(n_nodes) / total)))


def attempt_accounting(attempts: DataFrame, part_size, on: str = "chunk_id") -> DataFrame:
    """Retry bookkeeping per chunk from a log of (chunk, attempt_ts, bytes_read, failed).

    An incomplete response is resumed, up to 10 responses per try. A failed response, or the tenth incomplete one,
    ends the try and the next starts from byte 0; there are 6 tries. ``part_size`` is a number or a column.

    Result: status ``done``/``failed``/``pending``, tries, responses, bytes_fetched, bytes_wasted, bytes_in_place.

    Only the first 60 responses of a chunk can belong to its 6 tries. That limit is a row_number filter, which Spark
    also applies before the shuffle, so a chunk with a huge log costs 60 rows per task. Everything after it works on
    one partitioning and one sort order.
    """
    size = part_size if isinstance(part_size, Column) else F.lit(part_size).cast("bigint")
    log = attempts.select(on, "attempt_ts", F.coalesce("failed", F.lit(False)).alias("failed"),
                          F.coalesce(F.col("bytes_read").cast("bigint"), F.lit(0)).alias("bytes_read"),
                          size.alias("part_size"))
    in_order = Window.partitionBy(on).orderBy("attempt_ts", "failed", "bytes_read")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)

    rows = log.withColumn("rn", F.row_number().over(in_order)).where(F.col("rn") <= MAX_TRIES * MAX_RESPONSES_PER_TRY)
    rows = (rows
            .withColumn("got", F.when(F.col("failed"), 0).otherwise(F.col("bytes_read")))
            .withColumn("last_failure", F.coalesce(F.max(F.when(F.col("failed"), F.col("rn"))).over(before), F.lit(0)))
            .withColumn("total", F.sum("got").over(so_far))
            .withColumn("opens", (F.col("rn") - F.col("last_failure") - 1) % MAX_RESPONSES_PER_TRY == 0))
    rows = (rows
            .withColumn("try", F.sum(F.col("opens").cast("int")).over(so_far))
            .withColumn("base", F.max(F.when(F.col("opens"), F.col("total") - F.col("got"))).over(so_far))
            .withColumn("in_try", F.col("total") - F.col("base"))
            .withColumn("completes", ~F.col("failed") & (F.col("in_try") >= F.col("part_size"))))
    rows = (rows.where(F.col("try") <= MAX_TRIES)
            .withColumn("completed", F.coalesce(F.max("completes").over(before), F.lit(False)))
            .where(~F.col("completed")))

    tries = (rows.groupBy(on, "try")
             .agg(F.count("*").alias("n"), F.least(F.max("in_try"), F.max("part_size")).alias("fetched"),
                  F.max("failed").alias("has_failure"), F.max("completes").alias("done")))
    tries = tries.withColumn(
        "lost", ~F.col("done") & (F.col("has_failure") | (F.col("n") == MAX_RESPONSES_PER_TRY)))
    status = (F.when(F.max("done"), "done")
              .when(F.max(F.col("lost") & (F.col("try") == MAX_TRIES)), "failed").otherwise("pending"))
    zero = F.lit(0).cast("bigint")
    return tries.groupBy(on).agg(
        status.alias("status"), F.max("try").cast("int").alias("tries"), F.sum("n").alias("responses"),
        F.sum("fetched").alias("bytes_fetched"),
        F.coalesce(F.sum(F.when(F.col("lost"), F.col("fetched"))), zero).alias("bytes_wasted"),
        F.coalesce(F.sum(F.when(~F.col("lost"), F.col("fetched"))), zero).alias("bytes_in_place"))


def throughput(executed: DataFrame, *group) -> DataFrame:
    """Bytes over whole seconds from the first to the last ``ts``: n_bytes, seconds, bytes_per_second, speed_text.

    Where rows know when they ``started``, the time runs from the first start. Below one second the speed is null and
    its text ``unknown``.
    """
    first = F.min("started") if "started" in executed.columns else F.min("ts")
    summed = executed.groupBy(*group).agg(F.coalesce(F.sum("bytes"), F.lit(0).cast("bigint")).alias("n_bytes"),
                                          first.alias("_first"), F.max("ts").alias("_last"))
    millis = (F.unix_millis(F.col("_last").cast("timestamp")) - F.unix_millis(F.col("_first").cast("timestamp")))
    seconds = F.coalesce(int_div(millis, F.lit(1000).cast("bigint")), F.lit(0).cast("bigint"))
    timed = summed.withColumn("seconds", seconds)
    speed = F.when(F.col("seconds") > 0, int_div(F.col("n_bytes"), F.greatest("seconds", F.lit(1).cast("bigint"))))
    return (timed.withColumn("bytes_per_second", speed)
            .withColumn("speed_text", F.coalesce(format_bytes(F.col("bytes_per_second"), "/s"), F.lit("unknown")))
            .drop("_first", "_last"))


def complete_manifest(parts: DataFrame) -> DataFrame:
    """Tags of each multipart object in part order: key, n_parts, n_tagged, status, manifest array.

    ``complete`` means that each of the parts 1..n has a tag; otherwise ``incomplete``. A part that was sent more than
    once counts once. The array is null above the parts an upload may have: such objects have their tags in
    :func:`manifest_parts`, and are counted here like all others.
    """
    one_each = manifest_parts(parts)
    listed = F.col("n_parts") <= MAX_UPLOAD_PARTS
    tagged = F.when(listed & F.col("tag").isNotNull(), F.struct("part_number", "tag"))
    expected = F.col("part_number").between(F.lit(1), F.col("n_parts")) & F.col("tag").isNotNull()
    manifest = one_each.groupBy("key").agg(F.max("n_parts").alias("n_parts"),
                                           F.count(F.when(expected, 1)).alias("n_tagged"),
                                           F.array_sort(F.collect_list(tagged)).alias("manifest"))
    done = F.when(F.col("n_tagged") == F.col("n_parts"), "complete").otherwise("incomplete")
    return manifest.select("key", "n_parts", "n_tagged", done.alias("status"), F.when(listed, F.col("manifest")).alias("manifest"))


def manifest_parts(parts: DataFrame) -> DataFrame:
    """One row per part, for objects of any number of parts: key, part_number, n_parts, tag (null while it isn't sent)."""
    return parts.groupBy("key", "part_number").agg(F.max("n_parts").alias("n_parts"), F.max("tag").alias("tag"))


def reassemble(parts: DataFrame) -> DataFrame:
    """Bodies put together by output offset: key, size, body, body_md5.

    For objects that fit a table cell. Above 1 GiB body and digest are null; :func:`reassemble_blocks` has these objects.
    """
    fits = F.col("object_size") <= MAX_REASSEMBLED_BYTES
    whole = parts.withColumn("body", F.when(fits, F.col("body"))).groupBy("key").agg(
        F.expr("listagg(body, X'') WITHIN GROUP (ORDER BY output_offset)").alias("body"),
        F.max("object_size").alias("size"))
    body = F.when(F.col("size") <= MAX_REASSEMBLED_BYTES, F.coalesce("body", F.lit(b"")))
    size = F.coalesce(F.octet_length(body).cast("bigint"), F.col("size"))
    return whole.select("key", size.alias("size"), body.alias("body"), F.md5(body).alias("body_md5"))


def reassemble_blocks(parts: DataFrame, block_size: int = REASSEMBLED_BLOCK) -> DataFrame:
    """Bodies of any size as blocks of whole parts, in order: key, block (from 0), size, body, body_md5.

    A block holds the parts that start in it, so neither a row nor a group grows with the object.
    """
    block = int_div(F.col("output_offset"), F.lit(block_size).cast("bigint"))
    whole = parts.groupBy("key", block.alias("block")).agg(
        F.expr("listagg(body, X'') WITHIN GROUP (ORDER BY output_offset)").alias("body"))
    body = F.coalesce("body", F.lit(b""))
    return whole.select("key", "block", F.octet_length(body).cast("bigint").alias("size"), body.alias("body"),
                        F.md5(body).alias("body_md5"))


def object_digests(parts: DataFrame, fan_in: int = DIGEST_FAN_IN) -> DataFrame:
    """Digest of objects of any size, from their parts: key, size, n_parts, status, tree_digest.

    The leaves of a tree are the md5 of the bodies in part order. While an object has more than one node, each ``fan_in``
    neighbours, and what is left at the end, become one: the md5 of their digests in hexadecimal digits, one after the other. The
    last node is the digest, so an object of one part has the md5 of its body. It depends on the chunk size and on
    ``fan_in``. An object with a part missing is ``incomplete`` and has none. Of a part that comes more than once one body counts,
    the one with the greatest digest.

    Bodies are hashed where they are and only digests are shuffled; a group has ``fan_in`` of them at most.
    """
    if fan_in < 2:
        raise ValueError("a node of the tree has two children at least")
    md5 = F.md5(F.coalesce(F.col("body").cast("binary"), F.lit(b"")))
    hashed = parts.select("key", (F.col("part_number") - 1).cast("bigint").alias("number"), "n_parts", "object_size", md5.alias("digest"))
    leaves = hashed.groupBy("key", "number").agg(F.max("digest").alias("digest"), F.max("n_parts").cast("bigint").alias("n_nodes"),
                                                 F.max("n_parts").alias("n_parts"), F.max("object_size").alias("size"))
    nodes = snapshot(leaves, "digests")
    most, wide = nodes.agg(F.max("n_parts")).first()[0] or 0, F.lit(fan_in).cast("bigint")
    while most > 1:
        group = int_div(F.col("number"), wide)
        ordered = F.array_sort(F.collect_list(F.struct("number", "digest")))
        grouped = nodes.groupBy("key", group.alias("number")).agg(
            ordered.alias("children"), F.max("n_nodes").alias("below"), F.max("n_parts").alias("n_parts"), F.max("size").alias("size"))
        wanted = F.least(wide, F.col("below") - F.col("number") * wide)
        known = F.filter("children", lambda child: child["digest"].isNotNull())
        joined = F.md5(F.array_join(F.transform("children", lambda child: child["digest"]), "").cast("binary"))
        digest = F.when(F.col("below") == 1, F.get(F.col("children"), F.lit(0))["digest"]).when(F.size(known) == wanted, joined)
        nodes = grouped.select("key", "number", digest.alias("digest"), int_div(F.col("below") + (fan_in - 1), wide).alias("n_nodes"),
                               "n_parts", "size")
        most = -(-most // fan_in)
    status = F.when(F.col("digest").isNull(), "incomplete").otherwise("complete")
    # A lone leaf that isn't the first is of an object with parts missing, and so is without a digest by now.
    return nodes.where("number = 0").select("key", "size", "n_parts", status.alias("status"), F.col("digest").alias("tree_digest"))


def verify_transfer(source: DataFrame, copied: DataFrame) -> DataFrame:
    """Expected and copied bytes per key: key, expected, actual, status.

    Of repeated keys the latest listing counts, as in plans. ``ok``, ``interrupted`` (sizes differ), ``missing`` (not copied) or ``extra`` (not in the source).
    """
    expected = unique_objects(source).withColumnRenamed("size", "expected")
    actual = unique_objects(copied).withColumnRenamed("size", "actual")
    status = (F.when(F.col("expected").isNull(), "extra").when(F.col("actual").isNull(), "missing")
              .when(F.col("expected") != F.col("actual"), "interrupted").otherwise("ok"))
    return expected.join(actual, "key", "full").select("key", "expected", "actual", status.alias("status"))
