"""One query per operator. Each reads whole tables; files are derived from them."""

from pyspark.sql import DataFrame, functions as F

import drayage
from drayage.materialize import fresh_dir, fresh_file_root, snapshot

from . import views

CHUNK = 26_214_400
SMALL = 1024
READ_CHUNK = 512
NODES = 5
READ_NODES = 150
PART_SIZE = 400_000
NOW = "2024-01-31 00:00:00"


# --- inventories -----------------------------------------------------------------------------------------------------

def objects_docs(spark, sf_dir) -> DataFrame:
    return views.objects_docs(spark, sf_dir).select("key", "size", "is_marker", F.md5("body").alias("md5"))


def objects_pages(spark, sf_dir) -> DataFrame:
    return views.objects_pages(spark, sf_dir).select("key", "size", "is_marker")


def list_objects(spark, sf_dir) -> DataFrame:
    return drayage.list_objects(spark, views.docs_tree(spark, sf_dir), "corpus/").select("key", "size", "is_marker")


def list_pages(spark, sf_dir) -> DataFrame:
    """Documents as a flat store that lists 50 keys a page."""
    store = views.StoredPages(spark, views.objects_docs(spark, sf_dir))
    return drayage.list_pages(spark, store, "corpus/", page_size=50).select("key", "size", "is_marker")


def head_objects(spark, sf_dir) -> DataFrame:
    docs = views.objects_docs(spark, sf_dir)
    wanted = docs.select("key").unionByName(docs.select(F.replace("key", F.lit(".txt"), F.lit(".bin")).alias("key")))
    return drayage.head_objects(wanted, docs.select("key", "size"))


def path_list(spark, sf_dir) -> DataFrame:
    return drayage.read_path_list(spark, views.path_file(spark, sf_dir))


# --- addresses -------------------------------------------------------------------------------------------------------

def parse_uri(spark, sf_dir) -> DataFrame:
    return drayage.parse_object_uri(views.uris(spark, sf_dir)).select("uri", "bucket", "key", "uri_error")


def prefix_filter(spark, sf_dir) -> DataFrame:
    return drayage.filter_prefix(views.objects_docs(spark, sf_dir), "corpus/en/").select("key", "size", "relative_path")


def download_targets(spark, sf_dir) -> DataFrame:
    docs = views.objects_docs(spark, sf_dir).select("key", "size")
    cases = {"here": ("corpus/en/", "."), "here_top": ("corpus/", "."), "here_all": ("", "."),
             "dir": ("corpus/", "data/out/")}
    parts = [drayage.map_download_targets(docs, prefix, "mybucket", dest).withColumn("case", F.lit(case))
             for case, (prefix, dest) in cases.items()]
    named = parts[0]
    for part in parts[1:]:
        named = named.unionByName(part)
    return named.select("case", "key", "target")


def upload_keys(spark, sf_dir) -> DataFrame:
    paths = views.table(spark, sf_dir, "documents").select(
        F.expr("concat(lang, '/', doc_id, '/', source, '.txt')").alias("source"))
    flat = drayage.map_upload_keys(paths, "in/", "list").withColumn("mode", F.lit("list"))
    deep = drayage.map_upload_keys(paths, "in/", "recursive").withColumn("mode", F.lit("recursive"))
    return flat.unionByName(deep)


def attach_metadata(spark, sf_dir) -> DataFrame:
    plan = drayage.plan_parts(views.objects_docs(spark, sf_dir), SMALL)
    tagged = drayage.attach_metadata(plan, [("project", "a"), ("owner", "lab"), ("project", "b")], True)
    pairs = F.transform(F.map_entries("metadata"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return tagged.select("key", "part_number", F.array_join(F.array_sort(pairs), ";").alias("metadata"),
                         "storage_class")


def bind_targets(spark, sf_dir) -> DataFrame:
    docs = views.objects_docs(spark, sf_dir)
    targets = drayage.map_download_targets(docs, "corpus/en/", "mybucket", "out")
    return drayage.bind_targets(drayage.plan_parts(docs, SMALL), targets).select(
        "key", "part_number", "target", "target_error")


# --- plans -----------------------------------------------------------------------------------------------------------

def classify_transfer(spark, sf_dir) -> DataFrame:
    orders = views.objects_orders(spark, sf_dir)
    down = drayage.classify_transfer(orders, "download", CHUNK).withColumnRenamed("is_multipart", "download_multipart")
    both = drayage.classify_transfer(down, "upload", CHUNK)
    return both.withColumnRenamed("is_multipart", "upload_multipart")


def plan_parts(spark, sf_dir) -> DataFrame:
    return drayage.plan_parts(views.objects_docs(spark, sf_dir), SMALL)


def _orders_plan(spark, sf_dir) -> DataFrame:
    return drayage.build_plan(views.objects_orders(spark, sf_dir), chunk_size=CHUNK)


def build_plan(spark, sf_dir) -> DataFrame:
    """Each order is listed twice, the second time with half of its size."""
    orders = views.objects_orders(spark, sf_dir)
    again = orders.select("key", F.expr("size div 2").alias("size"))
    plan = drayage.build_plan(orders.unionByName(again), chunk_size=CHUNK)
    return plan.select("key", "part_number", "input_offset", "output_offset", "part_size", "n_parts", "is_multipart",
                       "chunk_idx")


def grid_assign(spark, sf_dir) -> DataFrame:
    return drayage.grid_assign(_orders_plan(spark, sf_dir), 7).select("key", "part_number", "chunk_idx", "node")


def grid_slice(spark, sf_dir) -> DataFrame:
    return drayage.grid_slice(_orders_plan(spark, sf_dir), NODES, 3).select("key", "part_number", "chunk_idx")


def split_rebase(spark, sf_dir) -> DataFrame:
    assigned = drayage.grid_assign(_orders_plan(spark, sf_dir), 20_000)
    return drayage.split_rebase(assigned, 20_000).select("key", "node", "part_number", "output_offset", "node_size",
                                                         "node_parts")


def node_summary(spark, sf_dir) -> DataFrame:
    return drayage.node_summary(drayage.grid_assign(_orders_plan(spark, sf_dir), NODES), NODES)


def transfer_summary(spark, sf_dir) -> DataFrame:
    return drayage.transfer_summary(_orders_plan(spark, sf_dir))


def upload_plan(spark, sf_dir) -> DataFrame:
    """Parts of an upload: single below 5 MiB, else multipart, even with one part."""
    plan = drayage.build_plan(views.objects_orders(spark, sf_dir), "upload", CHUNK)
    return plan.select("key", "part_number", "input_offset", "part_size", "n_parts", "is_multipart", "chunk_idx")


def plan_transfer(spark, sf_dir) -> DataFrame:
    docs = views.objects_docs(spark, sf_dir)
    targets = drayage.map_download_targets(docs, "corpus/", "mybucket", ".")
    plan = drayage.plan_transfer(docs, chunk_size=SMALL, n_nodes=NODES, feature="split", targets=targets)
    return plan.select("key", "part_number", "input_offset", "output_offset", "part_size", "chunk_idx", "node",
                       "node_size", "target")


def head_plan(spark, sf_dir) -> DataFrame:
    """Chunks of requested keys, and an error row for each key that isn't there."""
    heads = head_objects(spark, sf_dir)
    planned = drayage.plan_parts(heads, SMALL).select("key", "part_number", "part_size",
                                                      F.lit(None).cast("string").alias("plan_error"))
    errors = drayage.plan_errors(heads, chunk_size=SMALL).select(
        "key", F.lit(None).cast("int").alias("part_number"), F.col("size").alias("part_size"), "plan_error")
    return planned.unionByName(errors)


def slice_summary(spark, sf_dir) -> DataFrame:
    return drayage.transfer_summary(drayage.grid_slice(_orders_plan(spark, sf_dir), NODES, 3))


def grid_bind_targets(spark, sf_dir) -> DataFrame:
    """Three objects with very many chunks; each node binds the targets of its own slice."""
    flags = views.table(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("key")).agg(
        F.sum("l_quantity").cast("bigint").alias("size"))
    plan = snapshot(drayage.build_plan(flags, chunk_size=4, unique_keys=True), "plan")
    targets = flags.select("key", F.concat(F.lit("to/"), "key").alias("target"))
    bound = [drayage.bind_targets(drayage.grid_slice(plan, 3, node), targets).withColumn("node", F.lit(node))
             for node in (1, 2, 3)]
    whole = bound[0].unionByName(bound[1]).unionByName(bound[2])
    return whole.groupBy("key", "node", "target", "target_error").agg(
        F.count("*").alias("n_chunks"), F.min("part_number").alias("first"), F.max("part_number").alias("last"))


def plan_transfer_fastq(spark, sf_dir) -> DataFrame:
    root = views.fastq_tree(spark, sf_dir)
    plan = drayage.plan_transfer(drayage.list_objects(spark, root), chunk_size=READ_CHUNK, n_nodes=READ_NODES,
                                 feature="fastq", unique_keys=True, source=root)
    return plan.select("key", "node", "part_number", "n_parts", "input_offset", "output_offset", "part_size",
                       "node_size")


# --- bytes -----------------------------------------------------------------------------------------------------------

def _ranges(ranges: DataFrame) -> DataFrame:
    return ranges.select("key", "part_number", "input_offset", "bytes_read", "range_header",
                         F.md5(F.hex("body")).alias("hex_md5"))


def read_ranges(spark, sf_dir) -> DataFrame:
    root = views.docs_tree(spark, sf_dir)
    return _ranges(drayage.read_ranges(drayage.plan_parts(drayage.list_objects(spark, root), SMALL), root))


def slice_bodies(spark, sf_dir) -> DataFrame:
    return _ranges(drayage.slice_bodies(views.objects_docs(spark, sf_dir), SMALL))


def complete_manifest(spark, sf_dir) -> DataFrame:
    """The tag of a part is the digest of its bytes; parts below 100 bytes are still without one."""
    parts = drayage.slice_bodies(views.objects_docs(spark, sf_dir), SMALL).select(
        "key", "part_number", "n_parts", F.when(F.col("part_size") >= 100, F.md5(F.hex("body"))).alias("tag"))
    manifest = drayage.complete_manifest(parts)
    tags = F.array_join(F.transform("manifest", lambda m: m["tag"]), ",")
    return manifest.select("key", "n_parts", "n_tagged", "status", tags.alias("tags"))


def reassemble(spark, sf_dir) -> DataFrame:
    parts = drayage.slice_bodies(views.objects_docs(spark, sf_dir), SMALL)
    return drayage.reassemble(parts).select("key", "size", "body_md5")


def reassemble_blocks(spark, sf_dir) -> DataFrame:
    parts = drayage.slice_bodies(views.objects_docs(spark, sf_dir), SMALL)
    return drayage.reassemble_blocks(parts, 4 * SMALL).select("key", "block", "size",
                                                              F.md5(F.hex("body")).alias("hex_md5"))


def object_digests(spark, sf_dir) -> DataFrame:
    parts = drayage.slice_bodies(views.objects_docs(spark, sf_dir), SMALL)
    return drayage.object_digests(parts, fan_in=3)


def verify_transfer(spark, sf_dir) -> DataFrame:
    """Bodies counted in characters, one language not copied, pages that nobody asked for."""
    docs = views.table(spark, sf_dir, "documents")
    key = F.expr(views.DOC_KEY).alias("key")
    copied = docs.where("lang <> 'de'").select(key, F.length("text").cast("bigint").alias("size"))
    pages = views.objects_pages(spark, sf_dir).select("key", "size")
    return drayage.verify_transfer(views.objects_docs(spark, sf_dir), copied.unionByName(pages))


# --- logs ------------------------------------------------------------------------------------------------------------

def attempt_accounting(spark, sf_dir) -> DataFrame:
    return drayage.attempt_accounting(views.attempts(spark, sf_dir), PART_SIZE)


def remaining_ranges(spark, sf_dir) -> DataFrame:
    """Chunks of one large object, one per customer key; users' attempts belong to the chunk of their number."""
    plan = views.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("chunk_id"), ((F.col("c_custkey") - 1) * PART_SIZE).alias("input_offset"),
        F.lit(PART_SIZE).cast("bigint").alias("part_size"))
    return drayage.remaining_ranges(plan, views.attempts(spark, sf_dir), PART_SIZE)


def throughput(spark, sf_dir) -> DataFrame:
    done = views.executed(views.table(spark, sf_dir, "events"))
    whole = drayage.throughput(done).withColumn("event_type", F.lit("all"))
    return drayage.throughput(done, "event_type").unionByName(whole)


def progress_ticks(spark, sf_dir) -> DataFrame:
    done = views.executed(views.table(spark, sf_dir, "events"))
    return _days(drayage.progress_ticks(done, "1 day"))


def progress_ticks_stream(spark, sf_dir) -> DataFrame:
    events = views.table(spark, sf_dir, "events")
    stream = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    ticks = fresh_dir(spark, "ticks")
    drayage.run_progress_stream(views.executed(stream), "1 day", ticks, fresh_dir(spark, "ticks-state")
                                ).awaitTermination()
    return _days(drayage.cumulate(spark.read.parquet(ticks)))


def _days(ticks: DataFrame) -> DataFrame:
    return ticks.withColumn("tick_start", F.date_format("tick_start", "yyyy-MM-dd HH:mm:ss"))


def incomplete_uploads(spark, sf_dir) -> DataFrame:
    open_ones = drayage.incomplete_uploads(views.initiated(spark, sf_dir), views.completed(spark, sf_dir))
    return open_ones.select("upload_id", "owner", F.date_format("initiated", "yyyy-MM-dd HH:mm:ss").alias("initiated"))


def stale_uploads(spark, sf_dir) -> DataFrame:
    uploads = views.initiated(spark, sf_dir).withColumn("key", F.expr("concat('up/', owner)"))
    return drayage.stale_uploads(uploads, NOW)


# --- records ---------------------------------------------------------------------------------------------------------

def _reads(spark, sf_dir):
    root = views.fastq_tree(spark, sf_dir)
    objects = drayage.list_objects(spark, root)
    records = drayage.read_fastq_objects(objects, root, chunk_size=2_000)
    assigned = drayage.grid_assign(drayage.build_plan(objects, chunk_size=READ_CHUNK, unique_keys=True), READ_NODES)
    return root, records, assigned


def read_fastq(spark, sf_dir) -> DataFrame:
    return _reads(spark, sf_dir)[1]


def fastq_boundaries(spark, sf_dir) -> DataFrame:
    _, records, assigned = _reads(spark, sf_dir)
    return drayage.fastq_boundaries(records, assigned, READ_CHUNK)


def locate_boundaries(spark, sf_dir) -> DataFrame:
    root = views.fastq_tree(spark, sf_dir)
    objects = drayage.list_objects(spark, root)
    assigned = drayage.grid_assign(drayage.build_plan(objects, chunk_size=READ_CHUNK, unique_keys=True), READ_NODES)
    return drayage.locate_boundaries(objects, assigned, root, READ_CHUNK)


def fastq_split(spark, sf_dir) -> DataFrame:
    _, records, assigned = _reads(spark, sf_dir)
    boundaries = drayage.fastq_boundaries(records, assigned, READ_CHUNK)
    return drayage.fastq_split(records, boundaries).select("key", "rec_no", "start_offset", "read_id", "mate", "node")


def pair_mates(spark, sf_dir) -> DataFrame:
    """Second mates of documents with a quality line that starts with '@' are taken away."""
    records = _reads(spark, sf_dir)[1]
    kept = records.where("not (mate = '2' and qual like '@%')")
    return drayage.pair_mates(kept)


# --- copies ----------------------------------------------------------------------------------------------------------

def copy_objects(spark, sf_dir) -> DataFrame:
    root, dest = views.docs_tree(spark, sf_dir), fresh_file_root(spark, "copies")
    objects = drayage.list_objects(spark, root)
    targets = drayage.map_download_targets(objects, "corpus/", "mybucket", "mirror")
    drayage.copy_objects(objects, targets, root, dest, on_failure="fail")
    return views.digests(spark, dest)


def copy_conflicts(spark, sf_dir) -> DataFrame:
    """Documents of a language that follow each other have targets at one path, in two spellings."""
    root, dest = views.docs_tree(spark, sf_dir), fresh_file_root(spark, "copies")
    number = F.regexp_extract("key", r"(\d+)\.txt$", 1).cast("bigint")
    targets = drayage.list_objects(spark, root).select("key", "size", F.concat(
        F.when(number % 2 == 1, "t//").otherwise("t/"), F.split("key", "/")[1], F.lit("/"),
        (number - number % 2).cast("string")).alias("target"))
    return drayage.copy_objects(targets, targets, root, dest).select("key", "target", "bytes", "status", "error")


def copy_multipart(spark, sf_dir) -> DataFrame:
    root, dest = views.docs_tree(spark, sf_dir), fresh_file_root(spark, "copies")
    objects = drayage.list_objects(spark, root)
    plan = drayage.build_plan(objects, chunk_size=SMALL, unique_keys=True)
    targets = drayage.map_download_targets(objects, "corpus/", "mybucket", "mirror")
    drayage.copy_multipart(plan, targets, root, dest, on_failure="fail")
    return views.digests(spark, dest)


def copy_parts_store(spark, sf_dir) -> DataFrame:
    """Chunks become objects of their own, which are put together three at a time."""
    root, dest = views.docs_tree(spark, sf_dir), fresh_file_root(spark, "copies")
    objects = drayage.list_objects(spark, root)
    plan = drayage.build_plan(objects, chunk_size=SMALL, unique_keys=True)
    targets = drayage.map_download_targets(objects, "corpus/", "mybucket", "mirror")
    drayage.copy_parts(plan, targets, root, dest, on_failure="fail", fan_in=3)
    return snapshot(views.digests(spark, dest), "digests")


def copy_plan(spark, sf_dir) -> DataFrame:
    """Documents above one chunk are copied by chunk, the others whole."""
    root, dest = views.docs_tree(spark, sf_dir), fresh_file_root(spark, "copies")
    objects = drayage.list_objects(spark, root)
    plan = drayage.build_plan(objects, chunk_size=SMALL, unique_keys=True)
    targets = drayage.map_download_targets(objects, "corpus/", "mybucket", "mirror")
    drayage.copy_plan(plan, targets, root, dest, on_failure="fail")
    return views.digests(spark, dest)


def progress_of_copy(spark, sf_dir) -> DataFrame:
    """What a stream counts of a copy that leaves its status rows while it runs, summed over the ticks."""
    root, dest, status = (views.docs_tree(spark, sf_dir), fresh_file_root(spark, "copies"), fresh_file_root(spark, "status"))
    objects = drayage.list_objects(spark, root)
    plan = drayage.build_plan(objects, chunk_size=SMALL, unique_keys=True)
    targets = drayage.map_download_targets(objects, "corpus/", "mybucket", "mirror")
    chunks = drayage.running_copy(spark, status)
    drayage.copy_multipart(plan, targets, root, dest, on_failure="fail", status_root=status)
    ticks = fresh_dir(spark, "ticks")
    drayage.run_progress_stream(chunks, "1 second", ticks, fresh_dir(spark, "ticks-state")).awaitTermination()
    return spark.read.parquet(ticks).agg(F.coalesce(F.sum("n_bytes"), F.lit(0)).cast("bigint").alias("n_bytes"),
                                         F.coalesce(F.sum("n_chunks"), F.lit(0)).cast("bigint").alias("n_chunks"))


def grid_copy(spark, sf_dir) -> DataFrame:
    """Three nodes copy their slices of the plan into one shared tree; the targets appear when all are done."""
    root, dest = views.docs_tree(spark, sf_dir), fresh_file_root(spark, "copies")
    objects = drayage.list_objects(spark, root)
    plan = snapshot(drayage.build_plan(objects, chunk_size=SMALL, unique_keys=True), "plan")
    targets = drayage.map_download_targets(objects, "corpus/", "mybucket", "mirror")
    parts = [drayage.copy_multipart(drayage.grid_slice(plan, 3, node), targets, root, dest, "grid").parts
             for node in (1, 2, 3)]
    drayage.publish_copies(parts[0].unionByName(parts[1]).unionByName(parts[2]), dest)
    return views.digests(spark, dest)


def clean_parts(spark, sf_dir) -> DataFrame:
    """All last parts of multipart copies are held back; eight days later the unfinished copies are removed."""
    root, dest = views.docs_tree(spark, sf_dir), fresh_file_root(spark, "copies")
    objects = drayage.list_objects(spark, root)
    plan = drayage.build_plan(objects, chunk_size=SMALL, unique_keys=True).where("part_number < n_parts or n_parts = 1")
    targets = drayage.map_download_targets(objects, "corpus/", "mybucket", "mirror")
    drayage.copy_multipart(plan, targets, root, dest, "stopped")
    stale = drayage.stale_uploads(drayage.list_uploads(spark, dest), F.current_timestamp() + F.expr("interval 8 days"))
    return drayage.clean_parts(stale, dest, dry_run=False).select("upload_id", "action")


def write_split(spark, sf_dir) -> DataFrame:
    root, dest = views.docs_tree(spark, sf_dir), fresh_file_root(spark, "slices")
    plan = drayage.build_plan(drayage.list_objects(spark, root), chunk_size=SMALL, unique_keys=True)
    drayage.write_split(drayage.grid_assign(plan, NODES), NODES, root, dest, on_failure="fail")
    return views.digests(spark, dest)


def write_fastq_split(spark, sf_dir) -> DataFrame:
    root, records, assigned = _reads(spark, sf_dir)
    boundaries = drayage.fastq_boundaries(records, assigned, READ_CHUNK)
    dest = fresh_file_root(spark, "slices")
    drayage.write_split(assigned, READ_NODES, root, dest, boundaries, READ_CHUNK, on_failure="fail")
    return views.digests(spark, dest)


def incremental_copy(spark, sf_dir) -> DataFrame:
    """The documents arrive in two lots, each followed by a run with the same checkpoint; a third run finds nothing."""
    source, dest = fresh_file_root(spark, "arrivals"), fresh_file_root(spark, "copies")
    checkpoint = fresh_file_root(spark, "incremental")
    docs = views.objects_docs(spark, sf_dir)
    for lot in ("key like 'corpus/en/%'", "key not like 'corpus/en/%'", None):
        if lot:
            drayage.write_objects(docs.where(lot), source)
        copied = drayage.incremental_copy(spark, source, dest, checkpoint)
    return _copied_once(spark, dest, copied)


def copy_new(spark, sf_dir) -> DataFrame:
    """The same two lots, found by comparing the inventory with the ledger."""
    source, dest = fresh_file_root(spark, "arrivals"), fresh_file_root(spark, "copies")
    checkpoint = fresh_file_root(spark, "incremental")
    docs = views.objects_docs(spark, sf_dir)
    for lot in ("key like 'corpus/en/%'", "key not like 'corpus/en/%'"):
        drayage.write_objects(docs.where(lot), source)
        copied = drayage.copy_new(spark, source, dest, checkpoint)
    return _copied_once(spark, dest, copied)


def _copied_once(spark, dest, copied) -> DataFrame:
    stored = views.digests(spark, dest)
    times = copied.groupBy("key").agg(F.count("*").alias("n_copies"))
    return stored.join(times, "key", "full").select("key", "size", "md5", "n_copies")


QUERIES = {query.__name__: query for query in (
    objects_docs, objects_pages, list_objects, list_pages, head_objects, path_list, parse_uri, prefix_filter, download_targets,
    upload_keys, attach_metadata, bind_targets, classify_transfer, plan_parts, build_plan, grid_assign, grid_slice,
    split_rebase, node_summary, transfer_summary, slice_summary, grid_bind_targets, head_plan, upload_plan,
    plan_transfer, plan_transfer_fastq, read_ranges, slice_bodies, reassemble_blocks, copy_conflicts,
    complete_manifest, reassemble, object_digests, verify_transfer, attempt_accounting, remaining_ranges, throughput, progress_ticks,
    progress_ticks_stream, incomplete_uploads, stale_uploads, read_fastq, fastq_boundaries, locate_boundaries,
    fastq_split, pair_mates, copy_objects, copy_multipart, copy_parts_store, copy_plan, progress_of_copy, grid_copy, clean_parts, write_split,
    write_fastq_split, incremental_copy, copy_new)}
