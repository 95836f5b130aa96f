"""The given tables seen as inventories, logs and files."""

import bisect

import pyarrow.parquet as pq
from pyspark.sql import DataFrame, functions as F

import drayage
from drayage.materialize import fresh_dir, fresh_file_root

DOC_KEY = "concat('corpus/', lang, '/', source, '/', doc_id, '.txt')"


def table(spark, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def objects_docs(spark, sf_dir) -> DataFrame:
    return drayage.objects_from_table(table(spark, sf_dir, "documents"), F.expr(DOC_KEY), "text")


def objects_pages(spark, sf_dir) -> DataFrame:
    return drayage.objects_from_table(table(spark, sf_dir, "pages"), "url", "html")


def objects_orders(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.expr("concat('orders/', o_orderkey)").alias("key"),
        F.expr("cast(floor(o_totalprice * 1000) as bigint)").alias("size"))


def attempts(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("chunk_id"), F.col("ts").alias("attempt_ts"),
        F.expr("cast(floor(value * 1000) as bigint)").alias("bytes_read"),
        (F.col("event_type") == "error").alias("failed"))


def executed(events: DataFrame) -> DataFrame:
    return events.where("event_type <> 'error'").select(
        F.col("event_id").alias("chunk_id"), "ts", "event_type",
        F.expr("cast(floor(value * 1000) as bigint)").alias("bytes"))


def initiated(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").where("event_type = 'signup'").select(
        F.col("event_id").alias("upload_id"), F.col("user_id").alias("owner"), F.col("ts").alias("initiated"))


def completed(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").where("event_type = 'purchase'").select(
        F.col("user_id").alias("owner"), F.col("ts").alias("completed"))


def uris(spark, sf_dir) -> DataFrame:
    literals = ["s3://b/k", "s3://b/dir/", "s3://b", "s3://b/", "s3:///k", "s3://b_1/a%20b", "s3://b/a+b"]
    fixed = spark.createDataFrame([(text,) for text in literals], "uri string")
    return table(spark, sf_dir, "pages").select(F.col("url").alias("uri")).unionByName(fixed)


def docs_tree(spark, sf_dir) -> str:
    """The documents as files; returns the root."""
    root = fresh_file_root(spark, "docs")
    drayage.write_objects(objects_docs(spark, sf_dir), root)
    return root


def path_file(spark, sf_dir) -> str:
    """A path list as a text file, with empty lines."""
    path = fresh_dir(spark, "paths")
    docs = table(spark, sf_dir, "documents")
    lines = docs.select(F.expr("concat(lang, '/', source, '/', doc_id)").alias("value"))
    empty = docs.where("lang <> 'en'").select(F.lit("").alias("value"))
    lines.unionByName(empty).write.text(path)
    return path


def fastq_tree(spark, sf_dir) -> str:
    """Two mates per document as FASTQ files ``reads/<source>-<doc_id div 500>.fastq``; returns the root."""
    docs = table(spark, sf_dir, "documents")
    mates = docs.select("doc_id", "source", "text", F.explode(F.array(F.lit("1"), F.lit("2"))).alias("mate"))
    sequence = F.translate(F.md5(F.concat("text", "mate")), "0123456789abcdef", "ACGTACGTACGTACGT")
    quality = F.upper(F.md5(F.concat(F.col("doc_id").cast("string"), "mate")))
    marked = F.when(F.col("doc_id") % 7 == 0, F.concat(F.lit("@"), F.substring(quality, 2, 31))).otherwise(quality)
    record = F.concat(F.lit("@r"), F.col("doc_id").cast("string"), F.lit("/"), F.col("mate"), F.lit("\n"), sequence,
                      F.lit("\n+\n"), marked, F.lit("\n"))
    lane = F.expr("concat('reads/', source, '-', doc_id div 500, '.fastq')")
    files = mates.select(lane.alias("key"), "doc_id", "mate", record.alias("rec")).groupBy("key").agg(
        F.expr("listagg(rec, '') within group (order by doc_id, mate)").alias("body"))
    root = fresh_file_root(spark, "reads")
    drayage.write_objects(files, root)
    return root


def digests(spark, root: str) -> DataFrame:
    """What is stored below a root: key, size, md5."""
    return drayage.file_digests(drayage.list_objects(spark, root, staging=False), root)


class StoredPages:
    """A store that lists pages: a sorted table of keys and sizes, of which a page reads the files it needs."""

    def __init__(self, spark, objects: DataFrame):
        path = fresh_file_root(spark, "store")
        objects.select("key", "size").sort("key").write.mode("append").option("maxRecordsPerFile", 2000).parquet(path)
        first = spark.read.parquet(path).groupBy(F.input_file_name().alias("file")).agg(F.min("key").alias("first"))
        self.files = sorted((row["first"], row["file"].removeprefix("file://")) for row in first.collect())
        self.last = None, None

    def entries(self, file):
        """Entries of a file; those of the last one are kept for the next page."""
        if self.last[0] != file:
            rows = pq.read_table(file)
            self.last = file, list(zip(rows.column("key").to_pylist(), rows.column("size").to_pylist()))
        return self.last[1]

    def page(self, prefix, after, limit):
        low, found = max(prefix, after), []
        at = max(0, bisect.bisect_right([first for first, _ in self.files], low) - 1)
        for _, file in self.files[at:]:
            entries = self.entries(file)
            fit = [(key, size, None) for key, size in entries if key > after and key.startswith(prefix)]
            found += fit[:limit - len(found)]
            end = entries[-1][0]
            if len(found) == limit or end > prefix and not end.startswith(prefix):
                break
        return found
