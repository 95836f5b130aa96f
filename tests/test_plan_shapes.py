"""What the physical plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
import drayage
from catalog import queries as catalog_queries, views
from drayage.materialize import snapshot

FILES = {"list_objects", "read_ranges", "read_fastq", "fastq_boundaries", "locate_boundaries", "fastq_split",
         "pair_mates", "copy_objects", "copy_multipart", "copy_plan", "write_split", "write_fastq_split",
         "incremental_copy", "copy_new", "copy_conflicts", "plan_transfer_fastq", "grid_copy", "clean_parts", "progress_ticks_stream", "path_list"}
TABLE_QUERIES = sorted(set(catalog_queries.QUERIES) - FILES)


def plan_of(df):
    return df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]


@pytest.mark.parametrize("name", TABLE_QUERIES)
def test_no_python_and_no_cross_joins_in_table_queries(spark, sf_dir, name):
    plan = plan_of(spark_entry.queries()[name](spark, sf_dir))
    for word in ("BatchEvalPython", "ArrowEvalPython", "MapInArrow", "MapInPandas", "CartesianProduct",
                 "BroadcastNestedLoopJoin"):
        assert word not in plan


def test_an_indexed_plan_shuffles_objects_once_and_chunks_never(spark, sf_dir):
    plan = drayage.grid_assign(drayage.build_plan(views.objects_orders(spark, sf_dir)), 5)
    text = plan_of(drayage.split_rebase(plan, 5))
    assert text.count("Exchange") == 1 and text.count("Window") == 1
    assert text.index("Generate explode") < text.index("Window")
    assert "ReadSchema: struct<key:string,size:bigint>" in text


def test_giant_objects_are_spread_before_the_second_explode(objects):
    plan = drayage.build_plan(objects([("k", 10**12)]), chunk_size=10**6)
    text = plan_of(plan)
    assert text.count("Generate explode") == 2 and "REPARTITION_BY_NUM" in text
    assert plan.count() == 10**6


def test_table_plans_do_not_join_or_shuffle_bodies(spark, sf_dir):
    text = plan_of(drayage.slice_bodies(views.objects_docs(spark, sf_dir), 1024))
    assert "Exchange" not in text and "Join" not in text


def test_bodies_are_not_read_for_names(spark, sf_dir):
    text = plan_of(drayage.filter_prefix(views.objects_docs(spark, sf_dir), "corpus/").select("key"))
    assert "text:string" not in text


def test_prefixes_slices_and_ages_reach_the_scan(spark, objects):
    stored = snapshot(objects([("a/x", 1), ("b", 2)]), "pushdown")
    assert "StringStartsWith(key,a/)" in plan_of(drayage.filter_prefix(stored, "a/"))
    plan = snapshot(drayage.build_plan(stored, chunk_size=1), "pushdown")
    assert "GreaterThanOrEqual(chunk_idx" in plan_of(drayage.grid_slice(plan, 3, 2))
    uploads = snapshot(objects([("a", 1)]).selectExpr("key", "size as upload_id", "timestamp_ntz'2024-01-01 00:00:00' as initiated"), "pushdown")
    assert "LessThan(initiated" in plan_of(drayage.stale_uploads(uploads, "2024-01-31 00:00:00"))


def test_huge_attempt_logs_are_cut_before_the_shuffle(spark, sf_dir):
    text = plan_of(drayage.attempt_accounting(views.attempts(spark, sf_dir), 400_000))
    assert text.count("Exchange") == 1 and "60, Partial" in text


def test_counts_combine_before_the_shuffle(objects):
    text = plan_of(drayage.unique_objects(objects([("a", 1)])))
    assert text.index("partial_max") > text.index("Exchange")


def test_broadcasts_are_counted_first(spark, objects, monkeypatch):
    from drayage import materialize
    few = snapshot(objects([("a", 1), ("b", 2)]), "few")
    assert "ResolvedHint" in materialize.broadcast_if_bounded(few, 2)._jdf.queryExecution().toString()
    assert "ResolvedHint" not in materialize.broadcast_if_bounded(few, 1)._jdf.queryExecution().toString()
    heavy = materialize.broadcast_if_bounded(few, 2, weight=F.col("size"))
    assert "ResolvedHint" not in heavy._jdf.queryExecution().toString()


def test_records_split_the_same_way_without_a_broadcast(spark, monkeypatch):
    from drayage.operators import records
    bounds = spark.createDataFrame([("k", 1, 0, 30), ("k", 2, 30, 60)], "key string, node int, start bigint, end bigint")
    reads = spark.createDataFrame([("k", 0), ("k", 29), ("k", 30)], "key string, start_offset bigint")
    expected = sorted(drayage.fastq_split(reads, bounds).collect())
    monkeypatch.setattr(records, "broadcast_if_bounded", lambda df, **_: df.hint("merge"))
    split = drayage.fastq_split(reads, bounds)
    assert "SortMergeJoin [key" in plan_of(split) and sorted(split.collect()) == expected


def test_shared_folder_is_the_configured_one(spark, tmp_path):
    from drayage import materialize
    before = spark.conf.get("spark.checkpoint.dir", None)
    assert before is None or materialize.fresh_dir(spark, "x").startswith(before)


def test_streams_read_names_only(spark, tmp_path):
    files = (spark.read.format("binaryFile").load(str(tmp_path)).select("path", "length"))
    assert "content" not in plan_of(files).split("ReadSchema")[1]
    assert F is not None
