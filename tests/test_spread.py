import random

import pytest
from pyspark.sql import functions as F

from drayage import materialize
from drayage.materialize import spread_io

MIB = 1 << 20


def loads(df):
    """Bytes and rows of each partition, and all rows."""
    rows = df.withColumn("task", F.spark_partition_id()).collect()
    found = {}
    for row in rows:
        n_bytes, n = found.get(row["task"], (0, 0))
        found[row["task"]] = (n_bytes + (row["part_size"] or 0), n + 1)
    return found, sorted(row["key"] for row in rows)


def work_of(spark, sizes):
    return spark.createDataFrame([(f"k{i}", size) for i, size in enumerate(sizes)], "key string, part_size bigint").repartition(4)


def test_one_large_file_among_small_ones(spark):
    sizes = [4096 * MIB] + [MIB // 2] * 10_000
    spread = spread_io(work_of(spark, sizes))
    found, keys = loads(spread)
    n_tasks = spread.rdd.getNumPartitions()
    share = sum(sizes) / n_tasks
    assert keys == sorted(f"k{i}" for i in range(len(sizes)))
    assert max(found.values()) <= (4096 * MIB + share, 10_000)
    rest = sorted(found.values())[:-1]
    assert max(n_bytes for n_bytes, _ in rest) <= 2 * share
    large = max(found.values())
    assert large[1] <= 10_000 / n_tasks


@pytest.mark.parametrize("seed", range(3))
def test_shares_are_bounded(spark, seed):
    rng = random.Random(seed)
    sizes = [int(MIB * rng.paretovariate(0.7)) for _ in range(2000)] + [None] * 50 + [0] * 50
    spread = spread_io(work_of(spark, sizes), bytes_per_task=64 * MIB)
    found, keys = loads(spread)
    assert keys == sorted(f"k{i}" for i in range(len(sizes)))
    cost = materialize.SMALL_TASK_BYTES // materialize.SMALL_TASK_ROWS
    total, n_tasks = sum(s or 0 for s in sizes) + cost * len(sizes), spread.rdd.getNumPartitions()
    limit = total / n_tasks + max(s or 0 for s in sizes) + cost
    assert all(n_bytes + cost * n <= limit for n_bytes, n in found.values())


def test_even_rows_are_dealt_by_number(spark):
    found, _ = loads(spread_io(work_of(spark, [25 * MIB] * 400)))
    assert max(n for _, n in found.values()) <= 2 * 400 / len(found)
    empty = spread_io(work_of(spark, [5]).where("false"))
    assert empty.collect() == [] and empty.rdd.getNumPartitions() == 1


def test_repeated_rows_are_kept(spark):
    work = spark.createDataFrame([("k", 900 * MIB)] + [("k", 1)] * 300 + [(None, None)] * 300, "key string, part_size bigint")
    assert spread_io(work).count() == 601
    tagged = work.withColumn("metadata", F.create_map(F.lit("project"), F.lit("a")))
    spread = spread_io(tagged)
    assert spread.count() == 601 and spread.columns == tagged.columns
