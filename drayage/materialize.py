"""Where intermediate tables are kept, and which tables may be broadcast.

Anything that is read several times or that has side effects is written to the shared folder the cluster names in
``spark.checkpoint.dir``, so a lost executor costs a re-read and never a second run of the side effect.
"""

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

BROADCAST_ROWS = 100_000
SMALL_TASK_BYTES, SMALL_TASK_ROWS = 4 << 20, 50
MAX_TASKS, UNEVEN, SUM_GROUPS = 100_000, 4, 1_024

_local_dirs = {}


def shared_dir(spark: SparkSession) -> str:
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="drayage-")
    return _local_dirs[app]


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/drayage/{label}-{uuid.uuid4().hex}"


def fresh_file_root(spark: SparkSession, label: str) -> str:
    """Like :func:`fresh_dir`, as a root for files that are read and written byte by byte."""
    path = fresh_dir(spark, label)
    local = path[len("file://"):] if path.startswith("file://") else path.removeprefix("file:")
    if "://" not in local:
        os.makedirs(local, exist_ok=True)
        return local
    return path


def snapshot(df: DataFrame, label: str) -> DataFrame:
    """Run ``df`` once, keep it as a Parquet table in the shared folder and read that."""
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Snapshots of one job, of which each can be removed as soon as nothing reads it any more."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        path = fresh_dir(self.spark, label)
        df.write.parquet(path)
        kept = self.spark.read.schema(df.schema).parquet(path)
        self.paths.append((kept, path))
        return kept

    def drop(self, *tables: DataFrame):
        for path in [p for df, p in self.paths if any(df is t for t in tables)]:
            at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        self.paths = [(df, p) for df, p in self.paths if not any(df is t for t in tables)]

    def clear(self):
        self.drop(*[df for df, _ in self.paths])


def broadcast_if_bounded(df: DataFrame, max_rows: int = BROADCAST_ROWS, weight=None) -> DataFrame:
    """Mark ``df`` for broadcast if it is counted to be small; otherwise leave the join to shuffle.

    ``weight`` is what a row counts, for rows with arrays. ``df`` should be cheap to count: a snapshot, for example.
    """
    total = df.agg(F.sum(F.lit(1) if weight is None else weight)).first()[0] or 0
    return F.broadcast(df) if total <= max_rows else df


def spread_io(work: DataFrame, size: str = "part_size", bytes_per_task: int = 256 << 20) -> DataFrame:
    """Deals the rows of a byte-moving stage out to tasks evenly.

    The number of tasks follows from the bytes behind the rows and is given explicitly: the rows themselves are tiny,
    and a coalesce by their size would put all of them, with all their I/O, into one task. Several tasks per core let
    fast ones take over from slow ones; small jobs get fewer.

    Rows of about equal bytes are dealt by number. If the largest has over four times the mean, rows are dealt by the running
    sum of their bytes: no task has more than an equal share and the half of its largest row at each end.
    """
    bytes_of = F.coalesce(F.col(size), F.lit(0)).cast("bigint")
    amount = work.agg(F.coalesce(F.sum(bytes_of), F.lit(0)).alias("n_bytes"), F.count("*").alias("n_rows"),
                      F.coalesce(F.max(bytes_of), F.lit(0)).alias("largest")).first()
    n_bytes, n_rows = amount["n_bytes"], amount["n_rows"]
    useful = max(n_bytes // SMALL_TASK_BYTES, n_rows // SMALL_TASK_ROWS)
    wanted = max(n_bytes // bytes_per_task, min(useful, 3 * work.sparkSession.sparkContext.defaultParallelism))
    n_tasks = int(max(1, min(wanted, n_rows, MAX_TASKS)))
    row_cost = SMALL_TASK_BYTES // SMALL_TASK_ROWS
    if n_tasks == 1 or (amount["largest"] + row_cost) * n_rows <= UNEVEN * (n_bytes + row_cost * n_rows):
        return work.repartition(n_tasks)
    return _by_running_sum(work, bytes_of + F.lit(row_cost), n_tasks, n_bytes + row_cost * n_rows)


def _by_running_sum(work: DataFrame, cost, n_tasks: int, total: int) -> DataFrame:
    """``work`` in ``n_tasks`` partitions of about equal cost. A row costs something besides its bytes.

    Rows are summed in groups by hash, the groups, of which there is a fixed number, one after the other. A row goes to the task in
    whose share of the whole the middle of its own stretch lies.
    """
    columns = work.columns
    # Maps have no order.
    ordered = [F.to_json(F.struct(name)) if "map<" in kind else F.col(name) for name, kind in work.dtypes]
    costed = work.withColumns({"_cost": cost, "_group": F.pmod(F.xxhash64(*ordered), F.lit(SUM_GROUPS))})
    in_order = Window.partitionBy("_group").orderBy("_cost", *ordered).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = costed.groupBy("_group").agg(F.sum("_cost").alias("_sum"))
    # One row per group.
    begins = sums.select("_group", (F.sum("_sum").over(Window.orderBy("_group")) - F.col("_sum")).alias("_begin"))
    placed = costed.withColumn("_end", F.sum("_cost").over(in_order)).join(F.broadcast(begins), "_group")
    middle = F.col("_begin") + F.col("_end") - F.col("_cost") / 2
    task = F.least(F.lit(n_tasks - 1), F.floor(middle * F.lit(n_tasks) / F.lit(total))).cast("int")
    return placed.withColumn("_task", task).repartitionById(n_tasks, "_task").select(*columns)
