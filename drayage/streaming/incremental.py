"""Continuous copying: each new object once, across restarts."""

import uuid

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, functions as F

from ..materialize import snapshot
from ..operators.transfer import check_copies, copy_objects, copy_plan
from ..plans.indexing import build_plan
from ..sources.files import local_path, open_root, spark_path
from ..sources.listing import list_objects

LEDGER = ("key string, target string, bytes bigint, status string, tries int, error string, started timestamp, "
          "finished timestamp")


def ledger(spark, checkpoint: str) -> DataFrame:
    """What was copied so far, one row per object."""
    schema = f"{LEDGER}, batch string"
    path = f"{checkpoint.rstrip('/')}/ledger"
    fs, local = open_root(path)
    if fs.get_file_info(local).type != pafs.FileType.Directory:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(spark_path(path))


def _copy(objects: DataFrame, source_root, dest_root, checkpoint, on_failure):
    """Copies and enters the copies into the ledger, also if others failed, and only then raises. Objects above a chunk go
    by chunk where the target is mounted."""
    targets = objects.select("key", F.col("key").alias("target"))
    if local_path(dest_root) is None:
        done = copy_objects(objects, targets, source_root, dest_root)
    else:
        done = copy_plan(build_plan(objects, unique_keys=True), targets, source_root, dest_root)
        done = done.withColumn("tries", F.lit(None).cast("int"))
    done = done.select("key", "target", "bytes", "status", "tries", "error", "started", "finished")
    done.where("status in ('done', 'marker', 'skipped_directory')").write.parquet(
        f"{spark_path(checkpoint)}/ledger/batch={uuid.uuid4().hex}")
    check_copies(done, on_failure)


def copy_new(spark, source_root: str, dest_root: str, checkpoint: str, only: str = "true",
             on_failure: str = "fail", changed: bool = False) -> DataFrame:
    """Copies what is below ``source_root`` and not in the ledger; returns the ledger.

    The inventory is listed by tasks and compared with the ledger in a join, so nothing about single files is held on
    the driver, and the age or the name of an object doesn't matter. ``only`` narrows the inventory by a condition.
    With ``changed``, objects are copied again that have another size than their last copy, or a later time than its
    start.
    """
    checkpoint = checkpoint.rstrip("/")
    last = ledger(spark, checkpoint).groupBy("key").agg(F.max(F.struct("started", "bytes")).alias("last"))
    found = list_objects(spark, source_root).where(only).select("key", "size", "mtime").join(last, "key", "left")
    unseen = F.col("last").isNull()
    if changed:
        unseen |= (F.col("size") != F.col("last.bytes")) | (F.col("mtime") > F.col("last.started"))
    unseen = snapshot(found.where(unseen).select("key", "size"), "unseen")
    if not unseen.isEmpty():
        _copy(unseen, source_root, dest_root, checkpoint, on_failure)
    return ledger(spark, checkpoint)


def incremental_copy(spark, source_root: str, dest_root: str, checkpoint: str, empty_files: bool = True,
                     on_failure: str = "fail", changed: bool = False) -> DataFrame:
    """Copies what is new below ``source_root`` since the last call with this checkpoint; returns the ledger.

    One call is one trigger: an inventory compared with the ledger by :func:`copy_new`. Spark's file stream isn't used,
    as it forgets files much older than the newest one, passes over names that start with ``_`` or ``.``, and keeps
    the names it has seen on the driver.
    """
    only = "true" if empty_files else "size > 0"
    return copy_new(spark, source_root, dest_root, checkpoint, only, on_failure, changed)
