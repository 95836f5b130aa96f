"""Unfinished uploads: report and clean-up."""

import contextlib
import os
import re

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, functions as F

from ..materialize import snapshot
from ..settings import STAGING_DIR, STALE_AFTER_DAYS
from ..sources.files import SHARD, drop_staging, local_path, open_root, upload_folder
from ..sources.listing import list_objects


def stale_uploads(uploads: DataFrame, now, days: int = STALE_AFTER_DAYS) -> DataFrame:
    """Uploads initiated strictly more than ``days`` before ``now``: key, upload_id, initiated_text.

    ``now`` is a timestamp column or text. The comparison with a constant reaches the scan.
    """
    at = F.lit(now).cast("timestamp_ntz") if isinstance(now, str) else now
    limit = at - F.make_dt_interval(F.lit(days))
    text = F.date_format("initiated", "dd-MM-yyyy HH:mm:ss")
    return uploads.where(F.col("initiated") < limit).select("key", "upload_id", text.alias("initiated_text"))


def list_uploads(spark, root_uri: str) -> DataFrame:
    """Unfinished multipart copies below a target root: key (of the unfinished file), upload_id, initiated."""
    staging = f"{root_uri.rstrip('/')}/{STAGING_DIR}"
    local = local_path(staging)
    if local is not None and not os.path.isdir(local):
        return spark.createDataFrame([], "key string, upload_id string, initiated timestamp")
    # Folders of uploads are one level down; files that a stopped job left are in one with the name of its run.
    upload = F.element_at(F.split("key", "/"), F.when(F.col("key").rlike(f"^{SHARD}/"), 2).otherwise(1))
    found = list_objects(spark, staging).where(F.col("key").like("%/%") & ~F.col("key").rlike(f"^{SHARD}/$")).select(
        F.concat(F.lit(STAGING_DIR + "/"), "key").alias("key"), upload.alias("upload_id"), F.col("mtime").alias("initiated"))
    return found.groupBy("upload_id").agg(F.min("key").alias("key"), F.min("initiated").alias("initiated")).select(
        "key", "upload_id", "initiated")


def clean_parts(report: DataFrame, root_uri: str, dry_run: bool = True, open_dest=open_root) -> DataFrame:
    """Removes the unfinished bodies, and part objects, of reported uploads: key, upload_id, action. Also in object stores,
    through the file system that ``open_dest`` returns for the root.

    ``would_remove`` in a dry run, else ``removed``, ``absent`` or ``failed``.
    """
    def there(fs, path):
        return fs.get_file_info(path).type == pafs.FileType.Directory

    def clean(batches):
        fs, root = open_dest(root_uri)
        for rows in batches:
            actions = []
            for upload_id in rows.column("upload_id").to_pylist():
                if not re.fullmatch(r"[0-9A-Za-z_-]+", upload_id):
                    actions.append("failed")
                    continue
                places = [upload_folder(upload_id), *([] if re.fullmatch(SHARD, upload_id) else [f"{STAGING_DIR}/{upload_id}"])]
                path = next((at for at in (f"{root}/{place}" for place in places) if there(fs, at)), None)
                if path is None:
                    actions.append("absent")
                elif dry_run:
                    actions.append("would_remove")
                else:
                    with contextlib.suppress(OSError):
                        fs.delete_dir(path)
                    actions.append("failed" if there(fs, path) else "removed")
            yield pa.RecordBatch.from_arrays([rows.column("key"), rows.column("upload_id"), pa.array(actions)],
                                             names=["key", "upload_id", "action"])

    work = report.select("key", F.col("upload_id").cast("string").alias("upload_id"))
    spread = work.repartition(report.sparkSession.sparkContext.defaultParallelism, "upload_id")
    cleaned = snapshot(spread.mapInArrow(clean, "key string, upload_id string, action string"), "cleaned")
    if not dry_run:
        drop_staging(root_uri)
    return cleaned
