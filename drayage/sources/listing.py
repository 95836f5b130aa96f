"""Recursive inventory of a file tree."""

import collections
import datetime
import itertools
import os
import stat

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, functions as F

from ..materialize import fresh_dir, snapshot
from ..settings import STAGING_DIR
from .files import batch, below, local_path, open_root

ENTRY = pa.schema([("key", pa.string()), ("kind", pa.string()), ("size", pa.int64()),
                   ("mtime", pa.timestamp("us", "UTC")), ("error", pa.string())])
ENTRY_DDL = "key string, kind string, size bigint, mtime timestamp, error string"
ROWS_PER_BATCH = 10_000
DIRECTORIES_PER_ROUND = 100
SIZES_PER_DIRECTORY = 1_000


def _scan_local(root, directory, sizes):
    """Streams a directory. The sizes of a very large one are left to be read in parallel: rows of kind ``name``."""
    count = 0
    with os.scandir(os.path.join(root, directory) if directory else root) as entries:
        for entry in entries:
            count += 1
            if entry.is_dir(follow_symlinks=False):
                yield {"key": directory + entry.name + "/", "kind": "dir"}
            elif count > sizes:
                yield {"key": directory + entry.name, "kind": "name"}
            else:
                yield _sized(root, directory + entry.name)
    if not count and directory:
        yield {"key": directory, "kind": "marker", "size": 0}


def _sized(root, key):
    try:
        info = os.stat(below(root, key))
        if not stat.S_ISREG(info.st_mode):
            return {"key": key, "kind": "error", "error": "not a regular file"}
        mtime = datetime.datetime.fromtimestamp(info.st_mtime, datetime.timezone.utc)
        return {"key": key, "kind": "file", "size": info.st_size, "mtime": mtime}
    except (OSError, ValueError) as error:
        return {"key": key, "kind": "error", "error": str(error)}


def _scan_remote(fs, root, directory):
    infos = fs.get_file_info(pafs.FileSelector(f"{root}/{directory}".rstrip("/")))
    for info in infos:
        if info.type == pafs.FileType.Directory:
            yield {"key": directory + info.base_name + "/", "kind": "dir"}
        else:
            yield {"key": directory + info.base_name, "kind": "file", "size": info.size, "mtime": info.mtime}
    if not infos and directory:
        yield {"key": directory, "kind": "marker", "size": 0}


def _scanner(root_uri, prefix, per_round, sizes, staging=True):
    def wanted(entry):
        key = entry["key"]
        if not staging and key == STAGING_DIR + "/":
            return False
        return key.startswith(prefix) or (entry["kind"] == "dir" and prefix.startswith(key))

    def scan(batches):
        local = local_path(root_uri)
        fs, root = (None, local) if local is not None else open_root(root_uri)
        for frontier in batches:
            for start in frontier.column("key").to_pylist():
                waiting, rows, scanned = collections.deque([start]), [], 0
                while waiting and scanned < per_round:
                    directory, scanned = waiting.popleft(), scanned + 1
                    try:
                        found = _scan_remote(fs, root, directory) if fs else _scan_local(root, directory, sizes)
                        for entry in filter(wanted, found):
                            if entry["kind"] == "dir":
                                waiting.append(entry["key"])
                            else:
                                rows.append(entry)
                            if len(rows) == ROWS_PER_BATCH:
                                yield batch(rows, ENTRY)
                                rows = []
                    except OSError as error:
                        rows.append({"key": directory, "kind": "error", "error": str(error)})
                yield batch(rows, ENTRY)
                for low in range(0, len(waiting), ROWS_PER_BATCH):
                    some = itertools.islice(waiting, low, low + ROWS_PER_BATCH)
                    yield batch([{"key": directory, "kind": "dir"} for directory in some], ENTRY)

    return scan


def _stat(root_uri):
    def sized(batches):
        root = local_path(root_uri)
        for names in batches:
            yield batch([_sized(root, key) for key in names.column("key").to_pylist()], ENTRY)

    return sized


def walk(spark, root_uri: str, prefix: str = "", tasks: int = None, staging: bool = True) -> DataFrame:
    """Everything below ``root_uri`` whose key starts with ``prefix``: key, kind, size, mtime, error.

    In each round a task walks on from the directory it was given, through 100 directories at most; what it hasn't read
    by then is spread over all tasks in the next round. The walk starts at the directory of the prefix, and its result
    is kept, so all later jobs see one inventory. Directories of mounted file systems with very many files are read for
    names only, and these are spread for reading the sizes, so one directory with most of the files doesn't keep one
    task busy with them. Links to files are files; links to folders, pipes and the like are ``error`` rows. A target
    root has a folder of unfinished copies, which is left out without ``staging``.
    """
    tasks = tasks or 4 * spark.sparkContext.defaultParallelism
    start = prefix[:prefix.rfind("/") + 1]
    path = fresh_dir(spark, "listing")
    frontier = spark.createDataFrame([(start,)], "key string")
    levels, directories = [], 1
    while directories:
        levels.append(f"{path}/level={len(levels)}")
        spread = frontier.repartition(min(tasks, directories), "key")
        scan = _scanner(root_uri, prefix, DIRECTORIES_PER_ROUND, SIZES_PER_DIRECTORY, staging)
        spread.mapInArrow(scan, ENTRY_DDL).write.parquet(levels[-1])
        frontier = spark.read.schema(ENTRY_DDL).parquet(levels[-1]).where("kind = 'dir'").select("key")
        directories = frontier.count()

    entries = spark.read.schema(ENTRY_DDL).parquet(*levels)
    if local_path(root_uri) is None:
        return entries.where("kind <> 'dir'")
    known, names = entries.where("kind not in ('dir', 'name')"), entries.where("kind = 'name'").select("key")
    unsized = names.count()
    if not unsized:
        return known
    spread = names.repartition(max(1, min(tasks, unsized // 100)), "key")
    return snapshot(known.unionByName(spread.mapInArrow(_stat(root_uri), ENTRY_DDL)), "inventory")


def list_objects(spark, root_uri: str, prefix: str = "", tasks: int = None, staging: bool = True) -> DataFrame:
    """``objects`` below a root: key, size, mtime, is_marker. Keys are longer than the prefix.

    An empty directory is a folder marker: size 0, key with a final slash. Unreadable entries are left out;
    :func:`listing_errors` of the same walk reports them.
    """
    return objects_of(walk(spark, root_uri, prefix, tasks, staging), prefix)


def objects_of(entries: DataFrame, prefix: str = "") -> DataFrame:
    keep = F.col("error").isNull() & (F.length("key") > len(prefix))
    return entries.where(keep).select("key", "size", "mtime", (F.col("kind") == "marker").alias("is_marker"))


def listing_errors(entries: DataFrame) -> DataFrame:
    return entries.where(F.col("error").isNotNull()).select("key", "error")
