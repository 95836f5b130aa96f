"""Inventories of stores that list a flat key space in pages.

An object store answers a listing with one page of keys, in order, that follow a given key. Reading a store of many millions of
keys page after page takes one task as long as all its answers together. Here the key space is cut into ranges while it is
read: a task reads a few pages of its range, and if that isn't the end it looks which characters follow what the rest of the range
has in common, by asking for single keys, and leaves a range per character to the next round. Ranges are intervals of keys, so
wherever they are cut each key is in exactly one.
"""

import os

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..materialize import fresh_dir
from .files import batch

FOUND = pa.schema([("key", pa.string()), ("size", pa.int64()), ("mtime", pa.timestamp("us", "UTC")),
                   ("after", pa.string()), ("upto", pa.string())])
FOUND_DDL = "key string, size bigint, mtime timestamp, after string, upto string"
PAGE = 1_000
PAGES_PER_RANGE = 8
MAX_CUTS = 256
LAST = "\U0010ffff"


class BucketPages:
    """Pages of a bucket by a client with the method ``list_objects_v2``; ``connect`` returns one and is called in tasks."""

    def __init__(self, connect, bucket: str):
        self.connect, self.bucket, self._client = connect, bucket, None

    def __getstate__(self):
        return {**self.__dict__, "_client": None}

    def page(self, prefix: str, after: str, limit: int) -> list[tuple]:
        self._client = self._client or self.connect()
        found, start = [], {"StartAfter": after} if after else {}
        while True:
            answer = self._client.list_objects_v2(Bucket=self.bucket, Prefix=prefix, MaxKeys=limit - len(found), **start)
            found += [(entry["Key"], entry["Size"], entry["LastModified"]) for entry in answer.get("Contents", ())]
            # Stores may send less than was asked for before the end.
            if not answer.get("IsTruncated") or len(found) >= limit:
                return found
            start = {"ContinuationToken": answer["NextContinuationToken"]}


def _cuts(pages, prefix, after, upto):
    """Keys at which the rest of a range is cut, in order, so that there are keys beyond each.

    At most MAX_CUTS, whatever characters the keys are made of; what is beyond the last is one range.
    """
    def following(key):
        found = pages.page(prefix, key, 1)
        return found[0][0] if found and (upto is None or found[0][0] <= upto) else None

    low = following(after)
    # All keys between two strings begin with what these have in common.
    shared = prefix if low is None or upto is None else os.path.commonprefix([low, upto])
    while low is not None:
        if low == shared:
            low = following(low)
            continue
        depth, points, at = len(shared), [], low
        while at is not None and len(points) < MAX_CUTS:
            point = max(at, at[:depth + 1] + LAST)
            at = following(point)
            if at is not None:
                points.append(point)
                if at[depth] <= point[depth]:
                    break    # a key with the last character there is
        if points:
            return points
        shared = low[:depth + 1]
    return []


def _reader(pages, prefix, page_size, pages_per_range):
    def read_range(after, upto):
        for _ in range(pages_per_range):
            found = pages.page(prefix, after, page_size)
            inside = [entry for entry in found if upto is None or entry[0] <= upto]
            yield batch([{"key": key, "size": size, "mtime": mtime} for key, size, mtime in inside], FOUND)
            if len(found) < page_size or len(inside) < len(found):
                return
            after = inside[-1][0]
        bounds = [after, *_cuts(pages, prefix, after, upto), upto]
        yield batch([{"after": low, "upto": high} for low, high in zip(bounds, bounds[1:])], FOUND)

    def read(batches):
        for ranges in batches:
            for after, upto in zip(ranges.column("after").to_pylist(), ranges.column("upto").to_pylist()):
                yield from read_range(after, upto)

    return read


def list_pages(spark, pages, prefix: str = "", tasks: int = None, page_size: int = PAGE,
               pages_per_range: int = PAGES_PER_RANGE) -> DataFrame:
    """``objects`` of a store that lists pages: key, size, mtime, is_marker. Keys are longer than the prefix.

    ``pages`` has a method ``page(prefix, after, limit)``: the first ``limit`` (key, size, mtime) with the prefix and a key greater
    than ``after``, ordered by the code points of the keys; fewer if there are no more. :class:`BucketPages` is one.

    A task holds one page at a time, and in each round a range gives at most ``pages_per_range`` of them, so one folder, or one
    prefix, with most of the keys is read by all tasks after a few rounds. The ranges of a round are a table, not a list on the
    driver. An answer that fails fails its task: an inventory is complete or there is none. Keys that are written meanwhile may be in it
    or not, and none is in it twice.
    """
    if page_size < 1 or pages_per_range < 1:
        raise ValueError("a page has a key at least, and a range a page")
    tasks = tasks or 4 * spark.sparkContext.defaultParallelism
    path, levels, ranges = fresh_dir(spark, "pages"), [], 1
    frontier = spark.createDataFrame([("", None)], "after string, upto string")
    while ranges:
        levels.append(f"{path}/level={len(levels)}")
        read = _reader(pages, prefix, page_size, pages_per_range)
        frontier.repartition(min(tasks, ranges), "after").mapInArrow(read, FOUND_DDL).write.parquet(levels[-1])
        frontier = spark.read.schema(FOUND_DDL).parquet(levels[-1]).where("after is not null").select("after", "upto")
        ranges = frontier.count()
    entries = spark.read.schema(FOUND_DDL).parquet(*levels).where(F.col("key").isNotNull() & (F.length("key") > len(prefix)))
    return entries.select("key", "size", "mtime", (F.col("key").endswith("/") & (F.col("size") == 0)).alias("is_marker"))
