"""Tables as object stores."""

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import last_element
from ..plans.indexing import unique_objects


def _column(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def objects_from_table(df: DataFrame, key, body, mtime=None) -> DataFrame:
    """``objects`` of any table with a key and a body: key, size in bytes, is_marker, body and, if given, mtime."""
    key, body = _column(key), _column(body)
    size = F.octet_length(body).cast("bigint")
    columns = [key.alias("key"), size.alias("size"), (key.endswith("/") & (size == 0)).alias("is_marker")]
    if mtime is not None:
        columns.append(_column(mtime).alias("mtime"))
    return df.select(*columns, body.alias("body"))


def head_objects(keys: DataFrame, inventory: DataFrame) -> DataFrame:
    """Size of each requested key: key, size, status ``found`` or ``not_found``.

    Both sides are reduced to one row per key first, so neither repeated requests nor repeated listings make a
    hot key, and the join reuses the partitioning of the aggregates.
    """
    wanted = keys.select("key").distinct()
    known = unique_objects(inventory)
    status = F.when(F.col("size").isNull(), "not_found").otherwise("found")
    return wanted.join(known, "key", "left").select("key", "size", status.alias("status"))


def read_path_list(spark, path: str) -> DataFrame:
    """A file list, one path per line, without empty lines: source, name (last element of the path)."""
    lines = spark.read.text(path).where(F.col("value") != "")
    return lines.select(F.col("value").alias("source"),
                        last_element(F.regexp_replace("value", "(?<=.)/+$", "")).alias("name"))
