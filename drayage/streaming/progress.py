"""Progress of a transfer per interval of time."""

from pyspark.sql import DataFrame, Window, functions as F

from ..operators.transfer import STATUS_DDL, finished_chunks
from ..sources.files import open_root, spark_path


def ticks(executed: DataFrame, interval: str, watermark: str = None) -> DataFrame:
    """Bytes and chunks finished per interval: tick_start, n_bytes, n_chunks. For tables and for streams.

    A stream needs a ``watermark`` if it is written in append mode; a tick is emitted when it can't change any more.
    """
    events = executed.withWatermark("ts", watermark) if watermark else executed
    return (events.groupBy(F.window("ts", interval))
            .agg(F.sum("bytes").alias("n_bytes"), F.count("*").alias("n_chunks"))
            .select(F.col("window.start").alias("tick_start"), "n_bytes", "n_chunks"))


def cumulate(tick_table: DataFrame, total_bytes: int = None, total_chunks: int = None) -> DataFrame:
    """Tick table + cum_bytes, cum_chunks, written_text (``total written``), finished_text (``finished / overall``).

    Without totals the table itself is the whole. Its rows are intervals of time, so the one ordered window doesn't
    grow with the number of chunks.
    """
    in_order = Window.orderBy("tick_start").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy()
    of_bytes = F.sum("n_bytes").over(whole) if total_bytes is None else F.lit(total_bytes)
    of_chunks = F.sum("n_chunks").over(whole) if total_chunks is None else F.lit(total_chunks)
    summed = tick_table.withColumns({"cum_bytes": F.sum("n_bytes").over(in_order),
                                     "cum_chunks": F.sum("n_chunks").over(in_order)})
    return summed.withColumns({
        "written_text": F.concat_ws(" ", of_bytes.cast("string"), F.col("cum_bytes").cast("string")),
        "finished_text": F.concat_ws(" / ", F.col("cum_chunks").cast("string"), of_chunks.cast("string"))})


def progress_ticks(executed: DataFrame, interval: str, total_bytes: int = None, total_chunks: int = None) -> DataFrame:
    return cumulate(ticks(executed, interval), total_bytes, total_chunks)


def running_copy(spark, status_root: str) -> DataFrame:
    """Stream of what copies with this ``status_root`` have finished so far, as ``run_progress_stream`` takes it.

    It can be started before the copy. Use a folder of its own for each job, which the executors share. What fails isn't
    in it; a chunk that is sent again in a later job counts again.
    """
    fs, path = open_root(status_root)
    fs.create_dir(path, recursive=True)
    # A file stream forgets files that are a week older than the newest; a job may take longer.
    files = spark.readStream.schema(STATUS_DDL).option("maxFileAge", "3650d")
    return finished_chunks(files.json(spark_path(status_root)))


def run_progress_stream(executed: DataFrame, interval: str, tick_path: str, checkpoint: str, watermark: str = None,
                        trigger: dict = None):
    """Starts a stream of ticks into a table at ``tick_path`` and returns the query.

    With a ``watermark`` closed ticks are appended as Parquet. Without one the whole tick table is replaced after each
    batch (complete mode); it holds one row per interval.
    """
    tick_stream = ticks(executed, interval, watermark)
    writer = tick_stream.writeStream.option("checkpointLocation", checkpoint)
    writer = writer.trigger(**(trigger or {"availableNow": True}))
    if watermark:
        return writer.outputMode("append").format("parquet").option("path", tick_path).start()
    return (writer.outputMode("complete")
            .foreachBatch(lambda table, _: table.write.mode("overwrite").parquet(tick_path)).start())
