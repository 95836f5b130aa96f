"""FASTQ files as a table of 4-line records with exact byte offsets."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..functions import int_div
from ..materialize import snapshot, spread_io
from ..plans.chunking import plan_parts
from .files import PIECE, FileRanges, read_fully
from .listing import list_objects

READ_CHUNK = 16 << 20
OVERHANG = 64 << 10
MAX_OVERHANG = 256 << 20   # a record that ends further beyond its chunk has a range, but no text
MAX_CHUNK = 1 << 30         # positions within what a task holds are 32 bits wide
COUNT_BLOCK = 4_096
RECORDS_PER_BATCH = 50_000
LINES = ("header", "seq", "plus", "qual")

RECORD = pa.schema([("key", pa.string()), ("rec_no", pa.int64()), ("start_offset", pa.int64()),
                    ("byte_len", pa.int64()), ("header", pa.string()), ("seq", pa.string()), ("plus", pa.string()),
                    ("qual", pa.string()), ("problem", pa.string()), ("read_id", pa.string()),
                    ("mate", pa.string())])
RECORD_DDL = ("key string, rec_no bigint, start_offset bigint, byte_len bigint, header string, seq string, "
              "plus string, qual string, problem string, read_id string, mate string")

READ_ID = r"^@(\S*?)(?:/[12])?(?:\s|$)"
MATE_SUFFIX = r"^@\S*?/([12])(?:\s|$)"
MATE_COMMENT = r"^@\S+\s([12]):"


def read_fastq(spark, root_uri: str, prefix: str = "", chunk_size: int = READ_CHUNK, lines=LINES,
               comment_mates: bool = False) -> DataFrame:
    """Records of all files below a root that start with ``prefix``; see :func:`read_fastq_objects`."""
    return read_fastq_objects(list_objects(spark, root_uri, prefix), root_uri, chunk_size, lines, comment_mates)


def read_fastq_objects(objects: DataFrame, source, chunk_size: int = READ_CHUNK, lines=LINES,
                       comment_mates: bool = False) -> DataFrame:
    """key, rec_no, start_offset, byte_len, header, seq, plus, qual, problem, read_id, mate.

    Files are cut into chunks like any other object and read twice: once to count the lines of each chunk, once to
    parse. Whether a line is a header follows from its number in the file, so a quality line that starts with '@' is
    no special case. A record belongs to the chunk it starts in, its task reads on until the record is complete, and
    no record is shuffled. What isn't four lines with '@' and '+' has a ``problem``: header, plus or truncated. A
    record that ends over 256 MiB beyond its chunk is ``too_long``: it has its byte range and no text.
    ``byte_len`` counts the final newline, so the lengths of a file's records add up to its size.

    ``lines`` names the text columns to fill; the others are null and don't leave the task.
    """
    reader = FileRanges(source) if isinstance(source, str) else source
    return parse_records(line_positions(objects, reader, chunk_size), reader, lines, comment_mates)


def line_positions(objects: DataFrame, source, chunk_size: int) -> DataFrame:
    """Chunks of text files with the number of lines that end before them: key, part_number, input_offset, part_size,
    lines_before, at_line_start. The files are read once to count; the result is kept."""
    reader = FileRanges(source) if isinstance(source, str) else source
    if chunk_size > MAX_CHUNK:
        raise ValueError(f"records are read in chunks of at most {MAX_CHUNK} bytes")
    chunks = snapshot(plan_parts(objects.where(F.col("size") > 0), chunk_size), "fastq-chunks")
    counted = spread_io(chunks.select("key", "part_number", "input_offset", "part_size")).mapInArrow(
        _counter(reader), "key string, part_number int, input_offset bigint, part_size bigint, newlines bigint, "
                          "ends_line boolean")
    # Sums run over blocks of chunks and over the blocks of a file, so no window holds all chunks of a large file.
    block = int_div(F.col("part_number") - 1, F.lit(COUNT_BLOCK).cast("bigint"))
    counted = snapshot(counted.withColumn("block", block), "fastq-counts")
    blocks = counted.groupBy("key", "block").agg(F.sum("newlines").alias("newlines"),
                                                 F.max_by("ends_line", "part_number").alias("ends_line"))
    upto, of_file = (Window.unboundedPreceding, Window.currentRow), Window.partitionBy("key").orderBy("block")
    carried = blocks.select("key", "block",
                            (F.sum("newlines").over(of_file.rowsBetween(*upto)) - F.col("newlines")).alias("carried"),
                            F.lag("ends_line", 1, True).over(of_file).alias("enters_line"))
    in_block = Window.partitionBy("key", "block").orderBy("part_number")
    so_far = F.sum("newlines").over(in_block.rowsBetween(*upto))
    return snapshot(counted.join(carried, ["key", "block"]).select(
        "key", "part_number", "input_offset", "part_size",
        (F.col("carried") + so_far - F.col("newlines")).alias("lines_before"),
        F.coalesce(F.lag("ends_line").over(in_block), F.col("enters_line")).alias("at_line_start")), "fastq-plan")


def parse_records(positions: DataFrame, source, lines=LINES, comment_mates: bool = False) -> DataFrame:
    """Records that start in the given chunks of :func:`line_positions`, all of them or some."""
    unknown = set(lines) - set(LINES)
    if unknown:
        raise ValueError(f"no such lines: {sorted(unknown)}")
    reader = FileRanges(source) if isinstance(source, str) else source
    return spread_io(positions).mapInArrow(_parser(reader, tuple(lines), comment_mates), RECORD_DDL)


def with_read_ids(records: DataFrame, comment_mates: bool = False) -> DataFrame:
    """+ read_id (header up to the first blank, without '@' and mate mark) and mate ('1', '2' or null).

    ``comment_mates`` also reads the mate from a comment like ``1:N:0:ACGT``.
    """
    def group(pattern):
        return F.nullif(F.regexp_extract("header", pattern, 1), F.lit(""))

    mate = group(MATE_SUFFIX)
    if comment_mates:
        mate = F.coalesce(mate, group(MATE_COMMENT))
    return records.withColumns({"read_id": group(READ_ID), "mate": mate})


def valid_records(records: DataFrame) -> DataFrame:
    return records.where(F.col("problem").isNull()).drop("problem")


def quarantined(records: DataFrame) -> DataFrame:
    return records.where(F.col("problem").isNotNull())


def _counter(reader):
    def count(batches):
        for chunks in batches:
            newlines, ends = [], []
            ranges = zip(*(chunks.column(c).to_pylist() for c in ("key", "input_offset", "part_size")))
            for key, offset, length in ranges:
                found, last = 0, 0
                for low in range(0, length, PIECE):
                    data = np.frombuffer(read_fully(reader, key, offset + low, min(PIECE, length - low)), np.uint8)
                    found += int(np.count_nonzero(data == 10))
                    last = int(data[-1])
                newlines.append(found)
                ends.append(last == 10)
            yield pa.RecordBatch.from_arrays(chunks.columns + [pa.array(newlines, pa.int64()), pa.array(ends)],
                                             names=chunks.schema.names + ["newlines", "ends_line"])
    return count


def _parser(reader, lines, comment_mates):
    def parse(batches):
        for chunks in batches:
            for chunk in chunks.to_pylist():
                start, data, long = _own_records(reader, chunk)
                rec_no = -(-(chunk["lines_before"] + (not chunk["at_line_start"])) // 4)
                if len(data):
                    yield from _record_batches(chunk["key"], rec_no, start, data, lines, comment_mates)
                if long:
                    before, offset, length = long
                    yield pa.RecordBatch.from_pylist([{
                        "key": chunk["key"], "rec_no": rec_no + before, "start_offset": offset, "byte_len": length,
                        "problem": "too_long"}], schema=RECORD)
    return parse


def _own_records(reader, chunk):
    """(file offset, bytes) of the records that start in the chunk, complete unless the file ends; the last one apart, as
    (records before it, file offset, length), if it is too long to be held."""
    offset, length = chunk["input_offset"], chunk["part_size"]
    data = read_fully(reader, chunk["key"], offset, length)
    breaks = np.flatnonzero(np.frombuffer(data, np.uint8) == 10)
    starts = np.concatenate([[0] if chunk["at_line_start"] else [], breaks + 1]).astype(np.int64)
    starts = starts[starts < len(data)]
    first_line = chunk["lines_before"] + (not chunk["at_line_start"])
    skipped = -first_line % 4
    if skipped >= len(starts):
        return offset, b"", None
    begin = int(starts[skipped])
    # Lines from the first record on; the last record may lack some of its four line ends.
    missing = -int(np.count_nonzero(breaks >= begin)) % 4
    if missing == 0 and data[-1:] != b"\n":
        missing = 4
    tail, held, position, step = [], True, offset + length, OVERHANG
    while missing:
        piece = b"".join(bytes(part) for part in reader.read(chunk["key"], position, step))
        if not piece:
            break
        ends = np.flatnonzero(np.frombuffer(piece, np.uint8) == 10)
        if len(ends) >= missing:
            piece = piece[:int(ends[missing - 1]) + 1]
            missing = 0
        else:
            missing -= len(ends)
        position += len(piece)
        held &= position - offset - length <= MAX_OVERHANG
        tail = [*tail, piece] if held else []
        step = min(2 * step, READ_CHUNK)
    if held:
        return offset + begin, data[begin:] + b"".join(tail), None
    before = (len(starts) - skipped - 1) // 4
    last = int(starts[skipped + 4 * before])
    return offset + begin, data[begin:last], (before, offset + last, position - offset - last)


def _record_batches(key, rec_no, offset, data, lines, comment_mates):
    """Cuts complete records out of a byte string without touching single lines in Python."""
    values = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero(values == 10).astype(np.int32)
    if not len(ends) or ends[-1] != len(data) - 1:
        ends = np.append(ends, np.int32(len(data)))
    starts = np.concatenate([[0], ends[:-1] + 1]).astype(np.int32)
    after = np.minimum(ends + 1, len(data))

    # Even entries of this array are lines, odd ones are line ends.
    limits = np.empty(2 * len(starts) + 1, np.int32)
    limits[0:-1:2], limits[1::2], limits[-1] = starts, ends, len(data)
    pieces = pa.StringArray.from_buffers(len(limits) - 1, pa.py_buffer(limits), pa.py_buffer(data))

    names, mates = _names(data, values, starts[::4], ends[::4], comment_mates)
    count = -(-len(starts) // 4)
    for low in range(0, count, RECORDS_PER_BATCH):
        numbers = np.arange(low, min(low + RECORDS_PER_BATCH, count))
        heads, lasts = 4 * numbers, np.minimum(4 * numbers + 3, len(starts) - 1)
        columns = []
        for line, name in enumerate(LINES):
            if name not in lines:
                columns.append(pa.nulls(len(numbers), pa.string()))
                continue
            index = 4 * numbers + line
            columns.append(pieces.take(pa.array(2 * index, mask=index >= len(starts))))
        pluses = np.minimum(4 * numbers + 2, len(starts) - 1)
        problem = np.full(len(numbers), None, object)
        problem[values[np.minimum(starts[pluses], len(data) - 1)] != ord("+")] = "plus"
        problem[values[starts[heads]] != ord("@")] = "header"
        problem[4 * numbers + 3 >= len(starts)] = "truncated"
        yield pa.RecordBatch.from_arrays(
            [pa.array([key] * len(numbers), pa.string()), pa.array(rec_no + numbers, pa.int64()),
             pa.array(offset + starts[heads].astype(np.int64), pa.int64()),
             pa.array((after[lasts] - starts[heads]).astype(np.int64)), *columns, pa.array(problem, pa.string()),
             names.slice(low, len(numbers)), mates.slice(low, len(numbers))],
            schema=RECORD)


def _names(data, values, starts, ends, comment_mates):
    """Read ids and mates of all headers of a byte string, as Arrow arrays."""
    blanks = np.append(np.flatnonzero((values == 32) | (values == 9) | (values == 13)), len(data)).astype(np.int32)
    stops = np.minimum(blanks[np.searchsorted(blanks, starts)], ends)
    at = np.append(values, np.zeros(4, np.uint8))
    marked = at[starts] == ord("@")
    mate = at[np.maximum(stops - 1, 0)]
    suffix = marked & (stops - starts > 2) & (at[np.maximum(stops - 2, 0)] == ord("/")) & np.isin(mate, (49, 50))
    if comment_mates:
        after = marked & ~suffix & (stops - starts > 1) & (stops + 3 <= ends)
        comment = after & (at[stops + 2] == ord(":")) & np.isin(at[stops + 1], (49, 50))
        mate = np.where(comment, at[stops + 1], mate)
    else:
        comment = np.zeros(len(starts), bool)
    firsts, lasts = starts + marked, np.where(suffix, stops - 2, stops)
    unnamed = ~marked | (lasts <= firsts)

    limits = np.empty(2 * len(starts) + 1, np.int32)
    limits[0:-1:2], limits[1::2], limits[-1] = firsts, np.maximum(lasts, firsts), len(data)
    pieces = pa.StringArray.from_buffers(len(limits) - 1, pa.py_buffer(limits), pa.py_buffer(data))
    names = pieces.take(pa.array(2 * np.arange(len(starts)), mask=unnamed))
    mates = pa.array(["1", "2"]).take(pa.array(np.clip(mate, 49, 50).astype(np.int64) - 49, mask=~(suffix | comment)))
    return names, mates
