"""Fill-in-middle: texts cut in three at random units and written in the order of a training example.

A text is held as its UTF-8 bytes in blocks of fixed size. A Fenwick tree over the blocks has, for each, how many units and
how many code points begin in it. The block of a cut is found by a descent that halves its step, from the largest power of two;
only that block is looked at byte by byte. So a cut of a text of n blocks costs log n steps and one block, in any unit.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import small_batches, table, utf8

BLOCK, SLAB = 4096, 256         # bytes of a block; blocks that are counted at once
PLAIN, SPM, SALT = 10, 20, 1    # per cent of texts left as they are; of the rest, with the suffix first
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
UNITS = ("characters", "words", "lines")
_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True


def _begins(data: np.ndarray, a: int, b: int, unit: str) -> np.ndarray:
    """Whether a unit begins at each byte of ``data[a:b]``: a code point, a word with the white space after it, a line."""
    if unit == "characters":
        return (data[a:b] & 0xC0) != 0x80
    before = data[max(a - 1, 0):b - 1]
    found = ~_SPACES[data[a:b]] if unit == "words" else np.ones(b - a, bool)
    found[(a == 0):] &= _SPACES[before] if unit == "words" else before == 10
    if a == 0 and b:
        found[0] = True
    return found


class Fenwick:
    """Sums of pairs (units, code points) over blocks, in a tree whose node i covers the blocks i - lowbit(i) to i - 1."""

    def __init__(self, counts: np.ndarray):
        sums = np.concatenate((np.zeros((1, 2), np.int64), np.cumsum(counts, 0)))
        nodes = np.arange(1, len(sums))
        self.nodes = np.zeros_like(sums)
        self.nodes[1:] = sums[nodes] - sums[nodes - (nodes & -nodes)]

    def before(self, units: int) -> tuple[int, int, int]:
        """The block where unit number ``units`` (from 0) begins, and the units and code points before that block."""
        at, step, passed, points = 0, 1 << len(self.nodes).bit_length(), 0, 0
        while step:
            if at + step < len(self.nodes) and passed + self.nodes[at + step, 0] <= units:
                at += step
                passed += int(self.nodes[at, 0])
                points += int(self.nodes[at, 1])
            step >>= 1
        return at, passed, points


class Text:
    """A text that can be cut after any number of units."""

    def __init__(self, data: bytes, unit: str = "characters", block: int = BLOCK):
        self.unit, self.block = unit, block
        self.bytes = np.frombuffer(data, np.uint8)
        counts = [np.zeros((0, 2), np.int64)]
        for a in range(0, len(data), SLAB * block):
            b = min(a + SLAB * block, len(data))
            starts = np.arange(0, b - a, block)
            points = np.add.reduceat(_begins(self.bytes, a, b, "characters"), starts, dtype=np.int64)
            units = points if unit == "characters" else np.add.reduceat(_begins(self.bytes, a, b, unit), starts, dtype=np.int64)
            counts.append(np.stack((units, points), 1))
        counts = np.concatenate(counts)
        self.units, self.points = (int(x) for x in counts.sum(0))
        self.tree = Fenwick(counts)

    def cut(self, units: int) -> tuple[int, int]:
        """Bytes and code points of the first ``units`` units."""
        if units >= self.units:
            return len(self.bytes), self.points
        number, passed, points = self.tree.before(units)
        a = number * self.block
        b = min(a + self.block, len(self.bytes))
        at = int(np.flatnonzero(_begins(self.bytes, a, b, self.unit))[units - passed])
        return a + at, points + int(np.count_nonzero(_begins(self.bytes, a, a + at, "characters")))


def draws(doc_id, salt=SALT) -> list[int]:
    """Four numbers of 32 bits that follow from the id alone; those of a null id are those of an empty one."""
    digest = hashlib.sha256(f"{salt}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]


def transformed(data: bytes, doc_id, unit="characters", plain=PLAIN, spm=SPM, salt=SALT, markers=(PREFIX, SUFFIX, MIDDLE),
                block=BLOCK):
    """(units, form, prefix code points, middle code points, output) of a text."""
    text, (first, second, form, order) = Text(data, unit, block), draws(doc_id, salt)
    p, s, m = (x.encode() for x in markers)
    if not data or form % 100 >= 100 - plain or p in data or s in data or m in data:
        return text.units, "plain", None, None, data
    low, high = sorted((first % (text.units + 1), second % (text.units + 1)))
    (a, to_a), (b, to_b) = text.cut(low), text.cut(high)
    view = memoryview(data)
    if order % 100 < spm:
        return text.units, "spm", to_a, to_b - to_a, b"".join((s, view[b:], p, view[:a], m, view[a:b]))
    return text.units, "psm", to_a, to_b - to_a, b"".join((p, view[:a], s, view[b:], m, view[a:b]))


def fill_in_middle(docs: DataFrame, unit: str = "characters", plain: int = PLAIN, spm: int = SPM, salt=SALT,
                   markers=(PREFIX, SUFFIX, MIDDLE), block: int = BLOCK) -> DataFrame:
    """``docs(doc_id, text)`` -> ``(doc_id, n, form, prefix_chars, middle_chars, output)``, one row per row of ``docs``.

    ``n`` counts the units of the whole text: ``characters`` (code points), ``words`` (each with the white space after it; white
    space at the start is one too) or ``lines``. The prefix ends after the smaller of two drawn numbers of units, the
    middle after the larger. ``plain`` per cent of the texts stay as they are, and so do texts that are empty or hold a marker; of
    the others ``spm`` per cent have their suffix first. Draws follow from doc_id alone, so equal ids with different texts
    are cut at different places and repeated rows alike; a null id draws as an empty one. A null text is empty. Null lengths: plain.
    """
    if unit not in UNITS:
        raise ValueError(f"unit is one of {', '.join(UNITS)}")

    def run(batches):
        for batch in batches:
            rows = [transformed(data, doc_id, unit, plain, spm, salt, markers, block)
                    for doc_id, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            n, form, head, middle, output = zip(*rows) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(head, pa.int64()),
                 pa.array(middle, pa.int64()), pa.array(output, pa.binary())],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    small_batches(docs.sparkSession)
    texts = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), utf8(docs["text"]).alias("t"))
    return texts.mapInArrow(run, "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output binary"
                            ).withColumn("output", F.col("output").cast("string"))


def restored(output: str = "output", form: str = "form", markers=(PREFIX, SUFFIX, MIDDLE)) -> Column:
    """The text that an output was made of. No cut can make a marker, so the three markers of an output are the only ones."""
    parts = F.split(F.col(output), "|".join(f"\\Q{m}\\E" for m in markers), -1)
    return F.when(F.col(form) == "psm", F.concat(parts[1], parts[3], parts[2])).when(
        F.col(form) == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(F.col(output))


def op13_fill_in_middle(spark, sf_dir):
    return fill_in_middle(table(spark, sf_dir, "documents")).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored().cast("binary"), 256).alias("restored_sha256"))


ORACLE = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
                  sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
h AS (SELECT *, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS a, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS b,
             CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 AS h4 FROM d),
f AS (SELECT doc_id, t, n, least(a, b) AS a, greatest(a, b) AS b,
             CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 >= 90 THEN 'plain'
                  WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t
                        WHEN 'psm' THEN '<P>' || substr(t, 1, a) || '<S>' || substr(t, b + 1) || '<M>' || substr(t, a + 1, b - a)
                        ELSE '<S>' || substr(t, b + 1) || '<P>' || substr(t, 1, a) || '<M>' || substr(t, a + 1, b - a) END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM f
"""
