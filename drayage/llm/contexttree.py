"""Log probability of texts by context-tree weighting over bytes, beside a word model.

A byte is eight binary decisions; each decision has a tree of contexts, the last DEPTH bytes. A node's counts give a
Krichevsky-Trofimov estimate, and a node mixes it with what its children say, half and half a priori. The trees are built
from the counts of strings of DEPTH + 1 bytes, which Spark sums over the documents to learn from. Below the last two
context bytes a tree is built in a task of its own (at most 256 ** 3 strings each, by construction); what remains above,
one and no context byte, is a table of 256 x 255 nodes. The result is one log probability for each string that occurs
anywhere, which is what scoring looks up.

Trees are frozen when they score. A context that wasn't met in training says nothing; the node above decides alone.
"""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..materialize import snapshot
from .common import bucket, gathered, small_batches, table, utf8

DEPTH, FOLDS, HELD_OUT = 4, 7, 2
START, END = b"\x00" * DEPTH, b"\xff"   # stand before and after a text; 0xff never occurs in UTF-8
LOOKUP_ROWS = 4_000_000                 # strings whose log probabilities tasks hold in memory; beyond, they are joined
FREQUENT = 1 << 18                      # words that make up at least 1/FREQUENT of all: so many at most are broadcast
PIECE, WORDS = 2 << 20, 200_000         # bytes, and distinct words, counted at once


def _grams(text: np.ndarray) -> np.ndarray:
    """Strings of DEPTH + 1 bytes as longs, one for each byte after the first DEPTH."""
    out = text[:-DEPTH].astype(np.int64)
    for i in range(1, DEPTH + 1):
        out = out << 8 | text[i:len(text) - DEPTH + i]
    return out


def _pieces(text: bytes):
    """A text with its start and end, in pieces that overlap by the context."""
    whole = START + text.lower() + END
    for a in range(0, len(whole) - DEPTH, PIECE):
        yield whole[a:a + PIECE + DEPTH]


def _joined(texts):
    """(texts in a buffer, index of the text of each gram) for pieces of about PIECE bytes."""
    parts, owners, size = [], [], 0
    for i, text in enumerate(texts):
        for piece in _pieces(text):
            parts.append(np.frombuffer(piece, np.uint8))
            owners.append(i)
            size += len(piece)
            if size >= PIECE:
                yield parts, owners
                parts, owners, size = [], [], 0
    if parts:
        yield parts, owners


def _block_grams(parts):
    """Grams of all parts, and how many each has; strings across two parts are left out."""
    sizes = np.array([len(p) for p in parts])
    grams = _grams(np.concatenate(parts))
    keep = np.ones(len(grams), bool)
    for end in np.cumsum(sizes)[:-1]:
        keep[end - DEPTH:end] = False
    return grams[keep], sizes - DEPTH


def count_grams(docs: DataFrame) -> DataFrame:
    """``docs(t, learn)`` -> ``(gram, n)``: each string that occurs, and how often in the texts to learn from."""
    def read(batches):
        for batch in gathered(batches):
            texts, learn = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for chosen in (True, False):
                grams, counts = [], []
                for parts, _ in _joined([t for t, x in zip(texts, learn) if x is chosen]):
                    g, n = np.unique(_block_grams(parts)[0], return_counts=True)
                    grams.append(g)
                    counts.append(n)
                if grams:
                    g, at = np.unique(np.concatenate(grams), return_inverse=True)
                    n = np.bincount(at, weights=np.concatenate(counts)).astype(np.int64) if chosen else np.zeros(len(g), np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(g), pa.array(n)], names=["gram", "n"])
    return docs.select("t", "learn").mapInArrow(read, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))


def log_gamma(x):
    """Log of the gamma function for x > 0, by Stirling's series beyond 7."""
    x = np.asarray(x, np.float64)
    low = np.ones_like(x)
    for i in range(7):
        low *= x + i
    y = x + 7
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (
        1260 * y ** 5) - 1 / (1680 * y ** 7) + 1 / (1188 * y ** 9) - np.log(low)


def log_kt(zeros, ones):
    """Log of the Krichevsky-Trofimov estimate of a sequence with so many zeros and ones."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1) - math.log(math.pi)


class _Level:
    """The nodes of one depth and bit: which node each row is in, its counts, estimate and weighted probability."""

    def __init__(self, keys, ones, n, below=None):
        nodes, self.node = np.unique(keys, return_inverse=True)
        self.n = np.stack([np.bincount(self.node, weights=n * (ones == bit), minlength=len(nodes)) for bit in (0, 1)])
        estimate = log_kt(self.n[0], self.n[1])
        if below is None:
            self.own, self.weighted = np.ones(len(nodes)), estimate
        else:
            first = np.zeros(len(below.weighted), np.int64)
            first[below.node] = self.node       # the parent of each node below
            children = np.bincount(first, weights=below.weighted, minlength=len(nodes))
            both = np.logaddexp(estimate, children)
            self.own, self.weighted = np.exp(estimate - both), both - math.log(2)
        self.keys = nodes

    def mixed(self, ones, deeper=None, deeper_n=None):
        """Probability of each row's bit: this node's estimate mixed with the deeper one where that has been met."""
        n = self.n[:, self.node]
        kt = (np.where(ones, n[1], n[0]) + 0.5) / (n.sum(0) + 1)
        if deeper is None:
            return kt
        own = np.where(deeper_n > 0, self.own[self.node], 1)
        return own * kt + (1 - own) * deeper


def _levels(grams, n, bit):
    """(ones, levels of depth 4, 3, 2) for one bit of the last byte of strings that share two context bytes."""
    byte = grams & 0xFF
    ones = (byte >> (7 - bit)) & 1
    prefix = (1 << bit) | (byte >> (8 - bit))
    deep = _Level((grams >> 24 & 0xFFFF) << 8 | prefix, ones, n)
    middle = _Level((grams >> 24 & 0xFF) << 8 | prefix, ones, n, deep)
    return ones, deep, middle, _Level(prefix, ones, n, middle)


def _upper_rows(grams, n):
    """Rows (prefix, zeros, ones, weighted) of the nodes with two context bytes."""
    for bit in range(8):
        top = _levels(grams, n, bit)[3]
        yield top.keys, top.n[0], top.n[1], top.weighted


def upper_tables(rows):
    """(own weight and estimate of one bit, for no and one context byte) from sums per (last byte, prefix)."""
    zeros, ones, below = (np.zeros((256, 256)) for _ in range(3))
    for last, prefix, a, b, w in rows:
        zeros[last, prefix], ones[last, prefix], below[last, prefix] = a, b, w
    one = log_kt(zeros, ones)
    one_both = np.logaddexp(one, below)
    root_zeros, root_ones = zeros.sum(0), ones.sum(0)
    root = log_kt(root_zeros, root_ones)
    root_both = np.logaddexp(root, (one_both - math.log(2)).sum(0))
    return {"own1": np.exp(one - one_both), "n1": np.stack([zeros, ones]), "own0": np.exp(root - root_both),
            "n0": np.stack([root_zeros, root_ones])}


def _log_probabilities(grams, n, upper):
    """Log10 of the probability of each string's last byte after the others."""
    total = np.zeros(len(grams))
    last = int(grams[0] >> 8 & 0xFF)
    for bit in range(8):
        ones, deep, middle, top = _levels(grams, n, bit)
        p = deep.mixed(ones)
        p = middle.mixed(ones, p, deep.n.sum(0)[deep.node])
        p = top.mixed(ones, p, middle.n.sum(0)[middle.node])
        prefix = (1 << bit) | (grams & 0xFF) >> (8 - bit)
        met = top.n.sum(0)[top.node]
        for own, counts in ((upper["own1"][last, prefix], upper["n1"][:, last, prefix]),
                            (upper["own0"][prefix], upper["n0"][:, prefix])):
            kt = (np.where(ones, counts[1], counts[0]) + 0.5) / (counts.sum(0) + 1)
            own = np.where(met > 0, own, 1)
            p, met = own * kt + (1 - own) * p, counts.sum(0)
        total += np.log10(p)
    return total


def _sorted(part):
    grams, n = part.column("gram").to_numpy(), part.column("n").to_numpy()
    order = np.argsort(grams)
    return grams[order], n[order]


def log_probabilities(counts: DataFrame) -> DataFrame:
    """``(gram, n)`` -> ``(gram, logp)``. Reads ``counts`` twice; only the table of one context byte is collected."""
    keyed = counts.withColumn("ctx", F.shiftright("gram", 8).bitwiseAND(0xFFFF).cast("int"))

    def upper(part: pa.Table) -> pa.Table:
        grams, n = _sorted(part)
        prefix, zeros, ones, weighted = (np.concatenate(x) for x in zip(*_upper_rows(grams, n)))
        last = np.full(len(prefix), grams[0] >> 8 & 0xFF)
        return pa.table([last, prefix, zeros, ones, weighted], names=["last", "prefix", "zeros", "ones", "weighted"])

    nodes = keyed.groupBy("ctx").applyInArrow(upper, "last bigint, prefix bigint, zeros double, ones double, weighted double")
    tables = upper_tables(nodes.groupBy("last", "prefix").agg(
        F.sum("zeros"), F.sum("ones"), F.sum("weighted")).orderBy("last", "prefix").collect())

    def predict(part: pa.Table) -> pa.Table:
        grams, n = _sorted(part)
        return pa.table([grams, _log_probabilities(grams, n, tables)], names=["gram", "logp"])
    return keyed.groupBy("ctx").applyInArrow(predict, "gram bigint, logp double")


class Lookup:
    """Values of known longs: a table with open addresses, filled and read many at a time."""

    def __init__(self, keys, values):
        self.bits = max(4, int(len(keys) * 3).bit_length())
        self.keys, self.values = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits)
        slot, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = left[self.keys[slot[left]] == -1]
            self.keys[slot[free]] = keys[free]
            placed = self.keys[slot[left]] == keys[left]
            self.values[slot[left[placed]]] = values[left[placed]]
            left = left[~placed]
            slot[left] = slot[left] + 1 & (1 << self.bits) - 1

    def _slot(self, keys):
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, keys):
        slot = self._slot(keys)
        out = self.values[slot]
        left = np.flatnonzero(self.keys[slot] != keys)
        while len(left):
            slot[left] = slot[left] + 1 & (1 << self.bits) - 1
            out[left] = self.values[slot[left]]
            left = left[self.keys[slot[left]] != keys[left]]
        return out


def count_words(docs: DataFrame) -> DataFrame:
    """``docs(t, learn)`` -> ``(token, c)`` over the texts to learn from, without the end; and null for the texts."""
    def rows(counter, texts):
        return pa.RecordBatch.from_arrays([pa.array([*counter, None], pa.binary()),
                                           pa.array([*counter.values(), texts], pa.int64())], names=["token", "c"])

    def read(batches):
        counter, texts = Counter(), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counter.update(text.lower().split())
                texts += 1
                if len(counter) > WORDS:
                    yield rows(counter, texts)
                    counter, texts = Counter(), 0
        yield rows(counter, texts)
    return docs.where("learn").select("t").mapInArrow(read, "token binary, c bigint").groupBy("token").agg(
        F.sum("c").alias("c"))


def score(docs: DataFrame, lookup_rows: int = LOOKUP_ROWS, frequent: int = FREQUENT) -> DataFrame:
    """``docs(doc_id, text)`` -> ``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)``, per row.

    Learns from the documents whose bucket isn't HELD_OUT (a null doc_id is learned from). A null or empty text has one
    token, its end. Repeated rows count as often as they occur. Without texts to learn from all counts are zero, and the
    vocabulary has no word. ``score`` is of the whole text with A-Z lower-cased, and its end.
    """
    spark = docs.sparkSession
    small_batches(spark)
    held = bucket("doc_id", FOLDS) == HELD_OUT
    read = docs.select("doc_id", utf8("text").alias("t"), held.alias("held_out"), (~held).alias("learn"))

    words = snapshot(count_words(read), "word-counts")
    total = words.agg(F.sum("c"), F.sum(F.when(F.col("token").isNull(), F.col("c"))), F.count("token")).first()
    n_tokens, n_texts, n_words = total[0] or 0, total[1] or 0, total[2]
    vocabulary = n_words + (1 if n_texts else 0)
    floor = math.log10(n_tokens + vocabulary + 1)
    often = max(1, -(-n_tokens // frequent))
    common = {bytes(r["token"]): math.log10(r["c"] + 1) - floor for r in words.where(
        F.col("token").isNotNull() & (F.col("c") >= often)).collect()} if n_tokens else {}
    end = math.log10(n_texts + 1) - floor
    shared_words = spark.sparkContext.broadcast(common)

    grams = snapshot(log_probabilities(snapshot(count_grams(read), "gram-counts")), "gram-probabilities")
    known = None
    if grams.count() <= lookup_rows:
        arrays = grams.toArrow()
        known = spark.sparkContext.broadcast((arrays.column("gram").to_numpy(), arrays.column("logp").to_numpy()))

    def texts(batches):
        """One row for each text, with a token of its own, and one for each of its words that isn't common."""
        common, lookup = shared_words.value, Lookup(*known.value) if known else None
        for batch in batches:
            rows, ids, held_out, texts = (batch.column(i).to_pylist() for i in range(4))
            model = np.zeros(len(texts))
            if lookup:
                for parts, owners in _joined(texts):
                    found, sizes = _block_grams(parts)
                    sums = np.add.reduceat(lookup(found), np.concatenate(([0], np.cumsum(sizes)[:-1])))
                    np.add.at(model, owners, sums)
            out = []
            for row, doc_id, is_held, text, value in zip(rows, ids, held_out, texts, model.tolist()):
                counter = Counter(text.lower().split())
                base, hits, rare = end, 1 if n_texts else 0, []
                for token, times in counter.items():
                    logp = common.get(token)
                    if logp is None:
                        rare.append((row, None, None, None, None, None, None, token, times))
                    else:
                        base += logp * times
                        hits += times
                out.append((row, doc_id, is_held, sum(counter.values()) + 1, hits, base, value, b" %d" % row, None))
                out += rare
                if len(out) > 50_000:
                    yield _text_rows(out)
                    out = []
            yield _text_rows(out)

    numbered = read.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "t")
    if known is None:
        numbered = snapshot(numbered, "numbered-texts")     # read twice: a row has to have the same number both times
    spread = numbered.mapInArrow(texts, _TEXT_SCHEMA)
    # words are joined with their counts; the row of a text has a token that no word can have
    rest = words.where(F.col("token").isNotNull() & (F.col("c") < often)).select("token", "c")
    joined = spread.join(rest, "token", "left")
    times, c = F.coalesce("times", F.lit(0)), F.coalesce("c", F.lit(0))
    sums = joined.groupBy("row").agg(
        *[F.max(x).alias(x) for x in ("doc_id", "held_out", "n_tokens", "score")],
        (F.max("n_known") + F.sum(F.when(F.col("c") > 0, times).otherwise(0))).alias("n_known"),
        (F.max("base") + F.sum(times * (F.log10(c + 1) - F.lit(floor)))).alias("base_score"))
    if known is None:
        own = numbered.mapInArrow(_row_grams, "row bigint, gram bigint, times bigint").join(grams, "gram").groupBy("row").agg(
            F.sum(F.col("times") * F.col("logp")).alias("score"))
        sums = sums.drop("score").join(own, "row", "left")
    return sums.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n_tokens).cast("bigint").alias("train_tokens"),
                       "base_score", "score")


_TEXT_SCHEMA = ("row bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, score double, "
                "token binary, times bigint")
_TEXT_TYPES = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.int64()]


def _text_rows(rows):
    columns = list(zip(*rows)) or [()] * 9
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TEXT_TYPES)],
                                      names=[c.split()[0] for c in _TEXT_SCHEMA.split(", ")])


def _row_grams(batches):
    """The strings of each text, when there are too many to look them up in memory."""
    for batch in batches:
        for row, text in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist()):
            for piece in _pieces(text):
                grams, n = np.unique(_grams(np.frombuffer(piece, np.uint8)), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(grams), row)), pa.array(grams), pa.array(n)],
                                                 names=["row", "gram", "times"])


def op9_context_tree(spark, sf_dir):
    return score(table(spark, sf_dir, "documents").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"))
