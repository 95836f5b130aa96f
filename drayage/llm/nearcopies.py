"""Near-duplicate texts: word shingles with a Jaccard similarity of 0.8 or more, all links between them, by SimHash
fingerprints first and exact prefixes for what lies further apart.

Each set of shingles has a fingerprint. Those that differ in two bits at most are found by the blocks of ``simhash``, and the sets
behind them are compared and put together. Sets at a similarity of 0.8 differ in ten bits or so, which no choice of blocks
finds, so prefixes look for the links between different components after that.

The shingles of a text are put in one order for all texts, rare ones first. Two texts that are similar enough share one of
the first ``n - ceil(0.8 n) + 1`` shingles of each, so pairs are looked for under these only. How rare a shingle is comes from
a sample: this bears on the number of candidates, not on the result. Texts with the same set are one class.

Most of these shingles belong to one set only. They are counted once, those of several sets are marked in a table of bits of
fixed size, and only marked ones are written with their sets. Candidates are first held against a bound: each set has parity
bits, 512 and more of them for more shingles, of which two sets differ in no more than the sets do. What remains is compared
shingle by shingle.

Keys are made of a shingle and a class of sizes: sets that are similar are in one class or in neighbouring ones, and each set stands
in its own class and, marked as lower, in the next. Two lower ones aren't looked at there, as they meet in their own class. A key that
many sets share is never compared pair by pair: its sets are held against one of them, a hub, and what is connected by then needn't be
looked at again. Later there are several hubs per round, twice as many each time, until nothing is open. So rounds grow with the
logarithm of the sets of a key. Hubs come from the largest component, so that a round costs the sets beside it times the hubs, and
a set that is similar to a share of the group leaves after about the inverse of that share, however large the group is. The few sets
that stay beside it become hubs themselves.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..materialize import Scratch, broadcast_if_bounded
from .common import bit_table, has_bit, row_key, small_batches, utf8
from .components import components
from .simhash import PIECE, close_links, majority, ones

SEED, SHINGLE = 42, 5
SAMPLE_DOCS, COMMON, COMMON_SHINGLES = 20_000, 2, 150_000    # a shingle that occurs in two sampled texts comes late
PAIRWISE = 32               # sets of a key that are compared pair by pair; hubs of a larger key in the second round
FEW = 16                    # a key is finished when a round has so many hubs for each set beside the largest component
OWN = 1 << 32               # what a set counts for a key of its own class, over any number of lower ones
SIZES = 1.25                # sizes of similar sets differ by no more than this factor
PARITY = 8                  # longs of parity bits at least, a bit per shingle for longer sets
_MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9)


class _Hashes(dict):
    def __missing__(self, word):
        value = self[word] = xxhash.xxh64_intdigest(word, SEED)
        return value


def shingles(text: bytes, known: dict = None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted 64-bit hashes of the different shingles of ``shingle`` words; a shorter text is one shingle."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    known = _Hashes() if known is None else known
    each = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    width = min(shingle, len(words))
    value = np.zeros(len(words) - width + 1, np.uint64)
    for i in range(width):
        value = value * np.uint64(_MIX[0]) + each[i:len(words) - width + 1 + i]
    value = (value ^ value >> np.uint64(31)) * np.uint64(_MIX[1])
    return np.unique(value ^ value >> np.uint64(29))


def prefix_length(n: int) -> int:
    return n - (4 * n + 4) // 5 + 1 if n else 0


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Jaccard similarity of two sorted sets of 0.8 or more."""
    both = np.concatenate([a, b])
    both.sort()
    return 9 * int(np.count_nonzero(both[1:] == both[:-1])) >= 4 * (len(a) + len(b))


def _per_text(batch, value):
    """``value(text, known)`` for each row of the second column, once for equal texts."""
    seen, known, out = {}, _Hashes(), []
    for text in batch.column(1).to_pylist():
        if text not in seen:
            seen[text] = value(shingles(text, known))
        out.append(seen[text])
    return out


def _set_id(found: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(found.tobytes(), SEED) - (1 << 63) if len(found) else 0


def common_shingles(docs: DataFrame):
    """Hashes, sorted, and counts of the shingles that are frequent in a sample of the texts, chosen by hash."""
    def read(batches):
        for batch in batches:
            found = np.concatenate([np.zeros(0, np.uint64), *_per_text(batch, lambda s: s)])
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], names=["key"])
    total = docs.count()
    sample = docs.where(F.pmod(F.xxhash64("key_id", "key_hash"), F.lit(1 << 20)) < (SAMPLE_DOCS << 20) // max(total, SAMPLE_DOCS))
    counts = sample.select("key_id", "t").mapInArrow(read, "key bigint").groupBy("key").agg(
        F.count("*").alias("n")).where(F.col("n") >= COMMON).orderBy(F.desc("n"), "key").limit(COMMON_SHINGLES).collect()
    counts.sort(key=lambda r: r["key"] & (1 << 64) - 1)
    return np.array([r["key"] & (1 << 64) - 1 for r in counts], np.uint64), np.array([r["n"] for r in counts], np.int64)


def parity(found: np.ndarray, longs: int = PARITY) -> np.ndarray:
    """Of how many shingles fall on each bit, the last bit. Two sets differ in as many shingles at least as in bits.

    The two halves, one turned over the other by xor, are the parities for half the longs."""
    counts = np.bincount((found & np.uint64(64 * longs - 1)).astype(np.int64), minlength=64 * longs)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def parity_longs(n: int) -> int:
    longs = PARITY
    while 64 * longs < n:
        longs *= 2
    return longs


def _bits_between(p: Column, q: Column) -> Column:
    """In how many bits two parities differ, of which one may have twice the longs; else the result is null."""
    def half(bits):
        size = (F.size(bits) / 2).cast("int")
        return F.zip_with(F.slice(bits, 1, size), F.slice(bits, size + 1, size), lambda x, y: x.bitwiseXOR(y))
    one, other = F.when(F.size(p) > F.size(q), half(p)).otherwise(p), F.when(F.size(q) > F.size(p), half(q)).otherwise(q)
    return F.aggregate(F.zip_with(one, other, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)


def fingerprint(found: np.ndarray) -> int:
    """Majority of the bits over the shingles of a set, as a signed long; zero without shingles."""
    counts = sum((ones(found[i:i + PIECE]) for i in range(0, len(found), PIECE)), np.zeros(64, np.int64))
    value = majority(counts, len(found))
    return value - (1 << 64) if value >> 63 else value


def prefixes(docs: DataFrame) -> DataFrame:
    """``(doc_id, key_id, key_hash, set_id, n, prefix, parity, fp)`` of each row of ``docs(doc_id, t, key_id, key_hash)``."""
    heads, times = common_shingles(docs)

    def prefix(found):
        often = np.zeros(len(found), np.int64)
        if len(heads):
            at = np.minimum(np.searchsorted(heads, found), len(heads) - 1)
            often = np.where(heads[at] == found, times[at], 0)
        first = np.argsort(often, kind="stable")[:prefix_length(len(found))]
        return _set_id(found), len(found), found[first].view(np.int64), parity(found, parity_longs(len(found))), fingerprint(found)

    def read(batches):
        for batch in batches:
            ids, sizes, firsts, bits, prints = zip(*_per_text(batch, prefix)) if batch.num_rows else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), batch.column(3), pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()),
                 pa.array(firsts, pa.list_(pa.int64())), pa.array(bits, pa.list_(pa.int64())), pa.array(prints, pa.int64())],
                names=["doc_id", "key_id", "key_hash", "set_id", "n", "prefix", "parity", "fp"])
    return docs.select("doc_id", "t", "key_id", "key_hash").mapInArrow(
        read, "doc_id bigint, key_id bigint, key_hash bigint, set_id bigint, n bigint, prefix array<bigint>, parity array<bigint>, fp bigint")


def size_class(n) -> np.ndarray:
    return np.floor(np.log(np.maximum(n, 1)) / np.log(SIZES) + 1e-9).astype(np.int64)


def _keys(batch, column):
    """(key, row, position, lower) of each shingle of the prefixes of a batch, in the size class of its set and, as lower, in the next."""
    shingles = batch.column(column).flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    lengths = batch.column(column).value_lengths().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(lengths)), lengths)
    pos = np.arange(len(row)) - (np.cumsum(lengths) - lengths)[row]
    sizes = size_class(batch.column("n").to_numpy())[row]
    keys = [(shingles ^ (sizes + more).astype(np.uint64) * np.uint64(_MIX[0])) * np.uint64(_MIX[1]) for more in (0, 1)]
    keys = [k ^ k >> np.uint64(32) for k in keys]
    return np.concatenate(keys).view(np.int64), np.tile(row, 2), np.tile(pos, 2), np.repeat([False, True], len(row))


def shared_prefixes(scratch: Scratch, sets: DataFrame) -> DataFrame:
    """``(key, set_id, n, pos, lower)`` of the keys of ``sets`` that two of them have at least, of which one is in its own class."""
    def only_keys(batches):
        for batch in batches:
            keys, _, _, lower = _keys(batch, "prefix")
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.where(lower, 1, OWN))], names=["key", "counts"])
    counted = sets.select("n", "prefix").mapInArrow(only_keys, "key bigint, counts bigint").groupBy("key").agg(F.sum("counts").alias("many"))
    shared = scratch.keep(counted.where(F.col("many") > OWN).select("key"), "shared-keys")
    table = bit_table(shared, "key", shared.count())

    def marked(batches):
        for batch in batches:
            keys, row, pos, lower = _keys(batch, "prefix")
            fine = np.flatnonzero(has_bit(table, keys))
            at = pa.array(row[fine])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[fine]), batch.column("set_id").take(at), batch.column("n").take(at), pa.array(pos[fine].astype(np.int32)),
                 pa.array(lower[fine])], names=["key", "set_id", "n", "pos", "lower"])
    rows = sets.select("set_id", "n", "prefix").mapInArrow(marked, "key bigint, set_id bigint, n bigint, pos int, lower boolean")
    kept = scratch.keep(rows.join(shared, "key", "left_semi"), "shared-prefixes")
    scratch.drop(shared)
    return kept


def _verified(scratch: Scratch, pairs: DataFrame, sets: DataFrame, docs: DataFrame) -> DataFrame:
    """``pairs(a, b)`` of set ids that are similar. Parities come first; then sets are made again, of the texts in question only."""
    bits = sets.select("set_id", "n", "parity")
    both = F.col("m") + F.col("k")      # sizes within 1.25 of each other: their parities have as many longs, or twice as many
    close = scratch.keep(pairs.join(bits.toDF("a", "m", "p"), "a").join(bits.toDF("b", "k", "q"), "b").where(
        (9 * F.least("m", "k") >= 4 * both) & (9 * _bits_between(F.col("p"), F.col("q")) <= both)).select("a", "b"), "close-pairs")
    if close.isEmpty():
        return close
    one = scratch.keep(sets.select("set_id", "key_id", "key_hash").join(
        close.select(F.explode(F.array("a", "b")).alias("set_id")).distinct(), "set_id", "left_semi").withColumn(
        "mark", F.xxhash64("key_id", "key_hash")), "asked-sets")
    table = bit_table(one, "mark", one.count())

    def sets_of(batches):
        for batch in batches:
            batch = batch.filter(pa.array(has_bit(table, batch.column(0).to_numpy())))
            yield pa.RecordBatch.from_arrays([batch.column(2), batch.column(3), pa.array(
                _per_text(batch, lambda s: s.tobytes()), pa.binary())], names=["key_id", "key_hash", "shingles"])

    def hold(batches):
        for batch in batches:
            keep = [similar(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)) for a, b in
                    zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep, pa.bool_())) for c in batch.columns[:2]], names=["a", "b"])
    made = docs.select(F.xxhash64("key_id", "key_hash").alias("mark"), "t", "key_id", "key_hash").mapInArrow(
        sets_of, "key_id bigint, key_hash bigint, shingles binary")
    asked = scratch.keep(made.join(broadcast_if_bounded(one), ["key_id", "key_hash"]).dropDuplicates(["set_id"]).select("set_id", "shingles"), "shingle-sets")
    found = scratch.keep(close.join(asked.toDF("a", "s"), "a").join(asked.toDF("b", "r"), "b").select("a", "b", "s", "r").mapInArrow(
        hold, "a bigint, b bigint"), "similar-sets")
    scratch.drop(close, one, asked)
    return found


def _possible(x: str, y: str):
    """Whether sets of two components whose first common shingle is at these positions can be similar, by their sizes; not if both
    are lower."""
    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    most = F.least(n - F.col(f"{x}.pos"), m - F.col(f"{y}.pos"))
    apart = (F.col(f"{x}.component") != F.col(f"{y}.component")) & ~(F.col(f"{x}.lower") & F.col(f"{y}.lower"))
    return apart & (9 * most >= 4 * (n + m))


def _ordered(x: str, y: str):
    return [F.least(f"{x}.set_id", f"{y}.set_id").alias("a"), F.greatest(f"{x}.set_id", f"{y}.set_id").alias("b")]


def fingerprint_links(scratch: Scratch, sets: DataFrame, docs: DataFrame) -> DataFrame:
    """``(a, b)`` of sets that are similar, of those whose fingerprints link at two or fewer differing bits."""
    classes = scratch.keep(sets.groupBy("fp").agg(F.min("set_id").alias("first")), "fingerprints")
    across = close_links(classes.select("fp")).join(classes.toDF("a", "x"), "a").join(classes.toDF("b", "y"), "b").select(
        F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    within = sets.select("fp", "set_id").join(classes, "fp").where("set_id <> first").select(F.col("first").alias("a"), F.col("set_id").alias("b"))
    asked = scratch.keep(across.unionByName(within).distinct(), "close-fingerprints")
    found = _verified(scratch, asked, sets, docs)
    scratch.drop(classes, asked)
    return found


def _placed(rows: DataFrame, placed: DataFrame) -> DataFrame:
    """``rows`` with the components of their sets."""
    return rows.join(placed.toDF("set_id", "component"), "set_id", "left").withColumn("component", F.coalesce("component", "set_id"))


def _hubs(large: DataFrame, hubs: int) -> DataFrame:
    """Of each key of ``large`` at most ``hubs`` sets, from its largest component where a part has one of it, or all that are beside
    that component if these are few."""
    tops = large.groupBy("key", "component").agg(F.count("*").alias("own")).groupBy("key").agg(
        F.max(F.struct("own", "component")).alias("top"), F.sum("own").alias("total"))
    beside, few = F.col("component") != F.col("top.component"), FEW * (F.col("total") - F.col("top.own")) <= hubs
    part = F.when(few, F.col("set_id")).otherwise(F.pmod(F.xxhash64("set_id"), F.lit(hubs)))
    return large.join(tops, "key").where(beside | ~few).groupBy("key", part.alias("part")).agg(
        F.min(F.struct(beside.alias("beside"), "pos", "set_id", "n", "component", "lower")).alias("hub")).select("key", "hub.*").drop("beside")


def similar_links(scratch: Scratch, sets: DataFrame, docs: DataFrame, pairwise: int = PAIRWISE) -> DataFrame:
    """``(node, component)`` of the sets that are similar to others: as all pairs of 0.8 or more connect them."""
    close = fingerprint_links(scratch, sets, docs)
    placed, hubs = scratch.keep(components(close), "placed"), 1
    scratch.drop(close)
    left = _placed(shared_prefixes(scratch, sets), broadcast_if_bounded(placed))
    while True:
        # what is left of a key needs two components at least, sets that aren't too long for its shortest, and for lower ones
        # another component in its own class
        owner = F.when(~F.col("lower"), F.col("component"))
        of_key = left.groupBy("key").agg(F.count("*").alias("many"), F.min("component").alias("least"), F.max("component").alias("most"),
                                         F.min("n").alias("shortest"), F.max(F.col("n") - F.col("pos")).alias("longest"),
                                         F.min(owner).alias("first"), F.max(owner).alias("last")
                                         ).where("least < most and first is not null").drop("least", "most")
        reach = F.least(F.col("n") - F.col("pos"), F.col("longest"))
        asks = ~F.col("lower") | (F.col("component") != F.col("first")) | (F.col("component") != F.col("last"))
        open_ = scratch.keep(left.join(of_key, "key").where(asks & (9 * reach >= 4 * (F.col("n") + F.col("shortest")))).select(
            "key", "set_id", "n", "pos", "lower", "component", "many"), "open-keys")
        if open_.isEmpty():
            return placed
        small, large = open_.where(F.col("many") <= pairwise), open_.where(F.col("many") > pairwise)
        x, y = small.alias("x"), small.toDF(*small.columns).alias("y")
        pairs = x.join(y, F.col("x.key") == F.col("y.key")).where((F.col("x.set_id") < F.col("y.set_id")) & _possible("x", "y"))
        chosen = scratch.keep(_hubs(large, hubs), "hubs")
        x, y = large.alias("x"), chosen.alias("y")
        held = x.join(y, F.col("x.key") == F.col("y.key")).where((F.col("x.set_id") != F.col("y.set_id")) & _possible("x", "y"))
        asked = scratch.keep(pairs.select(*_ordered("x", "y")).unionByName(held.select(*_ordered("x", "y"))).distinct(), "candidates")
        now = placed
        if not asked.isEmpty():
            found = _verified(scratch, asked, sets, docs)
            if not found.isEmpty():
                now = scratch.keep(components(found.unionByName(placed.toDF("a", "b"))), "placed")
                scratch.drop(placed)
            scratch.drop(found)
        rest = large.join(chosen.select("key", "set_id").toDF("key", "set_id"), ["key", "set_id"], "left_anti").select("key", "set_id", "n", "pos", "lower")
        rest = scratch.keep(_placed(rest, now), "left-prefixes")
        scratch.drop(asked, chosen, open_, left)
        left, placed, hubs = rest, now, max(pairwise, 2 * hubs)
        if left.isEmpty():
            return placed


def distinct_sets(scratch: Scratch, texts: DataFrame):
    """The sets of ``texts(doc_id, t, key_id, key_hash)``: the set of each row, and one row per set."""
    prints = scratch.keep(prefixes(texts), "prefixes")
    members = scratch.keep(prints.select("doc_id", "key_id", "key_hash", "set_id"), "set-members")
    sets = scratch.keep(prints.groupBy("set_id").agg(F.min(F.struct("key_id", "key_hash", "n", "prefix", "parity", "fp")).alias("one")).select(
        "set_id", "one.*"), "sets")
    scratch.drop(prints)
    return members, sets


def near_copies(docs: DataFrame, pairwise: int = PAIRWISE) -> DataFrame:
    """``docs(doc_id, text)`` -> ``(doc_id, component, key_id, key_hash)``, one row per row of ``docs``.

    Rows have one component if a chain of pairs at a similarity of 0.8 or more joins them. Texts that are null or have no
    words have one set, which is empty.
    """
    small_batches(docs.sparkSession)
    scratch = Scratch(docs.sparkSession)
    texts = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), utf8(docs["text"]).alias("t"), *row_key(docs))
    members, sets = distinct_sets(scratch, texts)
    placed = similar_links(scratch, sets, texts, pairwise).withColumnRenamed("node", "set_id")
    return members.join(placed, "set_id", "left").select(
        "doc_id", F.coalesce("component", "set_id").alias("component"), "key_id", "key_hash")
