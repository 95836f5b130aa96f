"""Near-duplicate texts by SimHash fingerprints, with pigeonhole blocks.

A fingerprint is cut into five blocks. Two that differ in at most two bits agree on three blocks at least, so they meet
under one of the ten keys made of three blocks, and are verified by their Hamming distance there. A key that many
different fingerprints share (a large group of near copies) isn't compared pair by pair: its fingerprints are linked by
their one-bit variants instead, which is exact too and linear in the size of the group.
"""

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..materialize import broadcast_if_bounded, snapshot
from .common import bit_table, has_bit, row_key, small_batches, table, utf8
from .components import components

SEED, SHINGLE, MAX_BITS, BLOCKS = 42, 3, 2, 5
PAIRWISE = 64       # fingerprints of a key that are compared pair by pair; more are linked by variants
PIECE = 1 << 16     # shingles hashed at once, bounds the memory of a long text


def ones(hashes: np.ndarray) -> np.ndarray:
    """How many of some 64-bit hashes have each bit set."""
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)


def majority(counts: np.ndarray, n: int) -> int:
    """The bits that are set in over half of ``n`` hashes."""
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Majority of the XXH64 bits over all shingles of ``shingle`` words, repeats included; zero without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = max(0, len(words) - shingle)
    heads, tails = starts[:last + 1].tolist(), ends[min(shingle, len(words)) - 1:].tolist()
    counts, one_hash = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for begin in range(0, last + 1, PIECE):
        hashes = np.array([one_hash(joined[a:b], SEED) for a, b in
                           zip(heads[begin:begin + PIECE], tails[begin:begin + PIECE])], np.uint64)
        counts += ones(hashes)
    return majority(counts, last + 1)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, fp, key_id, key_hash)`` of each row of ``docs(doc_id, text)``; fp as a signed long. A null text has no
    words."""
    def read(batches):
        for batch in batches:
            known, out = {}, []
            for text in batch.column(1).to_pylist():
                value = known.get(text)
                if value is None:
                    value = known[text] = fingerprint(text, shingle)
                out.append(value)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(out, np.uint64).view(np.int64)),
                                              batch.column(2), batch.column(3)], names=["doc_id", "fp", "key_id", "key_hash"])
    small_batches(docs.sparkSession)
    return docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), utf8(docs["text"]).alias("t"), *row_key(docs)
                       ).mapInArrow(read, "doc_id bigint, fp bigint, key_id bigint, key_hash bigint")


def block_masks(blocks: int = BLOCKS, bits: int = MAX_BITS) -> list[int]:
    """Masks of the keys: each choice of ``blocks - bits`` blocks, as signed longs."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    block = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(blocks)]
    masks = [sum(chosen) for chosen in itertools.combinations(block, blocks - bits)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def close_links(fps: DataFrame, pairwise: int = PAIRWISE) -> DataFrame:
    """``fps(fp)``, distinct -> ``(a, b)``: links that connect the same fingerprints as all pairs at Hamming distance
    two or less do; every link is such a pair."""
    masks = F.array(*[F.struct(F.lit(i).alias("k"), F.col("fp").bitwiseAND(F.lit(m)).alias("v"))
                      for i, m in enumerate(block_masks())])
    keyed = fps.select("fp", F.inline(masks))
    crowded = keyed.groupBy("k", "v").agg(F.count("*").alias("n")).where("n > 1")
    shared = snapshot(keyed.join(crowded, ["k", "v"]), "shared-blocks")
    few = shared.where(F.col("n") <= pairwise)
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS
    pairs = few.select("k", "v", F.col("fp").alias("a")).join(
        few.select("k", "v", F.col("fp").alias("b")), ["k", "v"]).where((F.col("a") < F.col("b")) & close)
    # two fingerprints at distance two or less have a common variant with at most one bit turned, and all that share
    # a variant (65 at most) are that close to each other
    turned = F.array(F.lit(0).cast("bigint"), *[F.lit(-(1 << 63) if i == 63 else 1 << i).cast("bigint")
                                                 for i in range(64)])
    many = shared.where(F.col("n") > pairwise).select("fp").distinct()
    variants = many.select("fp", F.explode(turned).alias("bit")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("bit")).alias("variant"))
    hubs = variants.groupBy("variant").agg(F.min("fp").alias("b"), F.max("fp").alias("m")).where("b < m")
    stars = variants.join(hubs, "variant").where("fp <> b").select(F.col("fp").alias("a"), "b")
    return pairs.select("a", "b").unionByName(stars).distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``docs(doc_id, text)`` -> ``(doc_id, fp, component_id, component, key_id, key_hash)``, one row per row of ``docs``.

    ``component_id`` is the smallest doc_id that can be reached by links at two or fewer bits. Equal texts, and repeated
    rows, have equal fingerprints and so one component. Texts that are null or have no words share fingerprint zero.
    A null doc_id is never the smallest; a component of such rows only has a null id. An empty table gives no rows.
    ``component`` names a component too, also where ids are null or occur twice; the keys are those of ``row_key``.
    """
    prints = snapshot(fingerprints(docs, shingle), "fingerprints")
    classes = snapshot(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fingerprint-classes")
    found = components(close_links(classes.select("fp")))
    placed = classes.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("component"))
    smallest = placed.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_print = snapshot(placed.join(smallest, "component").select("fp", "component_id", "component"), "fingerprint-components")
    return prints.join(by_print, "fp").select("doc_id", "fp", "component_id", "component", "key_id", "key_hash")


def representatives(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """The rows of ``docs``, with all their columns, less all but one of each component: the smallest doc_id stays.

    A null doc_id stays only in a component without others; of rows with one doc_id the smallest hash of the text stays,
    and of equal rows one.
    """
    return one_of_each(docs, near_duplicates(docs.select("doc_id", "text"), shingle))


def one_of_each(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of ``docs`` that :func:`representatives` keeps of the components ``found(component, key_id, key_hash)``."""
    key = F.struct(F.col("doc_id").isNull().alias("missing"), "key_id", "key_hash")
    kept = snapshot(found.groupBy("component").agg(F.min(F.struct(key.alias("key"), "component")).alias("one")).select(
        "one.key.key_id", "one.key.key_hash"), "representatives")
    # what isn't kept, and rows that repeat in id and text, of which one stays; all other texts are left where they are
    rows = found.groupBy("key_id", "key_hash").agg(F.count("*").alias("n")).join(
        kept.distinct().withColumn("stays", F.lit(True)), ["key_id", "key_hash"], "left")
    asked = snapshot(rows.where("n > 1 or stays is null").select("key_id", "key_hash", F.col("stays").isNotNull().alias("stays")), "asked-rows")
    n_asked = asked.count()
    if not n_asked:
        return docs
    bits = bit_table(asked.select(F.xxhash64("key_id", "key_hash").alias("mark")), "mark", n_asked)

    @F.arrow_udf("boolean")
    def may_be_asked(marks: pa.Array) -> pa.Array:
        return pa.array(has_bit(bits, marks.to_numpy()))
    names = ["_key_id", "_key_hash"]
    marked = docs.withColumns(dict(zip(names, row_key(docs)))).withColumn("_asked", may_be_asked(F.xxhash64(*names)))
    rest = marked.where("_asked").join(broadcast_if_bounded(asked.toDF(*names, "_stays")), names, "left").where(
        F.coalesce("_stays", F.lit(True))).dropDuplicates(names)
    return marked.where("not _asked").drop(*names, "_asked").unionByName(rest.drop(*names, "_asked", "_stays"))


def op10_simhash(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
