"""From raw documents to packed sequences: five stages, each written to the shared folder and read by the next."""

from pyspark.sql import DataFrame, SparkSession

from drayage.llm import decontaminate, nearcopies, packing, quality, simhash, suffixes
from drayage.llm.common import table
from drayage.materialize import snapshot
from drayage.shipping import ship


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted to ``labels``, doesn't reject."""
    ship(spark)
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, at 0.8 or more of their five-word shingles: that with the smallest id.

    SimHash fingerprints find the near ones, by blocks and bits; what they link is compared, and exact prefixes find the rest."""
    ship(spark)
    found = snapshot(nearcopies.near_copies(docs.select("doc_id", "text")), "near-copies")
    return simhash.one_of_each(docs, found)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the byte strings that occur earlier."""
    ship(spark)
    return suffixes.without_repeats(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated by ``benchmark``."""
    ship(spark)
    return decontaminate.uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of 2048 tokens."""
    ship(spark)
    return packing.pack(docs, packing.public_vocabulary, packing.public_ranks, packing.public_pattern)


STAGES = [
    ("quality_classifier", accept_quality),
    ("simhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeats),
    ("benchmark_decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

ORACLE_SQL = None   # a fitted network, a tokenizer and the choice of bins aren't SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = snapshot(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
