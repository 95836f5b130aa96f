"""From an inventory to a bound, assigned plan in one call."""

from pyspark.sql import DataFrame, functions as F

from .materialize import snapshot
from .operators.joins import bind_targets
from .operators.keys import attach_metadata
from .operators.records import aligned_parts, locate_boundaries
from .plans.grid import grid_assign, split_rebase
from .plans.indexing import build_plan, unique_objects

FEATURES = (None, "split", "fastq")


def plan_transfer(objects: DataFrame, direction: str = "download", chunk_size=None, n_nodes: int = None,
                  feature: str = None, targets: DataFrame = None, metadata=None, reduced_redundancy: bool = False,
                  unique_keys: bool = False, source=None) -> DataFrame:
    """The plan of a transfer: chunk list, node per chunk, split offsets, targets, metadata.

    ``feature`` is None (nodes share one target), 'split' (each node writes a file of its own) or 'fastq' (the same, cut
    at record starts, for which ``source`` is read; chunks are those of ``aligned_parts``). Only one can be given.
    """
    if feature not in FEATURES:
        raise ValueError(f"feature is one of {FEATURES}, not {feature!r}")
    if feature and not n_nodes:
        raise ValueError("a split needs a number of nodes")
    if feature == "fastq" and source is None:
        raise ValueError("record starts are found in the source")
    if feature and direction != "download":
        raise ValueError("only downloads are split")
    plan = build_plan(objects, direction, chunk_size, unique_keys)
    if n_nodes:
        plan = grid_assign(plan, n_nodes)
    if feature == "split":
        plan = split_rebase(plan, n_nodes)
    if feature == "fastq":
        sized = snapshot(unique_objects(objects), "fastq-objects")
        plan = aligned_parts(locate_boundaries(sized, snapshot(plan, "nominal-plan"), source, chunk_size), chunk_size)
        plan = plan.withColumn("n_parts", F.col("node_parts"))
    if targets is not None:
        plan = bind_targets(plan, targets)
    if metadata is not None or reduced_redundancy:
        plan = attach_metadata(plan, metadata or (), reduced_redundancy)
    return plan
