"""Operators of a training-data pipeline: search, archives, deduplication, decontamination, scoring and packing."""
