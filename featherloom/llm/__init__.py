"""Operators of a training-data pipeline: scans, deduplication, quality, decontamination, mixing, sharding, formatting."""
