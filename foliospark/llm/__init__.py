"""Operators of a training-data pipeline: deduplication, scoring, extraction, packing, mixing and search for near copies."""
