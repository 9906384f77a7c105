"""Operators of a training-data pipeline: dedup, mixing, packing, scoring, archives."""
