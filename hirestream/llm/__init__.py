"""Operators of a training-data pipeline: mixing, quality, duplicates, scoring, search and packing."""
