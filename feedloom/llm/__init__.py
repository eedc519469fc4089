"""Operators of a training-data pipeline: scoring, filtering, matching, mixing and packing text."""
