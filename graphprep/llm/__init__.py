"""Operators of a training-data pipeline: scoring, filtering, near duplicates, mixing, packing and sharding of documents."""
