"""Operators for training-data pipelines: filters, near duplicates, mixing, formatting, packing, counting, scoring."""
