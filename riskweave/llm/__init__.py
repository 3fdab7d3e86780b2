"""Operators for large-scale training-data pipelines (search, dedup, filters, packing, codecs)."""
