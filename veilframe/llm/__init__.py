"""Operators of a training-data pipeline: scans, filters, counts, packing, deduplication, quality, decontamination."""
