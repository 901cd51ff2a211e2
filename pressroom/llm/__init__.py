"""Operators of a training-data pipeline: archives, filters, fingerprints, near duplicates, mixing, packing.

Nothing outside this folder and ``corpus_pipeline.py`` imports it.
"""
