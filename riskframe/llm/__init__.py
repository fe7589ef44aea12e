"""Training-data operators: decontamination, dedup, sharding, privacy, packing, quality, language, extraction.

Nothing outside this package (and the repository's corpus_pipeline.py) imports it.
"""
