"""Operators of a training-data pipeline: quality, language, near-duplicates,
decontamination, packing and scans over documents, pages and embeddings.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
