"""Training-data operators: quality, deduplication, safety, tokenising, packing.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
