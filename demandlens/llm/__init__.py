"""Operators of a training-data pipeline (sharding, mixing, filters, de-duplication, tokens).

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
