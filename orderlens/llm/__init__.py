"""Operators of a training-data pipeline over ``documents`` tables.

Nothing outside this package (and ``corpus_pipeline.py``) imports it.
"""
