"""Operators for large training corpora, each written as Spark jobs.

Nothing outside this package (and ``corpus_pipeline.py``) imports it.
"""
