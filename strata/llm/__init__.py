"""Operators for large-scale training-data pipelines.

Nothing outside this package imports it; ``queries.py`` and ``corpus_pipeline.py`` expose it.
"""
