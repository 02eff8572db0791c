"""Operators for preparing training data.

Nothing outside this folder imports it, apart from the driver's entry module and ``corpus_pipeline.py``.
"""
