"""Operators for large training corpora: language, quality, duplicates, tokens, packing, search, scoring.

Each module is one operator with its own interface; ``queries`` holds the
registered queries. Nothing outside this package (and ``corpus_pipeline.py``)
imports it.
"""
