"""Operators of a training-data pipeline: tokenising, scoring, filtering, de-duplication.

Nothing outside this subpackage, ``corpus_pipeline.py`` and ``tests/llm`` imports it.
"""
