"""Operators of a training-data pipeline: extraction, formatting, matching, mixing.

Self-contained: nothing outside this folder, ``corpus_pipeline.py`` and
``tests/llm`` imports it.
"""
