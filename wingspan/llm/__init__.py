"""Operators for large-scale training-data pipelines.

Each module is one operator; ``queries`` registers the thin driver queries
and the repository's ``corpus_pipeline.py`` chains five of the operators.
Nothing outside this subpackage imports it.
"""
