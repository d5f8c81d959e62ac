"""Operators for large training-corpus preparation.

Nothing else in the library imports this subpackage; the query registry is
``tidemark.llm.queries``.
"""
