"""Operators for large training-data pipelines (text quality, deduplication, tokens, archives).

Nothing else in the library imports this subpackage.
"""
