"""Operators on documents, tokens and vectors for preparing training data.

Nothing else in the library imports this subpackage; its queries are in ``queries``.
"""
