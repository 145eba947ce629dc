"""Operators of a training-data pipeline: tokens, near-duplicates, filters, packing, search.

Nothing else in the library imports this subpackage.
"""
