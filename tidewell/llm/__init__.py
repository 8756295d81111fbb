"""Operators for preparing training text: fingerprints, near-duplicates, token stores, filters and mixes.

Nothing else in the library imports this subpackage.
"""
