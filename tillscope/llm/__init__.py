"""Operators for preparing training data: fingerprints, archives, dedup, mixing, packing.

Nothing else in the library imports this subpackage.
"""
