"""Operators of a training-data pipeline: scoring, search, filtering,
fingerprints, chat formatting, packing, near-duplicates, secrets, mixing and
language identification.  Nothing else in the library imports this package.
"""
