"""Operators for training-data pipelines: deduplication, packing, language
identification, secret scans, mixing, sharding, language-model scoring.

Nothing else in the library imports this subpackage; it may import general
helpers from the library.  ``registry`` holds the checked queries.
"""
