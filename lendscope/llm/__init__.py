"""Operators of a training-data pipeline: packing, quality, deduplication, counts, search, language, mixing.

Nothing else in the library imports this subpackage. Each operator takes DataFrames and returns a DataFrame;
``queries`` holds the thin registered queries.
"""
