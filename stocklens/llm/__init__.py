"""Operators of a training-data pipeline: de-duplication, search, scoring, packing, mixing.

Nothing else in the library imports this package; ``queries`` holds the registered
queries and their SQL.
"""
