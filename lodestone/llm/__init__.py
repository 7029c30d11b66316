"""Operators for preparing training data: deduplication, language, mixing, search, packing.

Each module holds one operator with its own interface; ``queries`` holds the registered
queries that apply them to the given tables.
"""
