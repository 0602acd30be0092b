"""Operators for preparing training text: quality, duplicates, contamination, mixing, sharding and token output."""
