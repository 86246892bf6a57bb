"""Operators for preparing training text: deduplication, filtering, scoring, counting and packing."""
