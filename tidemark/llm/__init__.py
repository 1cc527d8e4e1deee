"""Operators for preparing training text: mixing, filtering, deduplication, formatting and packing."""
