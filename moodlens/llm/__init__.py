"""Operators for preparing training text: deduplication, packing, encoding, extraction, archives, search, quality.

Nothing else in the library imports this package; its queries are registered by ``queries.py``.
"""
