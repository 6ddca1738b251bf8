"""Training-data operators: scoring, filtering, deduplication, mixing, packing, search.

Nothing outside this package imports it; `queries.py` registers the thin queries.
"""
