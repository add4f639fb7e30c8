"""Training-data operators: deduplication, language ID, search, secret scans,
LM scoring, mixing and packing of large document tables.

Nothing outside this subpackage imports it; ``queries.py`` registers its
queries for the entry module.
"""
