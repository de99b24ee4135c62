"""Training-data operators: deduplication, scans, sharding, tokenizing, scoring.

Nothing outside this folder imports it; ``queries.py`` registers its queries.
"""
