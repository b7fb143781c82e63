"""Training-data operators: tokenisation, quality, deduplication, search, packing.

Nothing outside this subpackage imports it; its queries are in :mod:`volcast.llm.queries`.
"""
