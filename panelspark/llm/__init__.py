"""Training-data operators: extraction, filtering, deduplication, tokenising, packing, search.

Nothing outside this subpackage imports it; ``__spark_entry__`` adds its queries when it is there.
"""
