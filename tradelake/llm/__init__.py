"""Training-data operators: scoring, search, packing, deduplication, archives, mixing."""
