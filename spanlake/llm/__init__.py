"""Training-data operators: search, deduplication, scoring, privacy, tokens and packing."""
