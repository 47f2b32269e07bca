"""Training-data operators: deduplication, tokens, mixing, sharding, quality, web archives."""
