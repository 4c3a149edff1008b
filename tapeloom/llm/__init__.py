"""Training-data operators: deduplication, filtering, mixing, tokenising, scoring and search over documents."""
