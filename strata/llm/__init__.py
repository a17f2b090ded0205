"""Training-data operators (tokenising, dedup, quality, mixing, extraction) for Spark tables."""
