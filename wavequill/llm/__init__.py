"""Corpus operators for training data: filters, deduplication, mixing, sharding, tokenising, extraction."""
