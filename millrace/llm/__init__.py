"""Operators for training data: mixing, packing, filters, extraction, deduplication, secrets."""
