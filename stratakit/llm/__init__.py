"""Operators for building training data: near-duplicates, scans, language, mixing, sharding, packing, search."""
