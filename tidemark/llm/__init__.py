"""Operators for preparing training data: personal data, near-duplicates, quality, packing,
secrets, token files, sharding, repeated passages and benchmark contamination."""
