"""Operators for training-data corpora: shards, filters, duplicates, mixtures."""
