"""Operators for preparing text corpora: cleaning, deduplication, tokens, shards."""
