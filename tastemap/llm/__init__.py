"""Operators that prepare training data: token files, shards, duplicates, filters, mixing, packing."""
