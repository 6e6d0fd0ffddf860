"""Operators for preparing training text: near and exact duplicates, search, language, tokens, packing, shards, privacy."""
