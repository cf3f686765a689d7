"""Operators for preparing training text: language, personal data, contamination, URLs, tokens, shards, quality."""
