"""Operators for training-data corpora: extraction, filters, near-duplicates, secrets, mixing, tokens and archives."""
