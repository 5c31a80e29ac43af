"""Operators for training data made from text: quality, privacy, duplicates, tokens, packing, archives."""
