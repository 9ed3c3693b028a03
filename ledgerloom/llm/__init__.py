"""Operators for preparing training data: tokens, duplicates, filters, search, packing."""
