"""Operators for preparing training text: tokens, language models, filters, deduplication, packing, search."""
