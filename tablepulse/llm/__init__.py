"""Operators for preparing training corpora (deduplication, classification, tokens, archives, mixing)."""
