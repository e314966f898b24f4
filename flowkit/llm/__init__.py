"""Operators for training-data corpora: deduplication, extraction, tokens, mixing, classifiers and vector search."""
