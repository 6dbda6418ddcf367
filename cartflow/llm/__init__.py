"""Operators for building training corpora: cleaning, deduplication, mixing, scoring, encoding."""
