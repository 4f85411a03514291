"""Operators for preparing text corpora: cleaning, deduplication, scoring, tokenising and packing."""
