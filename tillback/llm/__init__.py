"""Operators for preparing large text collections: cleaning, near-duplicates, search, formatting, packing."""
