"""Operators that prepare training data from text: filters, near-duplicates, packing and the like."""
