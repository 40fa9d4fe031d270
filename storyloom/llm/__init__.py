"""Operators that prepare training data: dedup, decontamination, scans, packing, formatting, quality."""
