"""Operators for preparing training corpora: scanning, scoring, deduplicating, mixing, packing."""
