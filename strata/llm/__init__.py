"""Training-data operators: dedup, scans, scoring, mixing, packing and search.

Nothing else in the library imports this subpackage.
"""
