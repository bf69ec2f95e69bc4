"""Training-data operators: deduplication, filtering, search, packing.

Nothing else in the library imports this subpackage.
"""
