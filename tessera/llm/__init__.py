"""Training-data operators: filters, near-duplicates, search, packing and outputs.

Nothing else in the library imports this subpackage.
"""
