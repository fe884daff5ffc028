"""Training-data operators: dedup, quality, mixing, packing and output formats.

Nothing else in the package imports this subpackage.
"""
