"""Whole-layer compositions and the query registry over the driver tables."""
