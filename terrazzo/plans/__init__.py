"""Whole plans: the mosaic pipeline and the registered queries."""
