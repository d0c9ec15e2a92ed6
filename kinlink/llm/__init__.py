"""Operators for building training data. Nothing else in kinlink imports this subpackage."""
