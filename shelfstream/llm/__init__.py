"""Operators of a pipeline that prepares training data."""
