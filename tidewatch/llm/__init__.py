"""Operators for training-data pipelines over `documents`-like tables. Nothing outside this package imports it."""
