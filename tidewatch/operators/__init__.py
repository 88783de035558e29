"""Operators: each takes DataFrames and column roles and returns a DataFrame."""
