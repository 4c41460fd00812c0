"""Operators: each takes DataFrames and keyword parameters and returns a DataFrame."""
