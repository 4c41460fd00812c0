"""Operators for large training-data corpora, each a function from DataFrames to a DataFrame."""
