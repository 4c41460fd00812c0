"""Whole workflows and the queries that run them."""
