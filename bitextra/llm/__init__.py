"""Operators for large language-model training data, and the queries that run them."""
