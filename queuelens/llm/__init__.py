"""Operators for preparing language-model training data, and the queries that run them.

Nothing else in the library imports this package.
"""
