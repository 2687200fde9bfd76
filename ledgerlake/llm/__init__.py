"""Operators for large-scale training-data pipelines.

Nothing outside this package imports it; ``queries.py`` holds the registered
queries and their oracle SQL.
"""
