"""Operators for large-scale training-data preparation.

Nothing else in the library imports this subpackage; ``queries`` registers its
queries and SQL with ``__spark_entry__``.
"""
