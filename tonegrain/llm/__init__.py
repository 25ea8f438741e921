"""Operators for preparing training data: one module per operator, queries and SQL in their own modules."""
