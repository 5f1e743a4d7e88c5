"""Operators for preparing training data, and their queries. Nothing outside imports this package."""
