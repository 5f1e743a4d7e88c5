"""Relational operators built from DataFrame joins, aggregations and windows."""
