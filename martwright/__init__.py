"""Warehouse loads, data marts and streaming jobs written on Spark DataFrames."""
