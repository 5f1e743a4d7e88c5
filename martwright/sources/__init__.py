"""Readers and writers for files, databases and message brokers."""
