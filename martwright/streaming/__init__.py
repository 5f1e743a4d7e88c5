"""Structured Streaming jobs: campaign notifications, order vault, running counters."""
