"""Streams that drain what is there and stop: ingestion, quarantine, history, and windows over late events."""
