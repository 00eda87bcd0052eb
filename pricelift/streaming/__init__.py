"""Structured Streaming: events in, priced windows out."""
