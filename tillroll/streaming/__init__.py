"""Structured Streaming form of the incremental keyed merge."""
