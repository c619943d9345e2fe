"""Structured Streaming consumers over the message log."""
