"""Structured Streaming: the per-track violation detector as keyed state."""
