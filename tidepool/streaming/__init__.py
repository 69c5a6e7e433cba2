"""Structured Streaming forms; each agrees with a batch operator on the same rows."""
