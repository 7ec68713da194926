"""Structured Streaming operators and runners."""
