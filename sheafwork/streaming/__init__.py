"""Keyed state kept over arriving attempts, as Structured Streaming queries."""
