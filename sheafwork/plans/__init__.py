"""Whole jobs, each a composition of operators, sources and sinks."""
