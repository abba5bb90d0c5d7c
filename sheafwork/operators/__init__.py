"""Joins, aggregations, ordered work and image operators, all DataFrame to DataFrame."""
