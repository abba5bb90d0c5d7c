"""Operators of a training-data pipeline: filters, search, deduplication, mixing, sharding, tokens, models."""

from .oracles import ORACLES
from .queries import QUERIES

__all__ = ["ORACLES", "QUERIES"]
