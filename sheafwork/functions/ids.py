"""Ids as text, and cleaning of id lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_id(col: Column) -> Column:
    """Ids are compared as text, so ``007`` and ``7`` stay different."""
    return col.cast("string")


# The characters Python's str.strip() takes off.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(col: Column) -> Column:
    """Strip every kind of white space; plain ``trim`` would take off blanks only."""
    return F.btrim(col, F.lit(WHITE_SPACE))
