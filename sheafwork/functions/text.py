"""Captions and names."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

# The caption sentence, its parts in order, and what a missing part is printed as.
CAPTION = (
    "This is an image of species {species}, in the genus {genus} of family {family}. "
    "It is part of the collection of institution {institution}."
)
MISSING = "None"


def caption(species: Column, genus: Column, family: Column, institution: Column) -> Column:
    """The sentence as one concatenation, which costs far less per row than a format string."""
    parts = {"species": species, "genus": genus, "family": family, "institution": institution}
    pieces = []
    for literal, name, _, _ in Formatter().parse(CAPTION):
        pieces.append(F.lit(literal))
        if name:
            pieces.append(F.coalesce(parts[name], F.lit(MISSING)))
    return F.concat(*pieces)


def scientific_name(family: Column, genus: Column, species: Column) -> Column:
    return F.concat(family, F.lit(" "), genus, F.lit(" "), species)


def word(name: Column, index: int) -> Column:
    """Word ``index`` of a name, null when the name is shorter."""
    return F.get(F.split(name, " "), F.lit(index))
