"""Explicit schemas of every input and output; nothing is inferred on read."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I = T.StringType(), T.LongType(), T.IntegerType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


# Columns of the catalogue file, by the names used in its header, and our names for them.
CATALOGUE_FILE = {"gbifID": ("gbif_id", L), "identifier": ("identifier", S), "countryCode": ("country_code", S)}

INVENTORY = _struct(("path", S), ("length", L))

ATTEMPTS = _struct(
    ("attempt_id", L),
    ("gbif_id", L),
    ("seq", I),
    ("url", S),
    ("ts", T.TimestampType()),
    ("status", I),
    ("error_kind", S),
    ("content_type", S),
    ("retry_after", S),
)

BUNDLE_2022 = _struct(
    ("annotations", T.ArrayType(_struct(("image_id", S), ("category_id", L), ("institution_id", L)))),
    ("images", T.ArrayType(_struct(("image_id", S), ("file_name", S)))),
    ("categories", T.ArrayType(_struct(("category_id", L), ("species", S), ("genus", S), ("family", S)))),
    ("institutions", T.ArrayType(_struct(("institution_id", L), ("collectionCode", S)))),
)

BUNDLE_2021 = _struct(
    ("annotations", T.ArrayType(_struct(("id", L), ("category_id", L), ("institution_id", L)))),
    ("images", T.ArrayType(_struct(("id", L), ("file_name", S)))),
    ("categories", T.ArrayType(_struct(("id", L), ("name", S), ("family", S)))),
    ("institutions", T.ArrayType(_struct(("id", L), ("name", S)))),
)

_SERVICE = _struct(("id", S))
_BODY = _struct(("service", T.ArrayType(_SERVICE)))
_PAGE = _struct(("type", S), ("items", T.ArrayType(_struct(("body", _BODY)))))
_CANVAS = _struct(("type", S), ("items", T.ArrayType(_PAGE)))
MANIFEST = _struct(("items", T.ArrayType(_CANVAS)))

# Columns of the labelled files, in the order they are written.
LABELLED = _struct(
    ("image_id", S),
    ("filename", S),
    ("caption", S),
    ("scientificName", S),
    ("family", S),
    ("genus", S),
    ("species", S),
    ("scientificNameEncoded", L),
)
