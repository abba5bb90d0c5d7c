"""Store layout, file names and size gates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Second prefix of a short stem, refetch limit and resize limit in MB.
SHORT_STEM = "000"
REFETCH_BELOW_MB = 0.01
RESIZE_FROM_MB = 2.0
# Fixed value: image file extensions, found in all-lower or all-upper case only.
IMAGE_EXTENSIONS = ("jpg", "jpeg", "png", "tif", "tiff")
# Fixed value: longest edge of a resized image unless the caller names one.
DEFAULT_BOX = 1600
STORE_BOX = 1024


def prefix1(stem: Column) -> Column:
    return F.substring(stem, 1, 3)


def prefix2(stem: Column) -> Column:
    """Characters 4 to 6, only when all three are there."""
    return F.when(F.length(stem) >= 6, F.substring(stem, 4, 3)).otherwise(SHORT_STEM)


def store_path(base: str, stem: Column, file_name: Column | None = None) -> Column:
    name = F.concat(stem, F.lit(".jpg")) if file_name is None else file_name
    return F.concat_ws("/", F.lit(base), prefix1(stem), prefix2(stem), name)


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem_of(path: Column) -> Column:
    """Name without its last extension; a name that only starts with a dot keeps it."""
    return F.regexp_replace(base_name(path), r"(?<=.)\.[^.]*$", "")


def extension_of(path: Column) -> Column:
    return F.regexp_extract(base_name(path), r"\.([^.]*)$", 1)


def is_image_file(path: Column, extensions: tuple[str, ...] = IMAGE_EXTENSIONS) -> Column:
    names = [form for e in extensions for form in (e.lower(), e.upper())]
    return path.rlike(r"\.(" + "|".join(names) + ")$")


def is_numeric_stem(stem: Column) -> Column:
    return stem.rlike("^[0-9]+$")


def size_mb(length: Column) -> Column:
    return length.cast("double") / F.lit(1048576.0).cast("double")


def resize_gate(length: Column) -> Column:
    mb = size_mb(length)
    return (
        F.when(mb == 0, "skip_empty")
        .when(mb < F.lit(RESIZE_FROM_MB).cast("double"), "skip_small")
        .otherwise("resize")
    )


def fit_edge(edge: Column, width: Column, height: Column, box: int) -> Column:
    """One edge after fitting the image into ``box`` without enlarging it.

    The scale stays a double on purpose: truncation then gives the same edge as plain floating
    point does, which is sometimes one short.
    """
    scale = F.least(F.lit(float(box)) / F.greatest(width, height).cast("double"), F.lit(1.0))
    return F.floor(edge.cast("double") * scale).cast("int")
