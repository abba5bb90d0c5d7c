"""Image operators on Spark's image structs (rows of bytes, blue first)."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..functions.store import DEFAULT_BOX

# OpenCV type codes of the struct by number of bands.
MODES = {1: 0, 3: 16, 4: 24}
# Fixed value: half-width of the Lanczos window.
LOBES = 3
# What ``error`` says of a file that could not be decoded.
UNREADABLE = "unreadable"
_WHITE = 255
# Rows or columns resampled at once.
_STRIP = 256


def flatten_alpha(pixels: np.ndarray) -> np.ndarray:
    """Three bands: alpha laid over white, grey repeated."""
    bands = pixels.shape[2]
    if bands == 3:
        return pixels
    if bands == 1:
        return np.repeat(pixels, 3, axis=2)
    alpha = pixels[:, :, 3:].astype(np.int32)
    mixed = pixels[:, :, :3].astype(np.int32) * alpha + _WHITE * (255 - alpha) + 128
    # Division by 255 with rounding.
    return ((mixed + (mixed >> 8)) >> 8).astype(np.uint8)


def lanczos_weights(source: int, target: int) -> np.ndarray:
    """``target`` by ``source`` matrix that resamples one axis; each row sums to one."""
    stretch = max(source / target, 1.0)
    centres = (np.arange(target) + 0.5) * (source / target)
    offsets = (np.arange(source) + 0.5 - centres[:, None]) / stretch
    weights = np.where(np.abs(offsets) < LOBES, np.sinc(offsets) * np.sinc(offsets / LOBES), 0.0)
    return weights / weights.sum(axis=1, keepdims=True)


def _to_bytes(values: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(values + 0.5), 0, 255).astype(np.uint8)


def _taps(weights: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """The non-zero weights, one per target and tap: source places and weights."""
    used = weights != 0
    first, most = used.argmax(axis=1), int(used.sum(axis=1).max())
    places = np.minimum(first[:, None] + np.arange(most), weights.shape[1] - 1)
    fresh = first[:, None] + np.arange(most) < weights.shape[1]
    taken = np.where(fresh, np.take_along_axis(weights, places, axis=1), 0.0)
    return [(places[:, k], taken[:, k]) for k in range(most)]


@lru_cache(maxsize=64)
def axis_taps(source: int, target: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Taps of one axis; images of a folder mostly share a few sizes."""
    return _taps(lanczos_weights(source, target))


def resample(pixels: np.ndarray, width: int, height: int) -> np.ndarray:
    """Separable Lanczos: rows first, rounded to bytes, then columns; only taps with weight are summed."""
    across, down = axis_taps(pixels.shape[1], width), axis_taps(pixels.shape[0], height)
    rows, _, bands = pixels.shape
    # A strip at a time, so that an image is never held as doubles whole.
    wide = np.empty((rows, width, bands), np.uint8)
    for at in range(0, rows, _STRIP):
        strip = pixels[at : at + _STRIP]
        wide[at : at + _STRIP] = _to_bytes(sum(strip[:, place] * weight[:, None] for place, weight in across))
    out = np.empty((height, width, bands), np.uint8)
    for at in range(0, width, _STRIP):
        strip = wide[:, at : at + _STRIP]
        out[:, at : at + _STRIP] = _to_bytes(sum(strip[place] * weight[:, None, None] for place, weight in down))
    return out


def fitted_size(width: int, height: int, box: int) -> tuple[int, int]:
    scale = min(box / float(max(width, height)), 1.0)
    return (int(width * scale), int(height * scale)) if scale < 1.0 else (width, height)


def _each_image(images: DataFrame, change: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """Apply ``change`` to each image; an image it fails on, or that could
    not be decoded, keeps its row, without pixels and with ``error``."""
    schema = T.StructType([*images.schema.fields, T.StructField("error", T.StringType())])
    changed = ["height", "width", "nChannels", "mode", "data", "error"]

    def one(height: int, width: int, bands: int, data: bytes) -> tuple:
        if height <= 0 or width <= 0:
            return height, width, bands, -1, None, UNREADABLE
        try:
            out = np.ascontiguousarray(change(np.frombuffer(data, dtype=np.uint8).reshape(height, width, bands)))
            return out.shape[0], out.shape[1], out.shape[2], MODES[out.shape[2]], out.tobytes(), None
        except Exception as failure:  # noqa: BLE001
            return height, width, bands, -1, None, f"{type(failure).__name__}: {failure}"

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            rows = [one(*r) for r in zip(batch["height"], batch["width"], batch["nChannels"], batch["data"])]
            batch[changed] = pd.DataFrame(rows, index=batch.index, columns=changed)
            yield batch[schema.fieldNames()]

    return images.mapInPandas(apply, schema)


def flattened(images: DataFrame) -> DataFrame:
    """Every image with three bands. Other columns pass through."""
    return _each_image(images, flatten_alpha)


def resized(images: DataFrame, box: int = DEFAULT_BOX) -> DataFrame:
    """Every image with three bands and its longest edge within ``box``; never enlarged."""

    def shrink(pixels: np.ndarray) -> np.ndarray:
        plain = flatten_alpha(pixels)
        width, height = fitted_size(pixels.shape[1], pixels.shape[0], box)
        if (height, width) == plain.shape[:2]:
            return plain
        return resample(plain, max(width, 1), max(height, 1))

    return _each_image(images, shrink)
