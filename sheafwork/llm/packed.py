"""Sorted integer arrays as compact rows, and array files in the shared folder.

Counting over billions of small keys is cheaper when a row carries a sorted array of keys instead of
one key: a task adds up what it has, cuts the arrays by key range or hash, and sends one row per part.
Differences of sorted keys are small, and laid out byte plane by byte plane they compress well.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow.fs as pafs


def planes(values: np.ndarray) -> bytes:
    """Whole numbers from 0 on, in the narrowest width that holds them, byte plane by byte plane."""
    narrow = values.astype(np.min_scalar_type(int(values.max(initial=0))))
    width = narrow.dtype.itemsize
    return bytes([width]) + np.ascontiguousarray(narrow).view(np.uint8).reshape(-1, width).T.tobytes()


def from_planes(data: bytes, dtype) -> np.ndarray:
    width = data[0]
    rows = np.frombuffer(data, np.uint8, offset=1).reshape(width, -1)
    return np.ascontiguousarray(rows.T).view(f"<u{width}").ravel().astype(dtype)


def pack(keys: np.ndarray) -> bytes:
    """Ascending ``uint64`` keys."""
    return planes(np.diff(keys, prepend=np.uint64(0)))


def unpack(data: bytes) -> np.ndarray:
    return np.cumsum(from_planes(data, np.uint64), dtype=np.uint64)


def summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, and the sums of their values."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    if not len(keys):
        return (keys, *values)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return (keys[first], *[np.add.reduceat(v[order], first) for v in values])


def part_bits(parts: int) -> int:
    """Number of leading bits that cut hashes into at least ``parts`` parts."""
    return max(4, (max(1, parts) - 1).bit_length())


def write_array(folder: str, name: str, values: np.ndarray) -> None:
    """Write an array file; a task that runs again writes the same bytes and replaces the file whole."""
    data, parsed = np.ascontiguousarray(values).tobytes(), urlparse(folder)
    if parsed.scheme in ("", "file"):
        place = unquote(parsed.path) if parsed.scheme else folder
        os.makedirs(place, exist_ok=True)
        draft = f"{place}/.{name}-{uuid.uuid4().hex}"
        with open(draft, "wb") as out:
            out.write(data)
        os.replace(draft, f"{place}/{name}")
        return
    system, place = pafs.FileSystem.from_uri(folder)
    system.create_dir(place, recursive=True)
    draft = f"{place}/.{name}-{uuid.uuid4().hex}"
    with system.open_output_stream(draft) as out:
        out.write(data)
    system.move(draft, f"{place}/{name}")


def map_array(folder: str, name: str, dtype) -> np.ndarray:
    """Memory-map an array file. From a store without local paths it is copied first, and the copy is
    removed as soon as it is mapped, so that nothing stays behind on the executor."""
    parsed = urlparse(folder)
    if parsed.scheme in ("", "file"):
        place = unquote(parsed.path) if parsed.scheme else folder
        path = f"{place}/{name}"
        return np.memmap(path, dtype, "r") if os.path.getsize(path) else np.empty(0, dtype)
    system, place = pafs.FileSystem.from_uri(folder)
    handle, copy = tempfile.mkstemp()
    try:
        with os.fdopen(handle, "wb") as out, system.open_input_stream(f"{place}/{name}") as source:
            while block := source.read(1 << 20):
                out.write(block)
        return np.memmap(copy, dtype, "r") if os.path.getsize(copy) else np.empty(0, dtype)
    finally:
        os.unlink(copy)
