"""Image structs written as files."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame

# PNG signature and colour types by number of bands.
_SIGNATURE = b"\x89PNG\r\n\x1a\n"
_COLOUR = {1: 0, 3: 2, 4: 6}


def png_bytes(pixels: np.ndarray) -> bytes:
    """Lossless file of ``height x width x bands`` bytes, blue first."""
    height, width, bands = pixels.shape
    if bands > 1:
        pixels = pixels[:, :, [2, 1, 0, 3][:bands]]
    lines = np.hstack([np.zeros((height, 1), np.uint8), pixels.reshape(height, width * bands)])

    def block(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    head = struct.pack(">IIBBBBB", width, height, 8, _COLOUR[bands], 0, 0, 0)
    return _SIGNATURE + block(b"IHDR", head) + block(b"IDAT", zlib.compress(lines.tobytes())) + block(b"IEND", b"")


def write_files(rows: DataFrame, folder: str) -> DataFrame:
    """Write ``name, content`` rows below ``folder``, from the tasks; gives ``path, length`` per file.

    Lazy like any transformation: the files are there once the result has been acted on. A task
    that runs again writes the same files again.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        filesystem, root = fs.FileSystem.from_uri(folder)
        filesystem.create_dir(root, recursive=True)
        for batch in batches:
            written = []
            for name, content in zip(batch["name"], batch["content"]):
                parent, _, _ = f"{root}/{name}".rpartition("/")
                filesystem.create_dir(parent, recursive=True)
                with filesystem.open_output_stream(f"{root}/{name}") as out:
                    out.write(content)
                written.append((f"{folder}/{name}", len(content)))
            yield pd.DataFrame(written, columns=["path", "length"])

    return rows.select("name", "content").mapInPandas(write, "path string, length bigint")


def as_png(images: DataFrame) -> DataFrame:
    """``name, content`` rows of image structs that carry a ``name``."""

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            content = [
                png_bytes(np.frombuffer(d, dtype=np.uint8).reshape(h, w, n))
                for h, w, n, d in zip(batch["height"], batch["width"], batch["nChannels"], batch["data"])
            ]
            yield pd.DataFrame({"name": batch["name"], "content": content})

    return images.mapInPandas(encode, "name string, content binary")
