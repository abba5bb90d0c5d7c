"""Distributed file listing.

Spark's file sources leave out files of zero bytes, and those matter here: they are counted, gated
as empty and fetched again. So folders are listed inside tasks: level by level first, which spreads
the shard folders over the cluster, then whole trees.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from urllib.parse import unquote

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import INVENTORY

_ENTRY = "path string, is_dir boolean, length bigint"
_ROWS = 10_000


def _entries(filesystem: fs.FileSystem, folder: str) -> Iterator[tuple[str, bool, int | None]]:
    """Entries directly in a folder, one at a time where the file system allows it."""
    if isinstance(filesystem, fs.LocalFileSystem):
        with os.scandir(folder) as found:
            for entry in found:
                is_dir = entry.is_dir()
                yield entry.path, is_dir, None if is_dir else entry.stat().st_size
        return
    for info in filesystem.get_file_info(fs.FileSelector(folder)):
        is_dir = info.type == fs.FileType.Directory
        yield info.path, is_dir, None if is_dir else info.size


def _children(folder: str, recursive: bool) -> Iterator[pd.DataFrame]:
    filesystem, inner = fs.FileSystem.from_uri(folder)
    scheme = folder[: len(folder) - len(inner)] if folder.endswith(inner) else ""
    waiting, found = [inner], []
    while waiting:
        for path, is_dir, length in _entries(filesystem, waiting.pop()):
            if is_dir and recursive:
                waiting.append(path)
                continue
            found.append((scheme + path, is_dir, length))
            if len(found) == _ROWS:
                yield _frame(found)
                found = []
    if found:
        yield _frame(found)


def _frame(entries: list[tuple[str, bool, int | None]]) -> pd.DataFrame:
    return pd.DataFrame(entries, columns=["path", "is_dir", "length"]).astype({"length": "Int64"})


def _open_folders(entries: DataFrame, recursive: bool) -> DataFrame:
    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            files = batch[~batch["is_dir"]]
            if len(files):
                yield files
            for folder in batch.loc[batch["is_dir"], "path"]:
                yield from _children(folder, recursive)

    # One row per folder is little data for much work, so it is spread before it is opened.
    spread = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return entries.repartition(spread, "path").mapInPandas(expand, _ENTRY)


def resolved(folder: str) -> str:
    """One form of a folder for listing, image origins and stores: local ones as absolute paths."""
    if folder.startswith("file:"):
        return "/" + unquote(folder[len("file:") :]).strip("/")
    return folder.rstrip("/") if "://" in folder else os.path.abspath(folder)


def list_files(spark: SparkSession, folder: str, levels: int = 2) -> DataFrame:
    """Every file below ``folder`` as ``path, length``, empty files included.

    ``levels`` folder levels are spread over tasks before the trees below them are walked; two
    match the store layout.
    """
    entries = spark.createDataFrame([(resolved(folder), True, None)], _ENTRY)
    for _ in range(levels):
        entries = _open_folders(entries, recursive=False)
    return _open_folders(entries, recursive=True).select(*INVENTORY.fieldNames())


def list_flat(spark: SparkSession, folder: str) -> DataFrame:
    """The files directly in ``folder``."""
    entries = spark.createDataFrame([(resolved(folder), True, None)], _ENTRY)
    return _open_folders(entries, recursive=False).filter(~F.col("is_dir")).select(*INVENTORY.fieldNames())
