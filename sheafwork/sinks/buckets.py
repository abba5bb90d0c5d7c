"""A keyed table in hash buckets, for small updates to a large table.

Layout under the table's folder:

* ``data/bucket=<b>/slot=<s>``: rows of one update of one bucket, as Parquet.
* ``manifest/slot=0`` and ``slot=1``: the last two versions, one file each. A version says which slots of every bucket
  are live, which batch was applied last, and what the table was imported from.

An update writes the buckets it has rows for into slots no kept version refers to, and then switches by writing the
older manifest anew. A job that dies before the switch leaves the table as it was; one that runs again overwrites the
same slots. A bucket with ``MERGE_AT`` live slots is rewritten into one as part of the next update. So a
bucket has at most ``MERGE_AT`` + 2 folders and an update reads nothing of the buckets it has no rows for, however many
updates there were. One writer at a time; readers may go on reading the version they opened.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS, MERGE_AT = 64, 8
# Batch of rows that an update without a batch number writes, and of rows that were imported.
UNNUMBERED, IMPORTED = -1, -2
_MANIFEST = "version bigint, batch bigint, origin string, buckets int, bucket int, slots array<int>, before array<int>"


@dataclass(frozen=True)
class Version:
    """What a manifest says. ``before`` holds the slots the version before this one still refers to."""

    number: int = 0
    batch: int = -1
    origin: str = ""
    buckets: int = BUCKETS
    live: dict[int, list[int]] = field(default_factory=dict)
    before: dict[int, list[int]] = field(default_factory=dict)


class BucketTable:
    """``key string``, the columns of ``values`` (DDL), and ``added``: the batch a row came with."""

    def __init__(self, spark: SparkSession, path: str, values: str = "", buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        self.values = T.StructType.fromDDL(values).fieldNames() if values else []
        self.schema = f"key string, {values + ', ' if values else ''}added bigint, bucket int, slot int"

    def exists(self) -> bool:
        return self.version().number > 0

    def version(self) -> Version:
        """The newest whole manifest; the driver gets two rows per bucket at most."""
        try:
            rows = self.spark.read.schema(_MANIFEST).parquet(f"{self.path}/manifest").drop("slot")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return Version(buckets=self.buckets)
        kept = rows.collect()
        if not kept:
            return Version(buckets=self.buckets)
        newest = max(r["version"] for r in kept)
        found = [r for r in kept if r["version"] == newest]
        head, own = found[0], [r for r in found if r["bucket"] is not None]
        return Version(
            head["version"],
            head["batch"],
            head["origin"],
            head["buckets"],
            {r["bucket"]: r["slots"] for r in own if r["slots"]},
            {r["bucket"]: r["before"] for r in own if r["before"]},
        )

    def rows(self, version: Version | None = None, buckets: list[int] | None = None) -> DataFrame:
        """Live rows, of some buckets or of all; only their folders are listed and read."""
        version = version or self.version()
        chosen = sorted(version.live) if buckets is None else [b for b in buckets if b in version.live]
        folders = [f"{self.path}/data/bucket={b}/slot={s}" for b in chosen for s in version.live[b]]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).option("basePath", f"{self.path}/data").parquet(*folders)

    def latest(self) -> DataFrame:
        """``key`` and values of the newest row of each key."""
        return self.newest(self.rows()).drop("added", "bucket")

    def newest(self, rows: DataFrame) -> DataFrame:
        values = F.max_by(F.struct("added", *self.values), "added").alias("_row")
        return rows.groupBy("bucket", "key").agg(values).select("key", *[f"_row.{c}" for c in self.values], "_row.added", "bucket")

    def bucket_of(self, key: Column, buckets: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")

    def add_new(self, rows: DataFrame, batch: int | None = None, origin: str | None = None) -> None:
        """Add the keys the table doesn't have, each once."""

        self._update(rows, batch, origin, self._unseen, lambda merged: merged)

    def _unseen(self, placed: DataFrame, version: Version) -> DataFrame:
        once = placed.dropDuplicates(["bucket", "key"])
        touched = [r["bucket"] for r in once.select("bucket").distinct().collect()]
        stored = self.rows(version, touched).select("bucket", "key")
        return once.join(stored, ["bucket", "key"], "left_anti")

    def unseen(self, rows: DataFrame) -> DataFrame:
        """The keys the table doesn't have, each once; reads the buckets of these rows only."""
        version = self.version()
        placed = rows.withColumn("bucket", self.bucket_of(F.col("key"), version.buckets))
        return self._unseen(placed, version).select("key")

    def put(self, rows: DataFrame, batch: int | None = None) -> None:
        """Add rows whose values replace those of earlier batches; keys of one update are distinct."""
        self._update(rows, batch, None, lambda found, version: found, self.newest)

    def _update(
        self,
        rows: DataFrame,
        batch: int | None,
        origin: str | None,
        chosen: Callable[[DataFrame, Version], DataFrame],
        merged: Callable[[DataFrame], DataFrame],
    ) -> None:
        version = self.version()
        if batch is not None and batch <= version.batch:
            return
        added = IMPORTED if origin is not None else UNNUMBERED if batch is None else batch
        keyed = rows.select(F.col("key").cast("string").alias("key"), *self.values, F.lit(added).cast("bigint").alias("added"))
        placed = keyed.withColumn("bucket", self.bucket_of(F.col("key"), version.buckets)).persist()
        fresh = chosen(placed, version).select("key", *self.values, "added", "bucket").persist()
        try:
            filled = [r["bucket"] for r in fresh.select("bucket").distinct().collect()]
            full = [b for b in filled if len(version.live.get(b, ())) >= MERGE_AT]
            slots = {b: self._free_slot(version, b) for b in filled}
            if filled:
                self._write(fresh, version, full, slots, merged)
            elif batch is None and origin is None:
                return
        finally:
            fresh.unpersist()
            placed.unpersist()
        live = {**version.live, **{b: [s] if b in full else [*version.live.get(b, ()), s] for b, s in slots.items()}}
        self._switch(
            Version(
                version.number + 1,
                version.batch if batch is None else batch,
                version.origin if origin is None else origin,
                version.buckets,
                live,
                version.live,
            )
        )

    def _free_slot(self, version: Version, bucket: int) -> int:
        taken = {*version.live.get(bucket, ()), *version.before.get(bucket, ())}
        return next(s for s in range(len(taken) + 1) if s not in taken)

    def _write(self, fresh: DataFrame, version: Version, full: list[int], slots: dict[int, int], merged) -> None:
        out = fresh
        if full:
            together = self.rows(version, full).drop("slot").unionByName(fresh.filter(F.col("bucket").isin(full)))
            out = fresh.filter(~F.col("bucket").isin(full)).unionByName(merged(together))
        slot = F.element_at(F.array(*[F.lit(slots.get(b, -1)) for b in range(version.buckets)]), F.col("bucket") + 1)
        # One file for each bucket: a task has whole buckets.
        placed = out.withColumn("slot", slot).repartition("bucket")
        writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("bucket", "slot").parquet(f"{self.path}/data")

    def _switch(self, version: Version) -> None:
        head = (version.number, version.batch, version.origin, version.buckets)
        rows = [(*head, None, [], [])]
        rows += [(*head, b, version.live.get(b, []), version.before.get(b, [])) for b in sorted({*version.live, *version.before})]
        manifest = self.spark.createDataFrame(rows, _MANIFEST).coalesce(1)
        manifest.write.mode("overwrite").parquet(f"{self.path}/manifest/slot={version.number % 2}")
