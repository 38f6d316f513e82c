"""Keyed tables in bucketed, immutable snapshots behind an atomic pointer.

Rows lie in folders by bucket (a hash of the key).  A micro-batch reads the buckets
that its keys fall in, writes them anew to a fresh folder and then publishes a
pointer (``sources.versions``) that names the new folders beside the untouched ones.
The pointer also records, for each stream, the last batch that it contains: a batch
that is replayed after the switch does nothing, one that was cut off before it starts
over and leaves only a folder that no pointer names.  Readers see one pointer, so
one batch, whole or not at all.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.sources.versions import KEEP_SECONDS, Files, Versions

BUCKETS = 16


class Buckets:
    """``schemas``: kind of rows -> DDL.  The number of buckets is fixed with the first
    batch; choose it so that a bucket fits a task."""

    def __init__(self, spark: SparkSession, folder: str, schemas: dict[str, str], buckets: int = BUCKETS):
        self.spark, self.folder, self.schemas = spark, folder.rstrip("/"), schemas
        self.files, self.versions = Files(spark), Versions(spark, f"{self.folder}/pointer")
        self.buckets = self.pointer().get("buckets", buckets)

    def pointer(self) -> dict:
        return self.versions.latest()[1]

    def bucket(self, key: str) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets among rows with a column ``bucket`` (at most their number)."""
        return sorted(r[0] for r in rows.select("bucket").distinct().collect())

    def read(self, kind: str, only: list[int] | None = None) -> DataFrame:
        """The rows of a kind, of all buckets or some."""
        held = self.pointer().get("kinds", {}).get(kind, {})
        paths = [p for b, found in sorted(held.items()) if only is None or int(b) in only for p in found]
        return (self.spark.read.schema(self.schemas[kind]).parquet(*paths) if paths
                else self.spark.createDataFrame([], self.schemas[kind]))

    def contains(self, stream: str, batch: int) -> bool:
        return batch <= self.pointer().get("streams", {}).get(stream, -1)

    def written(self, kind: str, rows: DataFrame, dealt: bool = False) -> dict[str, list[str]]:
        """Write rows (with ``bucket``) to a fresh folder; the paths by bucket.  ``dealt``:
        a task has rows of few buckets, they are written where they are."""
        path = f"{self.folder}/data/{kind}-{uuid.uuid4().hex[:12]}"
        rows = rows if dealt else rows.repartition("bucket")
        rows.write.option("compression", "zstd").partitionBy("bucket").parquet(path)
        return {n.split("=")[1]: [f"{path}/{n}"] for n in self.files.names(path) if n.startswith("bucket=")}

    def switch(self, touched: list[int], replaced: dict[str, dict], added: dict[str, dict] | None = None,
               stream: str | None = None, batch: int = -1, rows: int = 0) -> None:
        """Publish: in the touched buckets the paths of ``replaced`` kinds instead of
        those before, the paths of ``added`` kinds beside them."""
        now = self.pointer()
        kinds = now.get("kinds", {})
        for kind, paths in replaced.items():
            held = {b: p for b, p in kinds.get(kind, {}).items() if int(b) not in touched}
            kinds[kind] = held | paths
        for kind, paths in (added or {}).items():
            held = kinds.setdefault(kind, {})
            for b, p in paths.items():
                held[b] = held.get(b, []) + p
        streams = now.get("streams", {}) | ({stream: batch} if stream else {})
        self.versions.publish({"buckets": self.buckets, "kinds": kinds, "streams": streams, "rows": now.get("rows", 0) + rows})

    def rows_in(self) -> int:
        """Rows that all batches together brought."""
        return self.pointer().get("rows", 0)

    def compact(self, kind: str, rows: DataFrame, dealt: bool = False) -> None:
        """Write all buckets of a kind anew, as ``rows`` of the key's buckets."""
        self.switch(list(range(self.buckets)), {kind: self.written(kind, rows, dealt)})

    def retire(self, keep_seconds: float = KEEP_SECONDS) -> None:
        """Remove pointers replaced long enough ago, and the folders only they name."""
        def paths(contents):
            return {p for c in contents for held in c["kinds"].values() for found in held.values() for p in found}
        gone = paths(self.versions.retire(keep_seconds))
        kept = paths(json.loads(self.files.read(self.versions._path(n)))["content"] for n in self.versions._numbers())
        for path in gone - kept:
            self.files.delete(path)
