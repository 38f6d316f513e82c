"""Change feed (A5) and triggered incremental index sync.

Without a table format that keeps a change feed, changes are derived by comparing
two snapshots.  A snapshot is written in buckets of its key with a digest of each
bucket; digests are compared on two levels (groups of buckets, then the buckets of
differing groups), and only rows of buckets that differ are read and joined.

The index is a keyed table in bucketed snapshots (``streaming.buckets``), fed by a
Structured Streaming query with ``trigger(availableNow=True)``, a checkpoint and
``foreachBatch``: each run consumes only files it has not seen, and a batch rewrites
only the buckets it touches.  A batch that is replayed leaves the index as it is.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.session import scratch_path
from shelfline.streaming.buckets import BUCKETS, Buckets

DOC_COLS = ["doc_id", "doc_type", "category", "content"]
CHANGE_SCHEMA = "doc_id long, change_type string, version long, doc_type string, category string, content string"

# Fixed value: marker appended to revised documents in the test snapshots.
REVISION_MARK = " (revised)"

# ---- change feed


#: Buckets of a snapshot, and how many share a digest of the upper level.
SNAPSHOT_BUCKETS, GROUP = 256, 16


def snapshots(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two versions of the documents table: ``old`` lacks ids ending in 0,
    ``new`` lacks ids ending in 1 and revises ids ending in 2."""
    old = docs.filter(F.col("doc_id") % 10 != 0)
    new = (docs.filter(F.col("doc_id") % 10 != 1)
           .withColumn("content", F.when(F.col("doc_id") % 10 == 2,
                                         F.concat("content", F.lit(REVISION_MARK)))
                       .otherwise(F.col("content"))))
    return old, new


class Snapshot:
    """A written version of a keyed table: rows in folders by bucket, and a table of
    their digests (number of rows, and two independent 64-bit sums over the rows)."""

    def __init__(self, spark: SparkSession, folder: str, key: str, cols: tuple[str, ...]):
        self.spark, self.folder, self.key, self.cols = spark, folder.rstrip("/"), key, tuple(cols)
        self.digests = spark.read.parquet(f"{self.folder}/digests")
        self._schema = spark.read.parquet(f"{self.folder}/rows").schema

    @classmethod
    def write(cls, df: DataFrame, folder: str, key: str = "doc_id", cols: tuple[str, ...] = tuple(DOC_COLS[1:]),
              buckets: int = SNAPSHOT_BUCKETS) -> Snapshot:
        spark, folder = df.sparkSession, folder.rstrip("/")
        rows = df.select(key, *cols, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket"))
        rows.repartition("bucket").write.option("compression", "zstd").partitionBy("bucket").parquet(f"{folder}/rows")
        # nulls do not change xxhash64, so whether a column is null is hashed too
        seen = [x for c in (key, *cols) for x in (F.col(c), F.col(c).isNull())]
        hashed = spark.read.schema(rows.schema).parquet(f"{folder}/rows").select(
            "bucket", F.xxhash64(F.lit(1), *seen).alias("a"), F.xxhash64(F.lit(2), *seen).cast("decimal(20,0)").alias("b"))
        hashed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.bit_xor("a").alias("a"), F.sum("b").alias("b")) \
            .write.parquet(f"{folder}/digests")
        return cls(spark, folder, key, cols)

    def rows(self, buckets: list[int]) -> DataFrame:
        """The rows of some buckets: a partition filter, other folders are not read."""
        return self.spark.read.schema(self._schema).parquet(f"{self.folder}/rows").where(F.col("bucket").isin(buckets))


def changed_buckets(old: Snapshot, new: Snapshot, group: int = GROUP) -> list[int]:
    """The buckets whose digests differ (at most their number): groups of buckets are
    compared first, then the buckets of groups that differ."""
    def differ(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
        a, b = (x.select(key, F.struct("n", "a", "b").alias(name)) for x, name in ((a, "x"), (b, "y")))
        return a.join(b, key, "full_outer").where(~F.col("x").eqNullSafe(F.col("y"))).select(key)

    def upper(digests: DataFrame) -> DataFrame:
        return digests.withColumn("group", F.expr(f"bucket div {group}")).groupBy("group").agg(
            F.sum("n").alias("n"), F.bit_xor("a").alias("a"), F.sum("b").alias("b"))

    groups = differ(upper(old.digests), upper(new.digests), "group")
    some = [x.digests.join(groups, F.expr(f"bucket div {group}") == F.col("group"), "left_semi") for x in (old, new)]
    return sorted(r[0] for r in differ(*some, "bucket").collect())


def _sha256(cols: tuple[str, ...]) -> Column:
    """sha256 of a row's values: each its byte count, ``:`` and itself, or ``-`` if null."""
    text = [F.col(c).cast("string") for c in cols]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]), 256)


def change_feed(old: Snapshot, new: Snapshot) -> DataFrame:
    """A5: insert / update / delete rows between two snapshots, from a full outer join
    on the key within the buckets that differ; columns are compared null-safely, by
    their sha256, so the old rows' columns are not shuffled."""
    key, cols, buckets = new.key, new.cols, changed_buckets(old, new)
    o = old.rows(buckets).select("bucket", key, _sha256(cols).alias("o"))
    n = new.rows(buckets).select("bucket", key, F.struct(*cols).alias("n"), _sha256(cols).alias("sha"))
    j = o.join(n, ["bucket", key], "full_outer")
    kind = (F.when(F.col("o").isNull(), F.lit("insert"))
            .when(F.col("sha").isNull(), F.lit("delete"))
            .when(F.col("o") != F.col("sha"), F.lit("update")))
    return (j.select(key, kind.alias("change_type"), F.col("n").alias("n"))
            .filter(F.col("change_type").isNotNull())
            .select(key, "change_type", *[F.col(f"n.{c}").alias(c) for c in cols]))


def docs_change_feed(spark: SparkSession, old: DataFrame, new: DataFrame, base: str | None = None) -> DataFrame:
    """A5 over two versions of the documents, each written as a snapshot."""
    root = base or scratch_path(spark, "docs-snapshots")
    return change_feed(*(Snapshot.write(df, os.path.join(root, name)) for df, name in ((old, "old"), (new, "new"))))


# ---- index


#: Shares of a bucket of the index, each written by one task.
BUCKET_SHARES = 8


class Index:
    """The document index.  A row is the latest change of its key; a deletion stays
    as a mark until ``compact``, so a change that arrives late does not undo it."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int = BUCKETS):
        self.spark, self.store = spark, Buckets(spark, folder, {"rows": CHANGE_SCHEMA}, buckets)

    def upsert(self, changes: DataFrame, stream: str, batch: int) -> None:
        """Apply a batch of changes: of a key's rows the one of the highest version
        counts (then by change type and content).  A batch that the pointer already
        contains is skipped."""
        store = self.store
        if store.contains(stream, batch):
            return
        changes = changes.withColumn("bucket", store.bucket("doc_id"))
        touched = store.touched(changes)
        held = store.read("rows", touched).withColumn("bucket", store.bucket("doc_id"))
        names = [c.split()[0] for c in CHANGE_SCHEMA.split(", ")]
        last = F.max(F.struct("version", "change_type", *DOC_COLS[1:])).alias("last")
        # one shuffle gathers a key's rows and leaves a bucket in few tasks, which write it
        share = F.pmod(F.hash("doc_id"), F.lit(BUCKET_SHARES)).alias("share")
        rows = held.unionByName(changes).select("*", share).repartition("bucket", "share")
        merged = rows.groupBy("bucket", "share", "doc_id").agg(last).select("bucket", "doc_id", "last.*")
        store.switch(touched, {"rows": store.written("rows", merged.select("bucket", *names), dealt=True)},
                     stream=stream, batch=batch, rows=changes.count())

    def state(self) -> DataFrame:
        """The documents in the index."""
        return self.store.read("rows").where("change_type <> 'delete'").select(DOC_COLS)

    def compact(self) -> None:
        """Drop the marks of deleted documents and write each bucket as one table.  Its rows
        lie in the bucket's own folder, from which they are written without a shuffle."""
        live = self.store.read("rows").where("change_type <> 'delete'").withColumn("bucket", self.store.bucket("doc_id"))
        self.store.compact("rows", live, dealt=True)


def as_changes(df: DataFrame, change_type, version: int) -> DataFrame:
    ct = change_type if not isinstance(change_type, str) else F.lit(change_type)
    return df.select(F.col("doc_id").cast("long"), ct.alias("change_type"),
                     F.lit(version).cast("long").alias("version"),
                     "doc_type", "category", "content")


def sync_once(index: Index, source_dir: str, checkpoint: str) -> int:
    """Run the triggered sync: consume unseen change files into the index.  Returns the
    number of rows that this run brought, as the index counts them."""
    before = index.store.rows_in()
    q = (index.spark.readStream.schema(CHANGE_SCHEMA).parquet(source_dir).writeStream
         .foreachBatch(lambda df, batch: index.upsert(df, checkpoint, batch))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return index.store.rows_in() - before


def docs_index_sync(spark: SparkSession, old: DataFrame, new: DataFrame, base: str | None = None) -> Index:
    """Initial full load of one snapshot, then the change feed to another,
    both through the streaming sync; returns the index."""
    root = base or scratch_path(spark, "docs-index-sync")
    source, ckpt = os.path.join(root, "changes"), os.path.join(root, "_checkpoint")
    index = Index(spark, os.path.join(root, "index"))
    as_changes(old, "insert", 0).write.mode("append").option("compression", "zstd").parquet(source)
    sync_once(index, source, ckpt)
    feed = docs_change_feed(spark, old, new, os.path.join(root, "snapshots"))
    as_changes(feed, F.col("change_type"), 1).write.mode("append").option("compression", "zstd").parquet(source)
    sync_once(index, source, ckpt)
    return index
