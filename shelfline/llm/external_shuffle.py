"""Sharding by a two-pass external shuffle [native].

Pass 1 scatters every record into one of ``n_buckets`` buckets by a seeded
hash.  The number of buckets follows the measured bytes, so that one bucket
fits in a task's memory.  Pass 2 runs a Fisher-Yates shuffle over each
bucket (Spark's ``shuffle`` function, seeded) and writes it.  The buckets laid
end to end are one random order of all records; shard ``s`` of ``S`` holds the
records whose index ``i`` has ``floor(i * S / N) = s`` (law ``rows``: counts
differ by at most one, whatever the keys are).

The hash takes all columns of the record and, among equal records, a running
number, so a key or a text that holds a third of all rows is scattered as evenly
as any other, and the same records take the same places however they are spread
over files and tasks.  Equal records are numbered by counting them and making
that many again, in chunks that spread over tasks.

Defined cases: null key or text are ordinary values (a null text has no
bytes); an empty table gives an empty result; repeated rows each get a slot of
their own; input columns that clash with the added ones (``size``, ``shard``,
``slot``, ``law``, ``grown_shard``) are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.common import Scratch, documents

SHARDS = 16
SEED = 20260
#: Target bytes of one bucket; a task holds one bucket at a time.
BUCKET_BYTES = 16 * 1024 * 1024
MIN_BUCKETS = 64
#: Offsets are one 16-byte row a bucket: broadcast up to this many buckets.
BROADCAST_BUCKETS = 1_000_000
GROUP = 4096
#: Equal records that one task makes again at a time.
CHUNK = 1000

ADDED = ("size", "law", "shard", "slot", "grown_shard")


def _offsets(written: DataFrame) -> DataFrame:
    """Records before each bucket, by sums within groups of buckets and over
    the groups, so no task sees more than ``GROUP`` buckets."""
    counts = written.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumn("_group", F.floor(F.col("_bucket") / GROUP))
    totals = counts.groupBy("_group").agg(F.sum("_n").alias("_total"))
    w_total = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("_group", F.coalesce(F.sum("_total").over(w_total), F.lit(0)).alias("_base"))
    w = Window.partitionBy("_group").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    inside = counts.select("_group", "_bucket",
                           F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_inside"))
    return inside.join(F.broadcast(before), "_group").select(
        "_bucket", (F.col("_base") + F.col("_inside")).alias("_offset"))


def _numbered(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """``rows`` (_row, _hash) with ``_place``, the number of a row among its equals (0 for
    most).  Rows whose hash repeats are counted (partially aggregated) and made again:
    chunks of ``CHUNK`` copies are dealt to tasks, which spell them out."""
    repeated = scratch.write(rows.groupBy("_hash").count().where("count > 1").select("_hash"), "repeated")
    few = repeated.count()
    if not few:
        return rows.withColumn("_place", F.lit(0).cast("long"))
    ids = F.broadcast(repeated) if few <= BROADCAST_BUCKETS else repeated
    counted = (rows.join(ids, "_hash", "left_semi").groupBy("_hash", "_row").agg(F.count(F.lit(1)).alias("_n"))
               .select("*", F.explode(F.sequence(F.lit(0), F.expr(f"(_n - 1) div {CHUNK}"))).alias("_chunk"))
               .repartition("_hash", "_chunk"))
    again = counted.select("_row", "_hash", F.explode(F.sequence(
        F.col("_chunk") * CHUNK, F.least((F.col("_chunk") + 1) * CHUNK, F.col("_n")) - 1)).alias("_place"))
    return rows.join(ids, "_hash", "left_anti").withColumn("_place", F.lit(0).cast("long")).select(
        "_row", "_hash", "_place").unionByName(again)


def external_shuffle(df: DataFrame, key: str = "doc_id", text: str = "text",
                     n_shards: int = SHARDS, seed: int = SEED,
                     bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """All rows and columns of ``df`` with ``size``, ``law``, ``shard``,
    ``slot`` (its place in the shard, gapless from 0) and ``grown_shard``."""
    spark = df.sparkSession
    scratch = Scratch(spark, "external-shuffle")
    rows = df.drop(*ADDED)
    size = F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long") + 1
    total, n = rows.agg(F.coalesce(F.sum(size), F.lit(0)), F.count(F.lit(1))).first()
    n_buckets = max(MIN_BUCKETS, -(-total // bucket_bytes))

    payload = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    numbered = _numbered(rows.select(payload.alias("_row"), F.xxhash64(payload).alias("_hash")), scratch)
    scattered = (numbered.select("_row", F.xxhash64(F.lit(seed), "_hash", "_place").alias("_mixed"))
                 .withColumn("_bucket", F.pmod(F.col("_mixed"), F.lit(n_buckets)).cast("int"))
                 .repartitionById(n_buckets, "_bucket")           # one bucket a task
                 .sortWithinPartitions("_mixed"))
    shuffled = (scattered.groupBy("_bucket")
                .agg(F.shuffle(F.collect_list("_row"), seed).alias("_rows"))
                .select("_bucket", F.posexplode("_rows").alias("_pos", "_row")))
    written = scratch.write(shuffled, "buckets")

    offsets = _offsets(written)
    if n_buckets <= BROADCAST_BUCKETS:
        offsets = F.broadcast(offsets)
    index = F.col("_offset") + F.col("_pos")
    shard = F.expr(f"(_offset + _pos) * {n_shards} div {max(n, 1)}")
    first = F.expr(f"(_shard * {max(n, 1)} + {n_shards - 1}) div {n_shards}")
    return (written.join(offsets, "_bucket")
            .withColumn("_shard", shard)
            .select("_row.*", _size(text).alias("size"), F.lit("rows").alias("law"),
                    F.col("_shard").cast("int").alias("shard"),
                    (index - first).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))


def _size(text: str):
    return F.coalesce(F.octet_length(F.col(f"_row.{text}")), F.lit(0)).cast("long") + 1


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write the shards as parquet folders ``shard=<s>`` with rows in slot order
    within each file."""
    (sharded.sortWithinPartitions("shard", "slot").write.mode("overwrite")
     .partitionBy("shard").parquet(path))


def op8_external_shuffle(spark, sf_dir):
    out = external_shuffle(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select(
        "doc_id", "size",
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        "law", "shard", "slot", "grown_shard")
