"""Exact deduplication with a heavy-hitter split.

Texts are equal when they are identical after lower-casing A-Z; they are
compared by the SHA-256 digest of that form.  Of equal texts the row with the
largest doc_id stays.

1. Digests.  (doc_id, digest, row number) of all rows is written once; no text
   is shuffled.
2. Frequent digests.  Each task keeps a Misra-Gries summary of COUNTERS digests,
   from which it reports what reaches its own share n/(k+1); summed, these
   lower bounds lie at most 2n/(k+1) under the true counts.  Digests whose sum
   reaches n/(k+1) are candidates: at most k+1 can, and every digest of
   3n/(k+1) rows or more is among them, however it is spread over tasks.
3. Verified winners.  The candidates' rows are counted exactly and the row that
   stays is found by a partially aggregated maximum.  This table has at most
   k+1 rows, so it is broadcast and settles every row of a frequent digest in
   the task that reads it.
4. All other digests are shuffled in the ordinary way: one aggregated row a
   digest, joined back to its rows.

Defined cases: a null text counts as empty, so null and empty texts are one
group; a null doc_id is smaller than any other; of repeated rows (equal doc_id
and text) exactly one is kept; a text of any length is one digest; an empty
table gives an empty result; extra columns are not read by ``marked`` and
returned as they are by ``drop_copies``, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm.common import Scratch, documents, prepare_python

#: Counters of a summary; the broadcast table has at most one row more.
COUNTERS = 1024

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def text_digest(text: Column) -> Column:
    """SHA-256 (32 bytes) of the text after lower-casing A-Z only."""
    return F.unhex(F.sha2(F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER).cast("binary"), 256))


class Summary:
    """A Misra-Gries summary that takes whole batches: counts are added, and
    when more than ``k`` remain the (k+1)-th largest is taken off all."""

    def __init__(self, k: int):
        self.k, self.n, self.held = k, 0, Counter()

    def add(self, keys) -> None:
        self.n += len(keys)
        self.held.update(keys)
        if len(self.held) > self.k:
            cut = sorted(self.held.values(), reverse=True)[self.k]
            self.held = Counter({d: c - cut for d, c in self.held.items() if c > cut})

    def frequent(self) -> list[tuple]:
        return [(d, c) for d, c in self.held.items() if c * (self.k + 1) >= self.n]


def _summary_fn(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        summary = Summary(k)
        for batch in batches:
            summary.add(batch["digest"].tolist())
        found = summary.frequent()
        if found:
            yield pd.DataFrame(found, columns=["digest", "n"])
    return run


def frequent_digests(rows: DataFrame, k: int = COUNTERS) -> DataFrame:
    """Candidates (digest): at most ``k + 1``, and all that occur in
    3n/(k+1) of the n rows or more."""
    prepare_python(rows.sparkSession)
    summed = (rows.select("digest").mapInPandas(_summary_fn(k), "digest binary, n long")
              .groupBy("digest").agg(F.sum("n").alias("n")))
    return summed.where(F.col("n") * (k + 1) >= rows.count()).select("digest")


def verified_winners(rows: DataFrame, candidates: DataFrame) -> DataFrame:
    """(digest, keep, group_size) of the candidates, counted over all rows.
    ``candidates`` has at most COUNTERS + 1 rows."""
    return rows.join(F.broadcast(candidates), "digest").groupBy("digest").agg(*_won())


def _won() -> list[Column]:
    return [F.max(F.struct("doc_id", "seq")).alias("keep"), F.count(F.lit(1)).alias("group_size")]


def _digests(docs: DataFrame, scratch: Scratch, doc: str, text: str) -> DataFrame:
    return scratch.write(docs.select(F.col(doc).cast("long").alias("doc_id"), text_digest(F.col(text)).alias("digest"))
                         .withColumn("seq", F.monotonically_increasing_id()), "digests")


def marked(docs: DataFrame, doc: str = "doc_id", text: str = "text", k: int = COUNTERS) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, digest), one row for each row."""
    scratch = Scratch(docs.sparkSession, "heavy-hitters")
    rows = _digests(docs, scratch, doc, text)
    hot = scratch.write(verified_winners(rows, frequent_digests(rows, k)), "winners")
    settled = rows.join(F.broadcast(hot), "digest")
    others = rows.join(F.broadcast(hot.select("digest")), "digest", "left_anti")
    others = others.join(others.groupBy("digest").agg(*_won()), "digest")
    return settled.unionByName(others).select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
        (F.col("seq") == F.col("keep.seq")).alias("kept"), "digest")


def drop_copies(docs: DataFrame, doc: str = "doc_id", text: str = "text", k: int = COUNTERS) -> DataFrame:
    """The rows that stay, with all their columns.  Copies of frequent texts go
    before the shuffle; it carries the rest, reduced in each task first."""
    scratch = Scratch(docs.sparkSession, "heavy-hitters")
    rows = _digests(docs, scratch, doc, text)
    hot = scratch.write(verified_winners(rows, frequent_digests(rows, k))
                        .select("digest", F.col("keep.doc_id").alias("keep_id")), "winners")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                        F.struct(F.col(doc).cast("long").alias("doc_id")).alias("place"),
                        text_digest(F.col(text)).alias("digest"))
    left = (whole.join(F.broadcast(hot.withColumn("frequent", F.lit(True))), "digest", "left")
            .where(F.col("frequent").isNull() | F.col("place.doc_id").eqNullSafe(F.col("keep_id"))))
    return left.groupBy("digest").agg(F.max_by("row", "place").alias("row")).select("row.*")


def op12_heavy_hitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marked(documents(spark, sf_dir)).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


ORACLE_SQL = f"""
WITH t AS (SELECT doc_id, sha256(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')) AS text_sha256
           FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, text_sha256
FROM t
"""
