"""Stages of the corpus pipeline.

Each takes (spark, docs, sf_dir) and returns the documents that go on, with the
columns of ``docs``; the last returns the packed pieces.

1. toxicity: documents that the conditional random field rejects go.
2. near duplicates: of each component of the n-gram Jaccard join the document
   with the least doc_id stays.
3. decontamination: documents that overlap a benchmark item go.
4. secrets: secrets are masked in the text; every document stays.
5. packing: the tokens' places in sequences.

Defined cases, in every stage: rows with a null doc_id cannot be labelled or linked;
they are judged by their text in stages 1, 3 and 4 and stay in stage 2.  Of equal
rows (doc_id and text) stage 2 keeps one; rows of one doc_id with texts that do not
link all stay.  Null and empty texts are clean, link with nothing, hold no secret and
are packed as the end id alone.  Texts of any length are read whole.  An empty table
gives an empty result.  Ties go to the least doc_id.  Extra columns, whatever their
names, are kept up to the last stage (``_node``, ``_number`` and ``_digest`` are taken by
stage 2).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm import crf, cutting_stock, ngram_join, spaced_seeds, token_efficiency
from shelfline.llm.common import Scratch, documents, labels
from shelfline.llm.ranking import ranked
from shelfline.sources.tables import table_path


def toxicity(spark, docs, sf_dir):
    return crf.drop_toxic(docs, crf.train_on(docs, labels(spark, sf_dir)))


def _nodes(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame | None]:
    """``docs`` with ``_node``: the doc_id, but where rows of one doc_id differ in text
    a number of its own (above all doc_ids) for each text but the one of least digest,
    so that unlinked texts are apart; and the nodes of doc_ids on several rows, or
    None without any.  Only those rows are shuffled."""
    repeated = scratch.write(docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"),
                             "repeated")
    if repeated.isEmpty():
        return docs.withColumn("_node", F.col("doc_id")), None
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    texts = scratch.write(_few(docs.select("doc_id", digest.alias("_digest")), repeated, "left_semi").distinct(), "texts")
    least = texts.groupBy("doc_id").agg(F.min("_digest").alias("_digest"))
    others = texts.join(least, ["doc_id", "_digest"], "left_anti").withColumn("_all", F.lit(""))
    top = docs.agg(F.max("doc_id")).first()[0]
    numbers = scratch.write(ranked(others, "_all", ["doc_id", "_digest"], scratch, "numbered").select(
        "doc_id", "_digest", (F.col("pos") + top + 1).alias("_number")), "numbers")
    named = _few(docs.withColumn("_digest", digest), numbers, "left", ["doc_id", "_digest"])
    return (named.withColumn("_node", F.coalesce("_number", "doc_id")).drop("_number", "_digest"),
            scratch.write(repeated.select(F.col("doc_id").alias("_node")).unionByName(
                numbers.select(F.col("_number").alias("_node"))), "nodes"))


def _few(docs: DataFrame, ids: DataFrame, how: str, key="doc_id") -> DataFrame:
    """A join with a written table of ids: broadcast up to ``BROADCAST_IDS`` rows, so
    that texts are not shuffled; beyond, both sides are."""
    return docs.join(F.broadcast(ids) if ids.count() <= ngram_join.BROADCAST_IDS else ids, key, how)


def near_duplicates(spark, docs, sf_dir):
    """The rows that go are named by id (fewer than those that stay)."""
    scratch = Scratch(spark, "near-duplicates")
    named, several = _nodes(docs, scratch)
    classes = ngram_join.jaccard_classes(named, "_node")
    gone = scratch.write(classes.where("component_id <> doc_id").select(F.col("doc_id").alias("_node")).distinct(), "gone")
    kept = _few(named, gone, "left_anti", "_node")
    if several is not None:                              # equal rows are one node, of which one row stays
        once = _few(kept, several, "left_semi", "_node").dropDuplicates(["_node"])
        kept = _few(kept, several, "left_anti", "_node").unionByName(once)
    return kept.select(docs.columns)


def decontamination(spark, docs, sf_dir):
    return spaced_seeds.decontaminate(docs, spark.read.parquet(table_path(sf_dir, "benchmark")))


def secrets(spark, docs, sf_dir):
    old = "_text_before_masking"
    masked = token_efficiency.mask_secrets(docs.withColumn(old, F.col("text")))
    if "n_chars" in docs.columns:
        same = F.col(old).eqNullSafe(F.col("text"))
        masked = masked.withColumn("n_chars", F.when(same, F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return masked.select(docs.columns)


def packing(spark, docs, sf_dir):
    return cutting_stock.placements(docs)


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("secrets", secrets), ("packing", packing)]


def run(spark, sf_dir):
    """Apply the stages to ``documents``; what each returns is written and
    read again as the next one's input."""
    scratch = Scratch(spark, "pipeline")
    docs, before = documents(spark, sf_dir), None
    for name, stage in STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
        if before:
            scratch.drop(before)
        before = name
    return STAGES[-1][1](spark, docs, sf_dir)
