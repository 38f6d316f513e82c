"""Documents: normalisation (C14), rendering (C15), review flags (C16),
type counts (F14) and term-weighted text search (H2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions import columns as C


def doc_normalize(raw_docs: DataFrame) -> DataFrame:
    """C14: whitespace-collapsed content and whether it changed."""
    content = C.collapse_ws("text")
    return raw_docs.select("doc_id", content.alias("content"),
                           (content != F.col("text")).alias("changed"))


def render_spec_docs(products: DataFrame) -> DataFrame:
    """One specification document per product rendered from its row."""
    return products.select(
        "product_id",
        F.concat(F.lit("Product specification: "), F.col("product_name"), F.lit(" ("),
                 F.col("brand"), F.lit("). Category: "), F.col("category"),
                 F.lit(". List price: $"), F.col("list_price").cast("string"),
                 F.lit(". Unit cost: $"), F.col("unit_cogs").cast("string"), F.lit("."))
        .alias("content"))


def review_flags(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Label -> recommend flag and sentiment (quality 1 and not toxic
    is a positive, recommended review)."""
    j = docs.select("doc_id", "doc_type").join(labels, "doc_id")
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    return j.select("doc_id", "doc_type",
                    F.when(good, F.lit("Positive")).otherwise(F.lit("Negative")).alias("sentiment"),
                    F.when(F.col("quality") == 1, F.lit("Yes")).otherwise(F.lit("No"))
                    .alias("would_recommend"))


def doc_terms(docs: DataFrame, text_col: str = "content", id_col: str = "doc_id") -> DataFrame:
    """One row per (document, term occurrence) over the whole text."""
    return (docs.select(id_col, F.explode(C.terms(text_col)).alias("term"))
            .filter(F.col("term") != ""))


def term_index(docs: DataFrame, text_col: str = "content", id_col: str = "doc_id"
               ) -> DataFrame:
    """Inverted term index ``(doc_id, term, tf)`` over whole texts: one row
    per distinct term of a document with its count (map-side partial
    counts before the shuffle)."""
    return (doc_terms(docs, text_col, id_col).groupBy(id_col, "term")
            .agg(F.count(F.lit(1)).alias("tf")))


def term_positions(docs: DataFrame, text_col: str = "content", id_col: str = "doc_id") -> DataFrame:
    """Positional index ``(doc_id, pos, term, following)`` over whole texts: every
    term occurrence with its place and the term after it (null at the end).  Row by
    row, without a shuffle."""
    # a column of its own: inside the lambda the text would be split for every term again
    split = docs.select(F.col(id_col), F.filter(C.terms(text_col), lambda t: t != "").alias("_terms"))
    placed = F.transform("_terms", lambda t, i: F.struct(
        i.cast("long").alias("pos"), t.alias("term"), F.get("_terms", i + 1).alias("following")))
    return split.select(id_col, F.inline(placed))


#: Documents of successive ids that share a posting block.
BLOCK_DOCS = 256


def with_blocks(index: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """A term index with ``block``: postings of a term and BLOCK_DOCS successive ids."""
    return index.withColumn("block", F.floor(F.col(id_col) / BLOCK_DOCS))


def row_terms(docs: DataFrame, text_col: str = "content", id_col: str = "doc_id") -> DataFrame:
    """``(doc_id, term, tf)`` of each row by itself: its terms in order, where runs of
    equal ones are counted.  Row by row, so a task holds one text at a time."""
    # columns of their own: inside the lambdas they would be computed for every term again
    terms = docs.select(F.col(id_col), F.sort_array(C.terms(text_col)).alias("_terms"))
    ends = terms.select(id_col, "_terms", F.filter(
        F.sequence(F.lit(0), F.size("_terms") - 1), lambda i: ~F.get("_terms", i).eqNullSafe(F.get("_terms", i + 1))).alias("_ends"))
    counts = F.transform("_ends", lambda end, j: F.struct(
        F.get("_terms", end).alias("term"), (end - F.coalesce(F.get("_ends", j - 1), F.lit(-1))).cast("long").alias("tf")))
    return ends.select(id_col, F.inline(counts)).filter(F.col("term") != "")


def block_index(docs: DataFrame, text_col: str = "content", id_col: str = "doc_id") -> DataFrame:
    """``with_blocks(term_index(docs))`` by one shuffle, after which the postings of a
    block lie together.  Where no id comes twice, so that a block has BLOCK_DOCS texts at
    most, the texts are shuffled; else their postings, and counts of one id are added."""
    if docs.groupBy(id_col).count().where("count > 1").isEmpty():
        parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))     # by number: texts grow to many rows
        dealt = with_blocks(docs, id_col).repartition(parts, "block").select(id_col, text_col)
        return with_blocks(row_terms(dealt, text_col, id_col), id_col)
    dealt = with_blocks(row_terms(docs, text_col, id_col), id_col).repartition("term", "block")
    return (dealt.groupBy(id_col, "term", "block").agg(F.sum("tf").alias("tf"))
            .select(id_col, "term", "tf", "block"))


def posting_blocks(index: DataFrame) -> DataFrame:
    """``(term, block, max_tf, n)`` of an index ``with_blocks``: the greatest count a block
    holds bounds what its documents can score for the term."""
    return index.groupBy("term", "block").agg(F.max("tf").alias("max_tf"), F.count(F.lit(1)).alias("n"))


#: Distinct terms of one query, and blocks, that become literals.
PUSHED_TERMS = PUSHED_BLOCKS = 1000


def _literal(rows: DataFrame, key: str, wanted: DataFrame, most: int) -> DataFrame:
    """The rows whose key is wanted: up to ``most`` keys are literals of an ``IN`` filter,
    which the scan of an ordered table uses to skip files and row groups; more are
    semi-joined."""
    few = [r[0] for r in wanted.limit(most + 1).collect()]
    return rows.filter(F.col(key).isin(few)) if len(few) <= most else rows.join(wanted, key, "left_semi")


def text_search(docs: DataFrame, query_terms: DataFrame, k: int = 10,
                index: DataFrame | None = None, blocks: DataFrame | None = None) -> DataFrame:
    """H2: TF-IDF ranking of documents for one query, top k.

    score(d) = sum over distinct query terms t of tf(t, d) * ln(N / df(t)).
    ``index`` is a prebuilt ``term_index(docs)``; without it the index is derived on the
    fly.  With ``blocks`` (``posting_blocks`` of an index ``with_blocks``) postings that
    cannot matter are not scored: the sum of a block's greatest counts bounds its
    documents' scores; the documents of the k most promising blocks are scored first, and
    the k-th best of them is a threshold that the other blocks must reach.  The result is
    the same."""
    idx = index if index is not None else term_index(docs)
    q = query_terms.select("term").distinct()
    n_docs = docs.select(F.count(F.lit(1)).cast("double")).scalar()
    tf = _literal(idx, "term", q, PUSHED_TERMS)
    if blocks is None:
        df = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    else:
        mine = _literal(blocks, "term", q, PUSHED_TERMS)
        df = mine.groupBy("term").agg(F.sum("n").alias("df"))
    idf = df.select("term", F.log(n_docs / F.col("df")).alias("idf"))

    def scored(postings: DataFrame) -> DataFrame:
        return postings.join(idf, "term").groupBy("doc_id").agg(F.sum(F.col("tf") * F.col("idf")).alias("raw"))

    if blocks is not None:
        bound = mine.join(idf, "term").groupBy("block").agg(F.sum(F.col("max_tf") * F.col("idf")).alias("most"))
        # each block of the query's terms has a document, so k blocks have k or more
        first = scored(_literal(tf, "block", bound.orderBy(F.desc("most"), "block").limit(k).select("block"), PUSHED_BLOCKS))
        least = first.orderBy(F.desc("raw")).limit(k).agg(F.min("raw"), F.count(F.lit(1))).first()
        if least[1] == k:                               # scores are compared after rounding to 6 decimals
            tf = _literal(tf, "block", bound.where(F.col("most") >= least[0] - 1e-6).select("block"), PUSHED_BLOCKS)
    return (scored(tf).select("doc_id", C.rounded("raw", 6).alias("score"))
            .orderBy(F.desc("score"), "doc_id").limit(k))


def query_terms_of(texts: DataFrame, text_col: str = "text") -> DataFrame:
    return (texts.select(F.explode(C.terms(text_col)).alias("term"))
            .filter(F.col("term") != ""))
