"""Benchmark decontamination by spaced seeds [native].

Texts are token sequences (runs of letters, marks and digits, lower-cased).  A
mask picks some of ``SPAN`` successive tokens; the picked ones are hashed, so a
substitution at an ignored place does not hide a passage.  Every position of
every text is hashed under every mask and joined with the benchmark's hashes.
A hit is verified on the tokens around it: of the window of up to ``SPAN + 2 *
AROUND`` aligned tokens, at least ``MATCH_PERCENT`` must be equal.  Items of
fewer than ``SPAN`` tokens are hashed whole; positions are hashed under those of
these lengths that occur, in the same join, and all tokens must be equal.

The benchmark's hashes are broadcast in parts of at most ``BROADCAST_SEEDS``
(a documented bound); a larger benchmark takes one pass over the documents for
each part, so the exploded corpus is never shuffled.  Seeds with the same hash
and the same window are one seed, so a passage that many items share costs one
match a document, not one for each item; a second table names all items of each
window, and the verified (document, window) rows are joined with it.

Defined cases: null and empty texts match nothing, on either side; an item of
one token matches every document that has it; an empty benchmark leaves every
document clean;
rows with a null doc_id are judged by their text like any other; repeated rows
get the same verdict; extra columns are kept by ``decontaminate`` and not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import Scratch, documents
from shelfline.sources.tables import table_path

#: Places of the mask's tokens among SPAN successive ones.
MASKS = ((0, 1, 3, 4, 6, 8), (0, 2, 3, 5, 7, 8))
SPAN = 9
#: Tokens verified on either side of a hit, and the share that must be equal.
AROUND = 4
MATCH_PERCENT = 75
#: Seeds broadcast at once (about 250 bytes each).
BROADCAST_SEEDS = 250_000

_SEPARATORS = r"[^\p{L}\p{M}\p{N}]+"


def tokens(text: Column) -> Column:
    """Tokens of a text; at its ends there may be an empty one."""
    return F.split(F.lower(text), _SEPARATORS)


def _positions(words: str, span: int = SPAN) -> Column:
    n = F.size(words)
    return F.explode(F.when(n >= span, F.sequence(F.lit(0), n - span)))


def _hash(k: int, words: str, at: str, places) -> Column:
    return F.xxhash64(F.lit(k), *[F.get(F.col(words), F.col(at) + o) for o in places])


def _whole(words: str, at: str, length: int) -> Column:
    """The hash of ``length`` successive tokens."""
    return _hash(len(MASKS) + length, words, at, range(length))


def _hashes(words: str, at: str, lengths: tuple[int, ...] = ()) -> Column:
    """One hash for each mask, and each length of short items, at this position.
    Beyond the text's end the hash misses tokens; what it may hit is verified."""
    return F.array(*[_hash(k, words, at, mask) for k, mask in enumerate(MASKS)],
                   *[_whole(words, at, length) for length in lengths])


def seeds(benchmark: DataFrame, scratch: Scratch, item: str = "item_id", text: str = "text"
          ) -> tuple[DataFrame, DataFrame, tuple[int, ...]]:
    """(hash, window tokens, place of the hit in the window, window id) and the
    items of each window (window id, item), both written; the lengths of the items
    that have fewer than SPAN tokens, each of which is one window."""
    words = F.filter(tokens(F.col(text)), lambda w: w != "")
    at = F.greatest(F.col("_at") - AROUND, F.lit(0))
    n = F.least(F.size("_words"), F.col("_at") + SPAN + AROUND) - at
    items = benchmark.select(F.col(item).alias("_item"), words.alias("_words"))
    short = (items.where(F.size("_words").between(1, SPAN - 1))
             .select("_item", F.col("_words").alias("_window"), F.lit(0).alias("_in")))
    each = scratch.write(
        items.select("_item", "_words", _positions("_words").alias("_at"))
        .select("_item", F.slice("_words", at + 1, n).alias("_window"), (F.col("_at") - at).alias("_in"))
        .unionByName(short).distinct(), "each")
    windows = scratch.write(each.groupBy("_window", "_in").agg(F.countDistinct("_item").alias("_items"))
                            .withColumn("_id", F.monotonically_increasing_id()), "windows")
    members = scratch.write(each.join(windows, ["_window", "_in"]).select("_id", "_item"), "members")
    size = F.size("_window")
    lengths = tuple(sorted(r[0] for r in windows.where(size < SPAN).select(size).distinct().collect()))
    rest = ["_window", "_in", "_id", "_items"]
    known = windows.where(size >= SPAN).select(F.explode(_hashes("_window", "_in")).alias("_hash"), *rest)
    for length in lengths:
        known = known.unionByName(windows.where(size == length).select(
            _whole("_window", "_in", length).alias("_hash"), *rest))
    return scratch.write(known, "seeds"), members, lengths


def _matched(words: str) -> Column:
    """Equal tokens of the aligned window (a fixed number of comparisons, so it
    stays in generated code)."""
    first = F.col("_pos") - F.col("_in")
    equal = [F.coalesce((F.get(F.col(words), first + j) == F.get(F.col("_window"), F.lit(j))).cast("int"), F.lit(0))
             for j in range(SPAN + 2 * AROUND)]
    return reduce(lambda a, b: a + b, equal)


def matches(docs: DataFrame, benchmark: DataFrame, doc: str = "doc_id", text: str = "text"
            ) -> tuple[DataFrame, DataFrame]:
    """Verified hits, one row for each document text and window (written), and
    the items of each window."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "spaced-seeds")
    known, members, lengths = seeds(benchmark, scratch)
    parts = max(1, -(-known.count() // BROADCAST_SEEDS))
    rows = docs.select(F.col(doc).alias("_doc"), F.xxhash64(F.col(text)).alias("_text_hash"),
                       tokens(F.col(text)).alias("_tokens"))
    hashed = (rows.select("_doc", "_text_hash", "_tokens", _positions("_tokens", min((SPAN, *lengths))).alias("_pos"))
              .select("_doc", "_text_hash", "_tokens", "_pos",
                      F.explode(_hashes("_tokens", "_pos", lengths)).alias("_hash")))
    percent = F.when(F.col("_size") < SPAN, 100).otherwise(MATCH_PERCENT)
    found = []
    for k in range(parts):
        part = known.where(F.pmod("_hash", F.lit(parts)) == k) if parts > 1 else known
        found.append(hashed.join(F.broadcast(part), "_hash")
                     # an explode of one value keeps the comparison out of the join's own
                     # condition: the probe loop stays small enough to be compiled
                     .select("_doc", "_text_hash", "_id", "_items", "_pos", "_in",
                             F.size("_window").alias("_size"),
                             F.explode(F.array(_matched("_tokens"))).alias("_matched"))
                     .where(F.col("_matched") * 100 >= F.col("_size") * percent)
                     .select("_doc", "_text_hash", "_id", "_items", "_matched", "_size",
                             (F.col("_pos") - F.col("_in")).alias("_first")))
    every = reduce(DataFrame.unionByName, found)
    hits = (every.groupBy("_doc", "_text_hash", "_id")
            .agg(F.max("_items").alias("items"), F.count(F.lit(1)).alias("hits"),
                 F.min("_first").alias("first_token"), F.max(F.col("_first") + F.col("_size")).alias("last_token"),
                 F.max("_matched").alias("matched"))
            .withColumnRenamed("_doc", "doc_id").withColumnRenamed("_text_hash", "text_hash"))
    return scratch.write(hits, "hits"), members


def _by_item(hits: DataFrame, members: DataFrame) -> DataFrame:
    return (hits.join(members, "_id").groupBy("doc_id", "text_hash", F.col("_item").alias("item_id"))
            .agg(F.max("items").alias("items"), F.sum("hits").alias("hits"),
                 F.min("first_token").alias("first_token"), F.max("last_token").alias("last_token"),
                 F.max("matched").alias("matched")))


def overlaps(docs: DataFrame, benchmark: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Verified overlaps: (doc, text hash, item, items, hits, first token, last
    token, matched), one row for each document text and item: its best.  A hit on
    a window that several items share counts for each of them."""
    return _by_item(*matches(docs, benchmark, doc, text))


def decontaminate(docs: DataFrame, benchmark: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text overlaps no benchmark item, all columns."""
    scratch = Scratch(docs.sparkSession, "decontaminate")
    bad = scratch.write(matches(docs, benchmark, doc, text)[0].select("doc_id", "text_hash").distinct(), "bad")
    b = bad.select(F.col("doc_id").alias("_bad_doc"), F.col("text_hash").alias("_bad_text"))
    return docs.join(b, F.col(doc).eqNullSafe(F.col("_bad_doc"))
                     & (F.xxhash64(F.col(text)) == F.col("_bad_text")), "left_anti")


def op5_spaced_seeds(spark, sf_dir):
    """One row a document: whether it is contaminated, by which items."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    benchmark = spark.read.parquet(table_path(sf_dir, "benchmark"))
    hits, members = matches(docs, benchmark)
    key = ["doc_id", "text_hash"]
    # a hit is counted once for the document, however many items share it
    bad = hits.groupBy(*key).agg(F.sum("hits").alias("hits"), F.max("matched").alias("matched")).select(
        F.col("doc_id").alias("_d"), F.col("text_hash").alias("_t"), "hits", "matched")
    items = _by_item(hits, members).groupBy(*key).agg(F.sort_array(F.collect_set("item_id")).alias("item_ids")).select(
        F.col("doc_id").alias("_di"), F.col("text_hash").alias("_ti"), "item_ids")
    b = bad.join(items, F.col("_d").eqNullSafe(F.col("_di")) & (F.col("_t") == F.col("_ti")))
    rows = docs.select("doc_id", F.xxhash64("text").alias("_h"))
    none = F.array().cast("array<bigint>")
    return (rows.join(b, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_h") == F.col("_t")), "left")
            .select("doc_id", F.col("_t").isNotNull().alias("contaminated"),
                    F.coalesce("item_ids", none).alias("item_ids"),
                    F.coalesce("hits", F.lit(0)).alias("hits"),
                    F.coalesce(F.col("matched"), F.lit(0)).alias("matched")))
