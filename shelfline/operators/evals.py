"""Evaluation aggregation: verdict normalisation (C21), pass rates (I4),
per-trace verdicts (I5) and deterministic fact coverage (I6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions import columns as C

# Verdict vocabularies.
PASS_VALUES = ["yes", "true", "pass", "1", "1.0"]
FAIL_VALUES = ["no", "false", "fail", "0", "0.0"]


def verdict(value) -> "F.Column":
    v = F.lower(F.trim(C.col_(value).cast("string")))
    return (F.when(v.isin(PASS_VALUES), F.lit("pass"))
            .when(v.isin(FAIL_VALUES), F.lit("fail")).otherwise(F.lit("other")))


def verdict_normalize(assess: DataFrame) -> DataFrame:
    """C21 + D5: null feedback is skipped; the rest maps to pass/fail/other."""
    return (assess.filter(F.col("value").isNotNull())
            .select("trace_id", "name", verdict("value").alias("verdict")))


def eval_pass_rates(assess: DataFrame) -> DataFrame:
    """I4: per scorer pass / fail / other counts and pass rate (3 decimals)."""
    v = verdict_normalize(assess)
    g = v.groupBy("name").agg(F.count_if(F.col("verdict") == "pass").alias("pass"),
                              F.count_if(F.col("verdict") == "fail").alias("fail"),
                              F.count_if(F.col("verdict") == "other").alias("other"))
    return g.select("name", "pass", "fail", "other",
                    C.safe_ratio("pass", F.col("pass") + F.col("fail") + F.col("other"), 3)
                    .alias("pass_rate"))


def eval_by_trace(assess: DataFrame) -> DataFrame:
    """One row per trace with the values of all its scorers, whatever they are
    called, trimmed and in lower case, as a JSON object with the names in order.  Of
    several values of one scorer the last (by ``seq``) counts; a value that is null
    does not."""
    said = assess.filter(F.col("value").isNotNull() & F.col("name").isNotNull()).select(
        "trace_id", "name", "seq", F.lower(F.trim(F.col("value").cast("string"))).alias("value"))
    last = said.groupBy("trace_id", "name").agg(F.max(F.struct("seq", "value"))["value"].alias("value"))
    pairs = F.sort_array(F.collect_list(F.struct("name", "value")))
    return last.groupBy("trace_id").agg(F.count(F.lit(1)).alias("n_scorers"),
                                        F.to_json(F.map_from_entries(pairs)).alias("scores"))


def phrase_hits(phrases: DataFrame, positions: DataFrame) -> DataFrame:
    """Distinct ``(item_id, doc_id)`` where a document holds the phrase's terms at
    consecutive places.  ``phrases``: (item_id, terms), without empty ones;
    ``positions``: a ``text.term_positions`` of the documents.

    A phrase is looked up by its rarest pair of adjacent terms.  Where that pair
    occurs fixes where the phrase would begin; its other pairs (every second one and
    the last, which cover all its terms) must then occur at their places, an
    equi-join on document, place and both terms.  No text is read."""
    sized = phrases.withColumn("n", F.size("terms"))
    pairs = sized.where("n > 1").select("item_id", "n", F.inline(F.transform(
        F.slice("terms", 1, F.col("n") - 1),
        lambda t, i: F.struct(i.cast("long").alias("off"), t.alias("term"), F.get("terms", i + 1).alias("following")))))
    asked = positions.join(pairs.select("term", "following").distinct(), ["term", "following"], "left_semi")
    df = asked.groupBy("term", "following").agg(F.count(F.lit(1)).alias("df"))
    anchor = (pairs.join(df, ["term", "following"]).groupBy("item_id")
              .agg(F.min(F.struct("df", "off", "term", "following")).alias("a")).select("item_id", "a.*"))
    begins = (anchor.join(asked, ["term", "following"])
              .select("item_id", "doc_id", (F.col("pos") - F.col("off")).alias("start")).where("start >= 0"))
    needed = pairs.where("off % 2 = 0 or off = n - 2").select("item_id", "off", "term", "following")
    counted = needed.groupBy("item_id").agg(F.count(F.lit(1)).alias("k"))
    found = (begins.join(needed, "item_id").withColumn("pos", F.col("start") + F.col("off"))
             .join(asked.select("doc_id", "pos", "term", "following").distinct(), ["doc_id", "pos", "term", "following"])
             .groupBy("item_id", "doc_id", "start").agg(F.count(F.lit(1)).alias("got"))
             .join(counted, "item_id").where("got = k").select("item_id", "doc_id"))
    single = sized.where("n = 1").select("item_id", F.element_at("terms", 1).alias("term"))
    return found.unionByName(single.join(positions, "term").select("item_id", "doc_id")).distinct()


def fact_coverage(facts: DataFrame, answers: DataFrame, positions: DataFrame | None = None) -> DataFrame:
    """Share of expected facts whose text occurs (word-aligned, case- and
    punctuation-insensitive) in each answer.  A deterministic stand-in for an LLM
    correctness judge; its numbers are not comparable to one.  ``positions`` (a
    ``text.term_positions`` of the answers' text) may be a prebuilt table."""
    from shelfline.operators.text import term_positions
    index = positions if positions is not None else term_positions(answers, "text")
    f = (facts.select("item_id", F.filter(C.terms("text"), lambda t: t != "").alias("terms"))
         .where(F.size("terms") > 0))
    hits = phrase_hits(f, index).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_facts_found"))
    total = f.select(F.count(F.lit(1))).scalar()
    return (answers.select("doc_id").join(hits, "doc_id", "left")
            .select("doc_id", F.coalesce("n_facts_found", F.lit(0).cast("long")).alias("n_facts_found"))
            .withColumn("coverage", C.safe_ratio("n_facts_found", total, 6)))
