"""Connected components of an edge table by alternating stars.

Large star: every node links its larger neighbours to the least of its
neighbourhood; small star: every node links its smaller neighbours and itself
to the least of them.  Each round is two aggregations and two joins, written
to the shared folder; components of any size shrink in a logarithmic number of
rounds.  A node with very many neighbours is one key of a partially aggregated
minimum and of a join that adaptive execution splits; its neighbours are never
gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import Scratch


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """``edges``: (u, v) with u > v, distinct."""
    if large:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        out = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        out = (edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
               .unionByName(least.select("u", F.col("m").alias("v"))))
    return out.where("u > v").distinct()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) of every node with an edge; a component is named by
    its least node.  ``edges``: any (u, v).  The result reads a table in
    ``scratch``."""
    now = scratch.write(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                        .where("u > v").distinct(), "edges-0")
    step, seen = 0, None
    while True:
        n, digest = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if (n, digest) == seen or not n:
            break
        seen = n, digest
        step += 1
        nxt = scratch.write(_star(_star(now, True), False), f"edges-{step}")
        scratch.drop(f"edges-{step - 1}")
        now = nxt
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
