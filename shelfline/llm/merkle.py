"""Merkle dataset manifest by a cogrouped subtree exchange.

The rows of a language are the leaves of a tree, in the order of doc_id; the
languages' roots are the leaves of the tree that ends in the manifest's root.
Every two consecutive nodes become their digest, until one is left.

1. Leaves.  Digests of the rows' fields are made where the rows are read; texts
   are not shuffled.  Leaves get their places by a range partitioning
   (``ranking``), so one language may hold all rows.
2. Reduction.  2^BITS consecutive leaves are a superblock.  Each is reduced to
   its top node by itself; the tops are the leaves of the next tree, reduced in
   the same way until each tree has one node.  No group has more than 2^BITS
   rows, whatever the number of rows or languages.
3. Subtree exchange.  From the top down, the nodes of each superblock are
   cogrouped with the outer nodes that its top needs on the way to the root.
   One pass in ``applyInPandas`` reduces the superblock, joins each node's inner
   siblings with the outer ones to its proof, and folds a claimed leaf along it.

Digests are lowercase hex and are hashed as such; a field is ``-`` if null, else
its number of UTF-8 bytes, ``:`` and its value.  ``sides`` has, for each sibling
of a proof, ``l`` where it lies to the left and ``r`` where it lies to the right;
a node without a sibling is hashed alone (``.``).

Defined cases: a null lang is a language of its own, before all others; a null
doc_id comes first and is never tampered with (it has no decimal form); null and
empty texts are different leaves; equal doc_ids are ordered by their leaves, so
repeated rows have equal leaves at consecutive places; texts of any length are
one digest; an empty table gives an empty result; columns other than doc_id,
source, lang, n_chars and text are not read.
"""

from __future__ import annotations

from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm.common import Scratch, crc32_sql, documents, prepare_python
from shelfline.llm.ranking import ranked

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: A superblock has 2^BITS nodes.
BITS = 12
#: Rows whose crc32 this divides are tampered with by the query.
EVERY = 7

NODE_SCHEMA = "tree string, pos long, size long, node string"
PROOF_SCHEMA = ("id string, tree string, pos long, node string, siblings string, sides string, "
                "top string, folded string")


# ---- leaves


def _field(c: Column) -> Column:
    text = c.cast("string")
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(**changed: Column) -> Column:
    """Digest of a row's fields, some of them replaced."""
    return F.sha2(F.concat(*[_field(changed.get(f, F.col(f))) for f in FIELDS]).cast("binary"), 256)


def tampered() -> Column:
    """n_chars as the query's tampering leaves it (null: this row is not touched; so is
    one whose n_chars has no successor)."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % EVERY == 0
    return F.when(hit, F.try_add("n_chars", F.lit(1).cast("long")))


def leaves(docs: DataFrame, claimed_n_chars: Column | None = None) -> DataFrame:
    """(id, tree, leaf, claimed) of the rows; ``claimed`` is the digest of a row
    whose n_chars is replaced, null where the replacement is null."""
    claimed = F.lit(None).cast("string")
    if claimed_n_chars is not None:
        claimed = F.when(claimed_n_chars.isNotNull(), leaf(n_chars=claimed_n_chars))
    tree = F.when(F.col("lang").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("lang")))
    return docs.select(F.col("doc_id").cast("long").alias("id"), tree.alias("tree"), leaf().alias("leaf"),
                       claimed.alias("claimed"))


# ---- subtrees


def _digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def levels(nodes: list[str], size: int, bits: int) -> list[list[str]]:
    """The levels of a superblock, its own nodes first.  Where it is not the whole
    tree (of ``size`` nodes) it is reduced through all ``bits`` levels."""
    out, part = [nodes], size > 1 << bits
    while len(out[-1]) > 1 or (part and len(out) <= bits):
        now = out[-1]
        out.append([_digest(now[i] + now[i + 1]) if i + 1 < len(now) else _digest(now[i])
                    for i in range(0, len(now), 2)])
    return out


def fold(node: str, siblings: str, sides: str) -> str:
    """The root that a node and its proof lead to."""
    at = 0
    for side in sides:
        if side == ".":
            node = _digest(node)
            continue
        other = siblings[at:at + 64]
        at += 64
        node = _digest(other + node if side == "l" else node + other)
    return node


def reduced(nodes: DataFrame, bits: int = BITS) -> DataFrame:
    """The top node of every superblock, as a node of the next tree."""
    def reduce(table: pd.DataFrame) -> pd.DataFrame:
        table = table.sort_values("pos")
        size, block = int(table["size"].iloc[0]), int(table["pos"].iloc[0]) >> bits
        top = levels(table["node"].tolist(), size, bits)[-1][0]
        return pd.DataFrame({"tree": [table["tree"].iloc[0]], "pos": [block], "size": [-(-size >> bits)], "node": [top]})

    return (nodes.select("tree", "pos", "size", "node").groupBy("tree", F.shiftright("pos", bits))
            .applyInPandas(reduce, NODE_SCHEMA))


def exchanged(nodes: DataFrame, outer: DataFrame, bits: int = BITS) -> DataFrame:
    """Proofs of all nodes (id, tree, pos, size, node, claimed): each superblock
    with the outer nodes of its top (tree, pos, siblings, sides, top)."""
    names = [c.split()[0] for c in PROOF_SCHEMA.split(", ")]

    def exchange(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        nodes, tree = nodes.sort_values("pos"), nodes["tree"].iloc[0]
        siblings, sides, top = outer["siblings"].iloc[0], outer["sides"].iloc[0], outer["top"].iloc[0]
        own = nodes["node"].tolist()
        inner = levels(own, int(nodes["size"].iloc[0]), bits)[:-1]
        rows = []
        for i, (row, pos, node, claimed) in enumerate(zip(nodes["id"], nodes["pos"], own, nodes["claimed"])):
            found, ways, k = [], [], i
            for level in inner:
                if k ^ 1 < len(level):
                    found.append(level[k ^ 1])
                    ways.append("l" if k & 1 else "r")
                else:
                    ways.append(".")
                k >>= 1
            proof, way = "".join(found) + siblings, "".join(ways) + sides
            claim = claimed if isinstance(claimed, str) else node
            rows.append((row, tree, pos, node, proof, way, top, fold(claim, proof, way)))
        return pd.DataFrame(rows, columns=names)

    return (nodes.withColumn("id", F.col("id").cast("string"))      # pandas has no null long
            .groupBy("tree", F.shiftright("pos", bits))
            .cogroup(outer.select("tree", "pos", "siblings", "sides", "top").groupBy("tree", "pos"))
            .applyInPandas(exchange, PROOF_SCHEMA).withColumn("id", F.col("id").cast("long")))


def outer_nodes(tops: DataFrame, scratch: Scratch, name: str, bits: int = BITS) -> DataFrame:
    """For every node of the written table ``tops`` its siblings up to the root
    of its tree, and that root."""
    if tops.where("size > 1").isEmpty():
        return tops.select("tree", "pos", F.lit("").alias("siblings"), F.lit("").alias("sides"), F.col("node").alias("top"))
    above = scratch.write(reduced(tops, bits), f"{name}+")
    up = outer_nodes(above, scratch, f"{name}+", bits)
    none = F.lit(None).cast("string")
    proofs = exchanged(tops.withColumns({"id": none, "claimed": none}), up, bits)
    return scratch.write(proofs.select("tree", "pos", "siblings", "sides", "top"), f"{name}-outer")


def manifest(found: DataFrame, bits: int = BITS) -> DataFrame:
    """(id, leaf, subroot, root, siblings, sides, folded_root) of leaves
    (id, tree, leaf, claimed); the folded root is that of the claimed leaf where
    there is one."""
    spark = found.sparkSession
    prepare_python(spark)
    scratch = Scratch(spark, "merkle")
    found = scratch.write(found.withColumnRenamed("leaf", "node"), "leaves")
    nodes = ranked(found, "tree", ["id", "node"], scratch, "leaves")
    tops = scratch.write(reduced(nodes, bits), "tops")
    inner = outer_nodes(tops, scratch, "tops", bits).withColumnRenamed("top", "subroot")
    # the languages' roots, in order, are one more tree
    roots = scratch.write(inner.where("pos = 0").select(F.lit("").alias("all"), F.col("tree").alias("name"),
                                                        F.col("subroot").alias("node")), "subroots")
    ends = scratch.write(ranked(roots, "all", ["name"], scratch, "subroots")
                         .select(F.col("all").alias("tree"), "name", "pos", "size", "node"), "ends")
    over = outer_nodes(ends.drop("name"), scratch, "languages", bits)
    over = ends.select("name", "pos").join(over, "pos").select(
        F.col("name").alias("tree"), F.col("siblings").alias("_siblings"), F.col("sides").alias("_sides"), "top")
    outer = scratch.write(inner.join(over, "tree").select(
        "tree", "pos", F.concat("siblings", "_siblings").alias("siblings"), F.concat("sides", "_sides").alias("sides"),
        F.concat("subroot", "top").alias("top")), "outer")
    return exchanged(nodes, outer, bits).select(
        "id", F.col("node").alias("leaf"), F.substring("top", 1, 64).alias("subroot"), F.substring("top", 65, 64).alias("root"),
        "siblings", "sides", F.col("folded").alias("folded_root"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = manifest(leaves(documents(spark, sf_dir), tampered()))
    return found.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root",
                        F.sha2(F.col("siblings").cast("binary"), 256).alias("proof_sha256"), "folded_root",
                        (F.col("folded_root") == F.col("root")).alias("verified"))


def _field_sql(column: str) -> str:
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE strlen({column}::VARCHAR) || ':' || {column}::VARCHAR END"


def _leaf_sql(n_chars: str = "n_chars") -> str:
    return "sha256(" + " || ".join(_field_sql(n_chars if f == "n_chars" else f) for f in FIELDS) + ")"


#: Trees are reduced level by level; ``way`` holds each leaf's sibling of a level.
ORACLE_SQL = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, lang, {_leaf_sql()} AS leaf,
         CASE WHEN {crc32_sql("doc_id::VARCHAR")} % {EVERY} = 0 AND n_chars IS NOT NULL
              THEN {_leaf_sql("(n_chars + 1)")} END AS claimed
  FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         row_number() OVER () AS row_no FROM leaves),
lower_tree(level, lang, pos, node, size) AS (
  SELECT 0, lang, pos, leaf, count(*) OVER (PARTITION BY lang) FROM placed
  UNION ALL
  SELECT any_value(level) + 1, lang, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), (any_value(size) + 1) // 2
  FROM lower_tree WHERE size > 1 GROUP BY lang, pos // 2),
subroots AS (
  SELECT lang, level, node, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS size
  FROM lower_tree WHERE size = 1),
upper_tree(level, pos, node, size) AS (
  SELECT 0, pos, node, size FROM subroots
  UNION ALL
  SELECT any_value(level) + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), (any_value(size) + 1) // 2
  FROM upper_tree WHERE size > 1 GROUP BY pos // 2),
way AS (
  SELECT p.row_no, t.level, t.node, t.pos & 1 = 0 AS before FROM placed p JOIN lower_tree t
    ON t.lang IS NOT DISTINCT FROM p.lang AND t.pos = xor(p.pos >> t.level, 1)
  UNION ALL
  SELECT p.row_no, s.level + t.level, t.node, t.pos & 1 = 0 FROM placed p JOIN subroots s
    ON s.lang IS NOT DISTINCT FROM p.lang JOIN upper_tree t ON t.pos = xor(s.pos >> t.level, 1)),
heights AS (
  SELECT p.row_no, s.node AS subroot, s.level + (SELECT max(level) FROM upper_tree) AS height
  FROM placed p JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang),
proofs AS (SELECT row_no, string_agg(node, '' ORDER BY level) AS proof FROM way GROUP BY row_no),
folded(row_no, level, node) AS (
  SELECT row_no, 0, coalesce(claimed, leaf) FROM placed
  UNION ALL
  SELECT f.row_no, f.level + 1,
         sha256(CASE WHEN w.node IS NULL THEN f.node WHEN w.before THEN w.node || f.node ELSE f.node || w.node END)
  FROM folded f JOIN heights h ON h.row_no = f.row_no LEFT JOIN way w ON w.row_no = f.row_no AND w.level = f.level
  WHERE f.level < h.height),
root AS (SELECT node AS root FROM upper_tree WHERE size = 1)
SELECT p.doc_id, p.leaf, h.subroot, r.root, sha256(coalesce(q.proof, '')) AS proof_sha256,
       f.node AS folded_root, f.node = r.root AS verified
FROM placed p JOIN heights h USING (row_no) LEFT JOIN proofs q USING (row_no)
JOIN folded f ON f.row_no = p.row_no AND f.level = h.height CROSS JOIN root r
"""
