"""Merkle manifest, exact copies and repaired conversations against brute force."""

import zlib
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from shelfline.llm import heavy_hitters, merkle
from shelfline.llm.common import Scratch, crc32_sql
from shelfline.llm.queries import ORACLE, QUERIES
from shelfline.llm.ranking import ranked
from tests.conftest import SMALL
from tests.llm.test_rows import edges
from tools.check import rows_of


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_queries_match_sql(spark, duck, key):
    df = QUERIES[key](spark, SMALL)
    cur = duck.execute(ORACLE[key])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(cols, cur.fetchall())


def test_crc32_sql(duck):
    for text in ("", "0", "12345", "-7", "9223372036854775807"):
        assert duck.execute(f"SELECT {crc32_sql('t')} FROM (SELECT '{text}' AS t)").fetchone()[0] == zlib.crc32(text.encode())


def test_places_within_a_hot_key(spark):
    key = F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 7).cast("string")))
    rows = spark.range(5000).select(key.alias("key"), (F.col("id") * 7919 % 5000).alias("v"), F.lit("clash").alias("n"))
    found = defaultdict(list)
    for r in ranked(rows, "key", ["v"], Scratch(spark, "t"), "t").collect():
        found[r.key].append((r.pos, r.v, r.size))
    for got in found.values():
        got.sort()
        assert [p for p, _, _ in got] == list(range(len(got)))
        assert [v for _, v, _ in got] == sorted(v for _, v, _ in got)
        assert {s for _, _, s in got} == {len(got)}


# ---- op11


def h(*parts):
    return sha256("".join(parts).encode("utf-8")).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode('utf-8'))}:{v}"


def tree_by_hand(nodes):
    """(root, proof of each leaf) by whole levels."""
    proofs, at, now = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(now) > 1:
        for p, k in zip(proofs, at):
            if k ^ 1 < len(now):
                p.append((k & 1, now[k ^ 1]))
            else:
                p.append(None)
        now = [h(*now[i:i + 2]) for i in range(0, len(now), 2)]
        at = [k // 2 for k in at]
    return now[0], proofs


def manifest_by_hand(rows):
    by_lang = defaultdict(list)
    for doc_id, text, lang, source, n in rows:
        leaf = h(*map(field, (doc_id, source, lang, n, text)))
        bad = doc_id is not None and n is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0
        by_lang[lang].append((doc_id is not None, doc_id or 0, leaf, doc_id,
                              h(*map(field, (doc_id, source, lang, n + 1, text))) if bad else leaf))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    subs = {x: tree_by_hand([r[2] for r in sorted(by_lang[x])]) for x in langs}
    root, over = tree_by_hand([subs[x][0] for x in langs])
    out = []
    for x, up in zip(langs, over):
        for (_, _, leaf, doc_id, claim), own in zip(sorted(by_lang[x]), subs[x][1]):
            node = claim
            for step in own + up:
                node = h(node) if step is None else h(step[1], node) if step[0] else h(node, step[1])
            out.append((doc_id, leaf, subs[x][0], root, h(*[s[1] for s in own + up if s]), node, node == root))
    return sorted(out, key=repr)


def digest_rows(df):
    out = df.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2(F.col("siblings").cast("binary"), 256),
                    "folded_root", F.col("folded_root") == F.col("root"))
    return sorted(map(tuple, out.collect()), key=repr)


MANIFEST = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("n, bits", [(1, 2), (2, 1), (5, 1), (9, 2), (65, 2), (70, 3), (200, 12)])
def test_manifest_by_hand(spark, n, bits):
    """One language holds two thirds; small superblocks nest several times."""
    rows = [(i * 37 % 1009, None if i % 11 == 0 else f"text {i}", [None, "en", "en", "en", "ß", ""][i % 6], f"s{i % 4}" if i % 5 else None,
             None if i % 13 == 0 else i) for i in range(n)]
    rows += [(None, "no id", "en", "s", 5), (None, None, None, None, None), rows[0], rows[0]] if n > 2 else []
    docs = spark.createDataFrame(rows, MANIFEST).withColumns({c: F.lit("clash") for c in ("node", "pos", "size", "tree", "claimed")})
    found = merkle.manifest(merkle.leaves(docs, merkle.tampered()), bits)
    assert digest_rows(found) == manifest_by_hand(rows)


def test_manifest_proofs_and_edges(spark):
    docs = edges(spark).withColumns({"lang": F.lit(None).cast("string"), "source": F.lit("s"), "n_chars": F.lit(1).cast("long")})
    rows = [(r.doc_id, r.text, None, "s", 1) for r in docs.collect()]
    found = merkle.manifest(merkle.leaves(docs, merkle.tampered()))
    assert digest_rows(found) == manifest_by_hand(rows)
    for r in merkle.manifest(merkle.leaves(docs), 1).collect():
        assert merkle.fold(r.leaf, r.siblings, r.sides) == r.root == r.folded_root
        assert r.leaf == r.root or merkle.fold(h("x"), r.siblings, r.sides) != r.root
    assert merkle.manifest(merkle.leaves(docs.limit(0), merkle.tampered())).collect() == []


# ---- op12


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def copies_by_hand(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[lowered(text)].append(doc_id)
    out = []
    for text, ids in groups.items():
        ids.sort(key=lambda i: (i is not None, i or 0), reverse=True)
        out += [(i, ids[0], len(ids), k == 0, sha256(text.encode()).hexdigest()) for k, i in enumerate(ids)]
    return sorted(out, key=repr)


def copy_rows(df):
    return sorted(map(tuple, df.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest"))).collect()), key=repr)


@pytest.mark.parametrize("k", [1, 3, 1024])
def test_copies_by_hand(spark, k):
    """A third of the rows are copies of one text; the rest are pairs, single
    texts, repeated rows, nulls and case variants outside A-Z."""
    rows = [(i, "HOT text" if i % 3 == 0 else f"Text {i // 2}") for i in range(600)]
    rows += [(7, "É"), (8, "é"), (9, "İ"), (None, None), (10, ""), (None, "hot TEXT"), (11, None), (12, "x" * 300_000), (13, "X" * 300_000)]
    rows += [(999, "rep")] * 4
    docs = (spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
            .withColumns({c: F.lit(1) for c in ("digest", "seq", "keep", "n", "row", "place", "keep_id")}))
    assert copy_rows(heavy_hitters.marked(docs, k=k)) == copies_by_hand(rows)
    kept = heavy_hitters.drop_copies(docs, k=k)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, sha256(lowered(r.text).encode()).hexdigest()) for r in kept.collect()), key=repr)
    assert got == sorted(((r[0], r[4]) for r in copies_by_hand(rows) if r[3]), key=repr)


def test_copies_edges(spark):
    docs = edges(spark)
    assert copy_rows(heavy_hitters.marked(docs)) == copies_by_hand([(r.doc_id, r.text) for r in docs.collect()])
    assert heavy_hitters.marked(docs.limit(0)).collect() == []
    assert heavy_hitters.drop_copies(docs.limit(0)).collect() == []


def test_frequent_digests_are_all_found_and_few(spark):
    """Every digest of 3n/(k+1) rows is found, at most k+1 are, whatever the
    order and the tasks."""
    k = 20
    for parts in (1, 3, 16):
        rows = spark.range(4200).select(
            F.when(F.col("id") % 6 == 0, F.lit("a")).when(F.col("id") < 700, F.lit("b"))
            .otherwise(F.concat(F.lit("t"), (F.col("id") % 900).cast("string"))).cast("binary").alias("digest")).repartition(parts)
        found = {bytes(r.digest) for r in heavy_hitters.frequent_digests(rows, k).collect()}
        assert {b"a"} <= found and len(found) <= k + 1
    summary = heavy_hitters.Summary(10)                 # x has a third of all, more than 3/11
    for i in range(50):
        summary.add([b"x", *(b"%d" % (i * 2 + j) for j in range(2))])
    assert b"x" in dict(summary.frequent())
