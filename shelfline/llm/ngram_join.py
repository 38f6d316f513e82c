"""N-gram Jaccard join by vertical partitioning.

A document's set holds its distinct five-word shingles (64-bit hashes).  All
shingles have one global order: common ones last, then by hash.  Common is what
a count sketch of the whole corpus shows to lie clearly above the average
(a hint for the order only; any order gives the same links).

1. Classes.  Documents with equal sets are one class, named by its least
   doc_id, so exact copies are never compared.
2. The first fragment of the order.  Two sets that reach the threshold share one
   of their first ``n - ceil(t n) + 1`` shingles.  Those are dealt out by hash;
   classes under one shingle are candidates if their sizes and places in the
   order allow the threshold.  Not all pairs of a shingle are made: each class
   is paired with the shingle's centre (the class that comes first).
3. Overlaps.  A pair's overlap in the first fragment bounds the whole one, and
   most candidates end there.  The sets of the others are cut vertically into
   ranges of the order; a pair's overlap is counted in each fragment on its own
   and the counts are summed; the sum decides exactly.
4. Links join classes into components.  In rounds, the classes of a shingle that
   come first (CENTRES of them, twice as many in each further round) are compared
   in the same way with its classes in other components; after its round a class
   is done with under that shingle.  Rounds go on until no shingle has classes of
   two components left: no link between different components is lost, links inside
   a component are not looked at, and a round makes a number of pairs in proportion
   to the classes, not to their square.

Defined cases: null and empty texts have empty sets and link with nothing;
fewer than five words are one shingle; equal doc_ids are treated as one node
whose rows each have their set; a row with a null doc_id links with nothing and
has a null component; an empty table gives an empty result; extra columns are
not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.common import Scratch, documents, prepare_python, release
from shelfline.llm.components import components

WORDS = 5
#: Links: 100 * intersection >= PERCENT * union.
PERCENT = 80
FRAGMENTS = 4
SKETCH_PARTS = 16
#: Hash ranges of the first fragment: one for so many shingles.
RANGE_SHINGLES = 500_000
#: Classes of a shingle that the first round of step 4 compares with the others.
CENTRES = 256
FLUSH = 500_000
CACHE_WORDS = 100_000
#: Ids of candidates are broadcast up to this many (8 bytes each); beyond, both
#: sides are shuffled.
BROADCAST_IDS = 1_000_000

_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                 0xA0761D6478BD642F], np.uint64)


# ---- sets


class WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash
        if len(self) > CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_WORD_HASH = WordHash()


def forget() -> None:
    """What a task leaves behind in its worker."""
    _WORD_HASH.clear()
    release()


def _finish(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct shingle hashes (63 bits).  ``bytes.lower`` changes A-Z
    only and ``bytes.split`` splits on the six ASCII spaces only."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_WORD_HASH.__getitem__, words), np.uint64, n)
    with np.errstate(over="ignore"):
        if n < WORDS:
            total = (h * _MIX[:n]).sum(dtype=np.uint64) + np.uint64(n)
            return _finish(np.array([total], np.uint64)) >> np.uint64(1)
        total = h[:n - 4] * _MIX[0]
        for k in range(1, WORDS):
            total = total + h[k:n - 4 + k] * _MIX[k]
        return np.unique(_finish(total) >> np.uint64(1))


def ordered(found: np.ndarray, common: np.ndarray, bits: int) -> np.ndarray:
    """The set in the global order: the top bit marks common shingles."""
    at = found & np.uint64((1 << bits) - 1)
    flag = (common[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1
    return np.sort(found | (flag.astype(np.uint64) << np.uint64(63)))


def prefix_length(n: int) -> int:
    """Shingles of which a linked set must share one."""
    return n - -(-PERCENT * n // 100) + 1


# ---- the sketch


def _sketch_fn(bits: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(1 << bits, np.uint32)
        mask = np.uint64((1 << bits) - 1)
        for batch in batches:
            for lo in range(0, len(batch), 1000):
                found = [shingles(text) for text in batch["text"][lo:lo + 1000]]
                at = (np.concatenate(found) & mask).astype(np.int64)
                counts += np.bincount(at, minlength=1 << bits).astype(np.uint32)
        if counts.any():
            yield pd.DataFrame({"part": range(SKETCH_PARTS),
                                "counts": [c.tobytes() for c in np.split(counts, SKETCH_PARTS)]})
        forget()
    return run


def _sum_fn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sums per part, one running array for each."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, counts in zip(batch["part"], batch["counts"]):
            c = np.frombuffer(counts, np.uint32).astype(np.int64)
            total[part] = total[part] + c if part in total else c
    if total:
        yield pd.DataFrame({"part": list(total), "counts": [c.tobytes() for c in total.values()]})


def common_shingles(texts: DataFrame, bits: int) -> bytes:
    """One bit for each counter that lies eight deviations above the average:
    2^bits / 8 bytes, whatever the corpus."""
    rows = (texts.mapInPandas(_sketch_fn(bits), "part int, counts binary")
            .repartition(SKETCH_PARTS, "part").mapInPandas(_sum_fn, "part int, counts binary").collect())
    counts = np.zeros(1 << bits, np.int64)
    size = (1 << bits) // SKETCH_PARTS
    for r in rows:
        counts[r["part"] * size:(r["part"] + 1) * size] += np.frombuffer(r["counts"], np.int64)
    mean = counts.mean()
    return np.packbits(counts > mean + 8 * np.sqrt(mean) + 16, bitorder="little").tobytes()


# ---- sets of all documents


def _sets_column(common_bytes, bits: int):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        common = np.frombuffer(common_bytes.value, np.uint8)
        for texts in batches:
            rows = []
            for text in texts:
                s = ordered(shingles(text), common, bits)
                n = len(s)
                rows.append((n, hashlib.md5(s.tobytes()).digest(), s[:prefix_length(n)].view(np.int64).copy() if n else None))
            yield pd.DataFrame(rows, columns=["n", "digest", "prefix"])
        forget()
    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(run, "n long, digest binary, prefix array<long>")


# ---- candidates under shingles that few classes share


def _deal_fn(ranges: int):
    """Entries (shingle, place, size, class) of uncommon shingles, packed by
    column and hash range."""
    def pack(entries: list) -> Iterator[pd.DataFrame]:
        h = np.concatenate([e[0] for e in entries])
        place = np.concatenate([np.arange(len(e[0]), dtype=np.int32) for e in entries])
        reps = np.repeat([e[1] for e in entries], [len(e[0]) for e in entries]).astype(np.int64)
        sizes = np.repeat([e[2] for e in entries], [len(e[0]) for e in entries]).astype(np.int32)
        part = (h % np.uint64(ranges)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        edges = np.searchsorted(part[order], np.arange(ranges + 1))
        rows = []
        for k in range(ranges):
            i = order[edges[k]:edges[k + 1]]
            if len(i):
                rows.append((k, h[i].tobytes(), place[i].tobytes(), sizes[i].tobytes(), reps[i].tobytes()))
        yield pd.DataFrame(rows, columns=["part", "h", "place", "n", "rep"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for batch in batches:
            for rep, n, prefix in zip(batch["rep"], batch["n"], batch["prefix"]):
                p = np.asarray(prefix, np.int64)
                p = p[p >= 0].view(np.uint64)  # common ones come last: places stay
                if len(p):
                    held.append((p, rep, n))
                    size += len(p)
                if size >= FLUSH:
                    yield from pack(held)
                    held, size = [], 0
        if held:
            yield from pack(held)
        release()
    return run


def needed(n1, n2):
    """Least intersection of a link between sets of these sizes."""
    return -(-PERCENT * (n1 + n2) // (100 + PERCENT))


def possible(n1, i1, n2, i2):
    """Whether sets that share the shingle at these places (counted from 0), and
    none before, can link."""
    return np.minimum(n1 - i1, n2 - i2) >= needed(n1, n2)


def _buckets_fn(table: pd.DataFrame) -> pd.DataFrame:
    """One hash range: star pairs (kind 0) of each shingle that classes share,
    and its members where there are three or more (kind 1)."""
    def column(name, kind):
        return np.concatenate([np.frombuffer(b, kind) for b in table[name]])
    h, place, n, rep = (column("h", np.uint64), column("place", np.int32).astype(np.int64),
                        column("n", np.int32).astype(np.int64), column("rep", np.int64))
    order = np.lexsort((rep, place, h))
    h, place, n, rep = h[order], place[order], n[order], rep[order]
    new = np.r_[True, h[1:] != h[:-1]]
    first = np.flatnonzero(new)
    bucket = np.cumsum(new) - 1
    size = np.diff(np.r_[first, len(h)])[bucket]
    centre = first[bucket]
    pair = (size > 1) & (np.arange(len(h)) != centre) & possible(n, place, n[centre], place[centre])
    star = pd.DataFrame({"a": np.minimum(rep[pair], rep[centre][pair]), "b": np.maximum(rep[pair], rep[centre][pair])}
                        ).drop_duplicates()
    star = star[star["a"] != star["b"]].assign(kind=0, h=0, place=0, n=0)
    many = size > 2
    members = pd.DataFrame({"a": rep[many], "b": 0, "kind": 1, "h": h[many].view(np.int64), "place": place[many],
                            "n": n[many]})
    release()
    return pd.concat([star, members])[["kind", "a", "b", "h", "place", "n"]]


_BUCKET_SCHEMA = "kind int, a long, b long, h long, place long, n long"

_POSSIBLE = (f"least(x_n - x_place, y_n - y_place) * {100 + PERCENT} >= {PERCENT} * (x_n + y_n)")


def _common_candidates(classes: DataFrame) -> DataFrame:
    """The same for common shingles, whose classes may be very many: the centre
    is a partially aggregated minimum, joined back (skew is split)."""
    entries = (classes.select("rep", "n", F.posexplode("prefix").alias("place", "h")).where("h < 0"))
    centre = (entries.groupBy("h").agg(F.min(F.struct("place", "rep", "n")).alias("c"), F.count(F.lit(1)).alias("size"))
              .where("size > 1").select("h", "size", F.col("c.place").alias("y_place"), F.col("c.rep").alias("y"),
                                        F.col("c.n").alias("y_n")))
    joined = entries.join(centre, "h").withColumnsRenamed({"place": "x_place", "rep": "x", "n": "x_n"})
    star = joined.where(F.expr(_POSSIBLE) & (F.col("x") != F.col("y"))).select(
        F.lit(0).alias("kind"), F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"),
        F.lit(0).cast("long").alias("h"), F.lit(0).cast("long").alias("place"), F.lit(0).cast("long").alias("n")
    ).distinct()
    members = joined.where("size > 2").select(
        F.lit(1).alias("kind"), F.col("x").alias("a"), F.lit(0).cast("long").alias("b"), "h",
        F.col("x_place").cast("long").alias("place"), F.col("x_n").cast("long").alias("n"))
    return star.unionByName(members)


# ---- overlaps


def _fragments_fn(common_bytes, bits: int):
    shift = np.uint64(64 - (FRAGMENTS - 1).bit_length() - 1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        common = np.frombuffer(common_bytes.value, np.uint8)
        for batch in batches:
            for lo in range(0, len(batch), 500):
                rows = []
                for doc_id, text in zip(batch["doc_id"][lo:lo + 500], batch["text"][lo:lo + 500]):
                    s = ordered(shingles(text), common, bits)
                    own = int.from_bytes(hashlib.md5(s.tobytes()).digest()[:8], "little", signed=True)
                    part = np.minimum(s >> shift, np.uint64(2 * FRAGMENTS - 1)).astype(np.int64)
                    edges = np.searchsorted(part, np.arange(2 * FRAGMENTS + 1))
                    for k in range(2 * FRAGMENTS):
                        if edges[k + 1] > edges[k]:
                            rows.append((doc_id, own, k, len(s), s[edges[k]:edges[k + 1]].view(np.int64)))
                yield pd.DataFrame(rows, columns=["rep", "own", "fragment", "n", "items"])
        forget()
    return run


#: ``own`` tells the sets of rows with equal doc_ids apart.
_FRAGMENT_SCHEMA = "rep long, own long, fragment int, n int, items array<long>"


def _only(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows whose key is among the ids (a written table with column id)."""
    ids = ids.withColumnRenamed("id", key)
    return rows.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, key, "left_semi")


def _ids(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()


def first_fragment(pairs: DataFrame, classes: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """The pairs that can still link by their overlap in the first fragment: what
    they share up to the place where the shorter first fragment ends, plus the
    smaller rest."""
    ids = scratch.write(_ids(pairs), f"first-{name}")
    sets = scratch.write(_only(classes.select("rep", "n", "prefix"), ids, "rep"), f"prefixes-{name}")
    a, b = (sets.select(*[F.col(c).alias(f"{c}_{x}") for c in ("n", "prefix")], F.col("rep").alias(x)) for x in "ab")
    joined = pairs.join(a, "a").join(b, "b")
    top = F.lit(-(1 << 63))                             # unsigned order by flipping the top bit
    last = F.least(*[F.element_at(f"prefix_{x}", -1).bitwiseXOR(top) for x in "ab"])
    joined = joined.withColumn("end", last)
    rest = [F.col(f"n_{x}") - F.size(F.filter(f"prefix_{x}", lambda v: v.bitwiseXOR(top) <= F.col("end"))) for x in "ab"]
    most = F.size(F.array_intersect("prefix_a", "prefix_b")) + F.least(*rest)
    # one id may name several classes: a pair is counted once
    out = scratch.write(joined.where(most * (100 + PERCENT) >= PERCENT * (F.col("n_a") + F.col("n_b")))
                        .select("a", "b").distinct(), f"possible-{name}")
    scratch.drop(f"first-{name}", f"prefixes-{name}")
    return out


class Overlaps:
    """Exact decisions on pairs, from the texts of the classes' documents."""

    def __init__(self, docs: DataFrame, classes: DataFrame, repeated: DataFrame, scratch: Scratch, common, bits: int):
        self.docs, self.classes, self.scratch = docs, classes, scratch
        self.repeated = None if repeated.isEmpty() else repeated
        self.common, self.bits, self.round = common, bits, 0

    def once(self, sets: DataFrame) -> DataFrame:
        """The fragments without the repeats of rows that have one doc_id and one
        set; only those rows are shuffled for it."""
        if self.repeated is None:
            return sets
        ids = self.repeated.withColumnRenamed("id", "rep")
        others = sets.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "rep", "left_anti")
        return others.unionByName(_only(sets, self.repeated, "rep").dropDuplicates(["rep", "own", "fragment"]))

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that reach the threshold: overlaps are counted in
        each fragment and summed."""
        self.round += 1
        pairs = first_fragment(pairs, self.classes, self.scratch, str(self.round))
        ids = self.scratch.write(_ids(pairs), f"ids-{self.round}")
        texts = _only(self.docs, ids, "doc_id")
        sets = self.scratch.write(texts.mapInPandas(_fragments_fn(self.common, self.bits), _FRAGMENT_SCHEMA),
                                  f"fragments-{self.round}")
        sets = self.once(sets)
        a, b = (sets.select(F.col("rep").alias(x), "fragment", *[F.col(c).alias(f"{c}_{x}") for c in ("own", "n", "items")])
                for x in "ab")
        joined = pairs.join(a, "a").join(b, ["b", "fragment"])
        key = ["a", "own_a", "n_a", "b", "own_b", "n_b"]
        partial = joined.select(*key, F.size(F.array_intersect("items_a", "items_b")).alias("shared"))
        summed = partial.groupBy(*key).agg(F.sum("shared").alias("shared"))
        out = self.scratch.write(
            summed.where(f"100 * shared >= {PERCENT} * (n_a + n_b - shared)").select("a", "b").distinct(),
            f"links-{self.round}")
        self.scratch.drop(f"fragments-{self.round}", f"possible-{self.round}", f"ids-{self.round}")
        return out


def jaccard_classes(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id), one row a document."""
    spark = docs.sparkSession
    prepare_python(spark)
    scratch = Scratch(spark, "ngram-join")
    docs = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(22, max(16, (size // 1024).bit_length()))
    common = spark.sparkContext.broadcast(common_shingles(docs.select("text"), bits))
    sets = scratch.write(docs.select("doc_id", _sets_column(common, bits)(F.col("text")).alias("s"))
                         .select("doc_id", "s.*"), "sets")
    keyed = sets.where("n > 0 and doc_id is not null")
    classes = scratch.write(keyed.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"),
                                                        F.first("prefix").alias("prefix")), "classes")
    total = classes.agg(F.sum(F.size("prefix"))).first()[0] or 0
    ranges = int(max(16, -(-total // RANGE_SHINGLES)))
    dealt = classes.select("rep", "n", "prefix").mapInPandas(
        _deal_fn(ranges), "part int, h binary, place binary, n binary, rep binary")
    found = dealt.groupBy("part").applyInPandas(_buckets_fn, _BUCKET_SCHEMA)
    found = scratch.write(found.unionByName(_common_candidates(classes.select("rep", "n", "prefix"))), "candidates")
    members = found.where("kind = 1").select(F.col("a").alias("rep"), "h", "place", "n")

    repeated = scratch.write(keyed.groupBy("doc_id", "digest").count().where("count > 1")
                             .select(F.col("doc_id").alias("id")).distinct(), "repeated")
    verifier = Overlaps(docs, classes, repeated, scratch, common, bits)
    compared = scratch.write(found.where("kind = 0").select("a", "b").distinct(), "pairs-0")
    links = verifier.links(compared)
    same = _equal_ids(keyed, classes)
    joined, turn = None, 0
    while True:
        if joined is None:
            edges = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(same)
            stars = Scratch(spark, "components")
            joined = scratch.write(components(edges, stars), f"components-{turn}")
            stars.drop()
        # what is open shrinks from round to round, so a round reads the one before
        alive = scratch.write(_open_members(members, joined), f"open-{turn}")
        if alive.isEmpty():
            break
        centres = scratch.write(_first_members(alive, CENTRES << turn), f"centres-{turn}")
        more = scratch.write(_across(alive, centres, compared), f"across-{turn}")
        members = scratch.write(alive.join(centres.select("h", "rep"), ["h", "rep"], "left_anti"), f"members-{turn}")
        scratch.drop(f"open-{turn}", f"centres-{turn}", *([f"members-{turn - 1}"] if turn else ["candidates"]))
        turn += 1
        if not more.isEmpty():
            compared = compared.unionByName(more)
            links, joined = links.unionByName(verifier.links(more)), None
            scratch.drop(f"components-{turn - 1}")
    rep_of = classes.select("digest", "rep").join(
        joined.withColumnRenamed("node", "rep"), "rep", "left").select(
        "digest", F.coalesce("component", "rep").alias("component_id"))
    rows = sets.select("doc_id", "n", F.when(F.col("doc_id").isNotNull() & (F.col("n") > 0), F.col("digest")).alias("digest"))
    out = Scratch(spark, "ngram-classes").write(
        rows.join(rep_of, "digest", "left").select("doc_id", F.col("n").alias("n_shingles"),
                                                   F.coalesce("component_id", "doc_id").alias("component_id")), "classes")
    scratch.drop()
    return out


def _equal_ids(keyed: DataFrame, classes: DataFrame) -> DataFrame:
    """Edges (u, v) that make the rows of one doc_id, where their sets differ,
    one node."""
    several = keyed.groupBy("doc_id").agg(F.min("digest").alias("d1"), F.max("digest").alias("d2")).where("d1 <> d2")
    return (keyed.join(several.select("doc_id"), "doc_id", "left_semi").join(classes.select("digest", "rep"), "digest")
            .select(F.col("doc_id").alias("u"), F.col("rep").alias("v")).distinct())


def _open_members(members: DataFrame, joined: DataFrame) -> DataFrame:
    """Classes under a shingle (rep, h, place, n, component) that may have to be compared
    yet: of a size and place that some partner there could link with, and under a shingle
    whose such classes lie in several components."""
    named = (members.select("rep", "h", "place", "n").join(joined.withColumnRenamed("node", "rep"), "rep", "left")
             .select("rep", "h", "place", "n", F.coalesce("component", "rep").alias("component")))
    bounds = named.groupBy("h").agg(F.min("n").alias("least"), F.max(F.col("n") - F.col("place")).alias("room"))
    smallest = F.greatest(F.col("least"), F.ceil(F.col("n") * PERCENT / 100))
    alive = named.join(bounds, "h").where(
        F.least(F.col("n") - F.col("place"), F.col("room")) * (100 + PERCENT) >= PERCENT * (F.col("n") + smallest))
    open_ = (alive.groupBy("h").agg(F.min("component").alias("c1"), F.max("component").alias("c2"))
             .where("c1 <> c2").select("h"))
    return alive.join(open_, "h", "left_semi").select("rep", "h", "place", "n", "component")


def _first_members(alive: DataFrame, most: int) -> DataFrame:
    """The ``most`` classes of each shingle that come first; each task keeps so many
    before the shuffle."""
    first = Window.partitionBy("h").orderBy("place", "rep", "n")
    return alive.withColumn("_k", F.row_number().over(first)).where(F.col("_k") <= most).drop("_k")


def _across(alive: DataFrame, centres: DataFrame, compared: DataFrame) -> DataFrame:
    """Pairs of a centre and a class of its shingle in another component that sizes and
    places allow and that were not compared."""
    x = centres.select("h", *[F.col(c).alias(f"x_{c}") for c in ("rep", "place", "n", "component")])
    y = alive.select("h", *[F.col(c).alias(f"y_{c}") for c in ("rep", "place", "n", "component")])
    pairs = y.join(x, "h").where(F.expr("x_component <> y_component and " + _POSSIBLE))
    return (pairs.select(F.least("x_rep", "y_rep").alias("a"), F.greatest("x_rep", "y_rep").alias("b")).distinct()
            .join(compared, ["a", "b"], "left_anti"))


def op10_ngram_join(spark, sf_dir):
    return jaccard_classes(documents(spark, sf_dir))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: The links by counting the shared shingles of every pair that shares one, the
#: components by following links from each document.
ORACLE_SQL = rf"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + {WORDS - 1}], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {WORDS - 1}, 1) + 1)) AS i FROM split WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id
  GROUP BY 1, 2),
links AS MATERIALIZED (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared.n >= {PERCENT} * (x.n + y.n - shared.n)),
both_ways AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(doc_id, other) AS (
  SELECT a, a FROM both_ways UNION SELECT r.doc_id, l.b FROM reached r JOIN both_ways l ON l.a = r.other)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(least(d.doc_id, min(r.other)), d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN reached r ON r.doc_id = d.doc_id
GROUP BY d.doc_id, s.n
"""
