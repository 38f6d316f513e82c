"""Exact vector retrieval: single-query top-k (H1), metadata-filtered top-k
(D7) and batched top-k per query (H3).

Scores are cosine similarities rounded half-up to 6 decimals; ranking is by
rounded score, then document id, so ties are deterministic.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfline.functions import columns as C
from shelfline.functions import vectors as VX
from shelfline.operators.ids import sequential_ids
from shelfline.session import scratch_path, ship_package

SCORE_DECIMALS = 6
# Queries shipped to the tasks at once, and documents scored at once against
# them: a product of at most QUERY_BLOCK x DOC_BLOCK scores is in memory.
QUERY_BLOCK = 2048
DOC_BLOCK = 1024
# Blocks of queries that go through the documents together: one scan serves up to
# QUERY_BLOCK x SCAN_BLOCKS queries (of 64 dimensions 32 MB, shipped a block at a time).
SCAN_BLOCKS = 32


def first_doc_vector(vectors: DataFrame) -> list[float]:
    """Query of a "more like this" search: the lowest-id document's vector.
    One vector reaches the driver (a global ``min_by``), never the table."""
    row = vectors.agg(F.min_by("embedding", "doc_id").alias("v")).first()
    return [float(x) for x in row["v"]] if row and row["v"] is not None else []


def _score(query_vec: list[float], vectors: DataFrame) -> "F.Column":
    """Cosine to a literal query; a stored ``norm`` column is used if there is one."""
    norm = F.col("norm") if "norm" in vectors.columns else VX.norm("embedding")
    q = F.lit(query_vec).cast("array<double>")
    qnorm = float(np.linalg.norm(np.asarray(query_vec, dtype=np.float64))) if query_vec else 0.0
    return C.rounded(VX.cosine("embedding", q, norm, F.lit(qnorm)), SCORE_DECIMALS)


def vector_topk(vectors: DataFrame, query_vec: list[float], k: int = 4,
                pivots: list[list[float]] | None = None) -> DataFrame:
    """H1: the k nearest documents to one query vector.

    The query is a literal in the plan: one score per row in the scan, and
    TakeOrderedAndProject keeps k rows per partition before the final
    merge.  With ``pivots`` (those of the vectors' stored ``pivot_distances``) only
    vectors that can be among the k are scored (``nearby``); the result is the same."""
    near = vectors if pivots is None else nearby(vectors, query_vec, k, pivots)
    scored = near.select("doc_id", _score(query_vec, vectors).alias("score"))
    return scored.orderBy(F.desc_nulls_last("score"), "doc_id").limit(k)


# ---- pivots: a vector's distances to a few fixed ones bound its distance to any other

PIVOTS = 8
#: Vectors that pivots are chosen from (a documented sample; any choice is correct).
PIVOT_SAMPLE = 2000


def choose_pivots(vectors: DataFrame, n: int = PIVOTS, most: int = PIVOT_SAMPLE) -> list[list[float]]:
    """Unit vectors far from one another: of at most ``most`` vectors (the first by a hash
    of the id) each next pivot is the one farthest from those before."""
    some = (vectors.where(F.col("embedding").isNotNull()).select("doc_id", "embedding")
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).toPandas())
    if not len(some):
        return []
    dim = int(some["embedding"].map(len).mode().iloc[0])
    m = np.array([np.asarray(v, np.float64) for v in some["embedding"] if len(v) == dim])
    m = m[np.linalg.norm(m, axis=1) > 0]
    m = m / np.linalg.norm(m, axis=1)[:, None]
    chosen, far = [], np.full(len(m), np.inf)
    while len(chosen) < min(n, len(m)):
        chosen.append(int(np.argmax(far)))
        far = np.minimum(far, np.linalg.norm(m - m[chosen[-1]], axis=1))
    return m[chosen].tolist()


def pivot_distances(pivots: list[list[float]]) -> "F.Column":
    """Distances of ``embedding`` / ``norm`` on the unit sphere to the pivots; null where
    there is none (no vector, of length 0, or of another dimension)."""
    def distance(p: list[float]):
        cosine = VX.cosine("embedding", F.lit(p).cast("array<double>"), F.col("norm"), F.lit(1.0))
        return F.sqrt(F.greatest(F.lit(2.0) - F.lit(2.0) * cosine, F.lit(0.0)))
    usable = (F.size("embedding") == (len(pivots[0]) if pivots else -1)) & (F.col("norm") > 0)
    return F.when(usable, F.array(*[distance(p) for p in pivots])) if pivots else F.lit(None).cast("array<double>")


def nearby(vectors: DataFrame, query_vec: list[float], k: int, pivots: list[list[float]]) -> DataFrame:
    """The vectors that can be among the k nearest: by the triangle inequality a vector is
    at least ``|d(query, pivot) - d(vector, pivot)|`` away, whichever the pivot.  The
    vectors of the least such bound are scored first; the k-th best of them is a distance
    that the bound of any other must not exceed.  All vectors, if fewer than k have a
    score."""
    q = np.asarray(query_vec, np.float64)
    if not pivots or len(q) != len(pivots[0]) or not np.linalg.norm(q):
        return vectors
    away = np.linalg.norm(np.array(pivots) - q / np.linalg.norm(q), axis=1)
    bound = F.greatest(F.lit(0.0), *[F.abs(F.get("pivot_distances", F.lit(i)) - F.lit(float(d))) for i, d in enumerate(away)])
    some = vectors.where("pivot_distances is not null").orderBy(bound, "doc_id").limit(8 * k)
    best = [r[0] for r in some.select(_score(query_vec, vectors).alias("s")).orderBy(F.desc_nulls_last("s")).limit(k).collect()]
    if len(best) < k or best[-1] is None:
        return vectors
    reach = float(np.sqrt(max(0.0, 2.0 - 2.0 * (best[-1] - 2e-6)))) + 1e-9      # scores are rounded to 6 decimals
    return vectors.where(bound <= reach)


def search_filtered(vectors: DataFrame, docs: DataFrame, query_vec: list[float], doc_type: str,
                    k: int = 4) -> DataFrame:
    """Metadata filter on the document side, then scoring and top-k."""
    kept = docs.filter(F.col("doc_type") == doc_type).select("doc_id", "doc_type", "category")
    j = vectors.join(kept, "doc_id")
    scored = j.select("doc_id", "doc_type", "category", _score(query_vec, vectors).alias("score"))
    return scored.orderBy(F.desc_nulls_last("score"), "doc_id").limit(k)


PARTIAL_SCHEMA = "label int, dim int, n long, s array<double>"


def _partial_sums(it):
    """Per-partition (label -> vector sum, count): pre-aggregation before
    the shuffle, so a label holding a third of all rows still leaves each
    task as one row."""
    acc: dict = {}
    for pdf in it:
        pdf = pdf[pdf["embedding"].notna()]
        for (label, dim), grp in pdf.groupby([pdf["label"], pdf["embedding"].map(len)], dropna=False):
            m = np.stack([np.asarray(v, dtype=np.float64) for v in grp["embedding"]])
            at = None if pd.isna(label) else int(label), int(dim)
            n0, s0 = acc.get(at, (0, 0.0))
            acc[at] = (n0 + len(grp), s0 + m.sum(axis=0))
    if acc:                                             # an empty column of lists has no type that Arrow converts
        yield pd.DataFrame({"label": pd.Series([k[0] for k in acc], dtype="Int32"), "dim": [k[1] for k in acc],
                            "n": [v[0] for v in acc.values()],
                            "s": [v[1].tolist() for v in acc.values()]})


def label_centroids(vectors: DataFrame) -> DataFrame:
    """Mean vector per label: one query per label (qid = label).  Of vectors of
    several dimensions those of the label's commonest count (of equals the largest).

    Partial vector sums per partition (NumPy), then the few partials per
    label are summed component-wise — no per-component row explosion of
    the full table."""
    ship_package(vectors.sparkSession)
    parts = vectors.select("label", "embedding").mapInPandas(_partial_sums, PARTIAL_SCHEMA)
    sizes = parts.groupBy("label", "dim").agg(F.sum("n").alias("n"))
    kept = sizes.groupBy("label").agg(F.max(F.struct("n", "dim"))["dim"].alias("_dim"))
    parts = parts.join(kept.withColumnRenamed("label", "_label"), F.col("label").eqNullSafe(F.col("_label"))).where("dim = _dim")
    comp = (parts.select("label", "n", F.posexplode("s").alias("pos", "x"))
            .groupBy("label", "pos").agg(F.sum("x").alias("sx"), F.sum("n").alias("n")))
    return (comp.groupBy("label")
            .agg(F.sort_array(F.collect_list(F.struct("pos", (F.col("sx") / F.col("n")).alias("m"))))
                 .alias("c"))
            .select(F.col("label").cast("long").alias("qid"),
                    F.transform("c", lambda s: s["m"]).alias("qvec")))


def _unit_rows(vecs) -> tuple[np.ndarray, np.ndarray]:
    m = np.stack([np.asarray(v, dtype=np.float64) for v in vecs]) if len(vecs) else \
        np.zeros((0, 0))
    n = np.linalg.norm(m, axis=1) if len(vecs) else np.zeros(0)
    return m, n


def _local_topk(doc_ids, dmat, dnorm, qids, qmat, qnorm, k):
    """Per-block candidates: for each query, every document whose raw score
    is within 1e-6 of the block's k-th best (a superset of anything that
    can rank in the top k after rounding to 6 decimals)."""
    if len(doc_ids) == 0 or len(qids) == 0:
        return pd.DataFrame({"qid": pd.Series([], dtype="int64"),
                             "doc_id": pd.Series([], dtype="int64"),
                             "raw": pd.Series([], dtype="float64")})
    with np.errstate(divide="ignore", invalid="ignore"):
        s = (dmat @ qmat.T) / np.outer(dnorm, qnorm)
    s = np.where(np.isfinite(s), s, -np.inf)
    kk = min(k, s.shape[0])
    kth = -np.partition(-s, kk - 1, axis=0)[kk - 1]      # k-th best per query
    rows, cols = np.nonzero(s >= (kth - 1e-6)[None, :])
    keep = np.isfinite(s[rows, cols])
    rows, cols = rows[keep], cols[keep]
    return pd.DataFrame({"qid": np.asarray(qids, dtype=np.int64)[cols],
                         "doc_id": np.asarray(doc_ids, dtype=np.int64)[rows],
                         "raw": s[rows, cols]})


CAND_SCHEMA = "qid long, doc_id long, raw double"


def vector_topk_batch(spark: SparkSession, vectors: DataFrame, queries: DataFrame,
                      k: int = 5) -> DataFrame:
    """H3: top-k documents for every query of a batch.

    The queries are written once and taken in blocks; each block is shipped to
    the tasks, which score it against their own documents (never shuffled) with
    NumPy and emit only candidates, so no (query, document) pair table is
    materialised.  SCAN_BLOCKS blocks share one scan of the documents; a larger batch
    takes more scans of the same kind.  Null
    vectors, and vectors of another dimension than the query's, score nothing."""
    ship_package(spark)
    path = scratch_path(spark, "topk-queries")
    numbered = sequential_ids(queries.filter(F.col("qvec").isNotNull()).select("qid", "qvec"), ["qid"], "_no")
    blocked = numbered.withColumn("_block", F.floor((F.col("_no") - 1) / QUERY_BLOCK))
    blocked.write.partitionBy("_block").parquet(path)
    written = spark.read.schema(blocked.schema).parquet(path)
    n_blocks = (written.agg(F.max("_block")).first()[0] or 0) + 1
    docs = vectors.filter(F.col("embedding").isNotNull()).select("doc_id", "embedding")
    def shipped(block: int):
        qp = written.filter(F.col("_block") == block).toPandas()  # at most QUERY_BLOCK rows
        by_size = qp.groupby(qp["qvec"].map(len))
        return spark.sparkContext.broadcast([(some["qid"].to_numpy(dtype=np.int64), *_unit_rows(list(some["qvec"])))
                                             for _, some in by_size])

    cand = None
    for first in range(0, n_blocks, SCAN_BLOCKS):
        blocks = [shipped(b) for b in range(first, min(first + SCAN_BLOCKS, n_blocks))]

        def per_batch(it, blocks=blocks):
            for pdf in it:
                for dim, same in pdf.groupby(pdf["embedding"].map(len)):
                    for lo in range(0, len(same), DOC_BLOCK):
                        some = same.iloc[lo:lo + DOC_BLOCK]
                        dm, dn = _unit_rows(list(some["embedding"]))
                        for block in blocks:
                            for qi, qm, qn in block.value:
                                if qm.shape[1] == dim:
                                    yield _local_topk(some["doc_id"].to_numpy(), dm, dn, qi, qm, qn, k)

        found = docs.mapInPandas(per_batch, CAND_SCHEMA)
        cand = found if cand is None else cand.unionByName(found)
    # Candidates per query are at most (k + ties) per block.
    ranked = cand.select("qid", "doc_id", C.rounded("raw", SCORE_DECIMALS).alias("score"))
    w = Window.partitionBy("qid").orderBy(F.desc("score"), "doc_id")
    return (ranked.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("qid", "rank", "doc_id", "score"))
