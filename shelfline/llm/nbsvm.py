"""Quality classifier: naive Bayes support vectors.

Documents are indicators of n-grams: of words, and of word shapes (runs of
upper case, lower case, digits, each sign) with marks for a repeated word and
for a share of the text (an n-gram that fills a quarter of a text is another
feature than a rare one).  An indicator is scaled by its class log-count ratio
``log((p/|p|) / (q/|q|))``; a linear hinge-loss model is fitted to the scaled
rows by dual coordinate descent.  Margins of three cross-fitted models calibrate
the score to a probability.

Training takes at most MAX_TRAIN labelled rows outside the held-out fold, as
hashed features (not texts), on the driver; scoring runs in tasks with the
weights (a fixed 2^BITS table) broadcast.  Inputs of a score are the words of
the text alone.

Defined cases: null and empty texts have no features and score the calibrated
intercept; without any training row, or with one class only, every score is that
class's smoothed share; an empty table gives an empty result; repeated rows score
alike; extra columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import documents, held_out, labels, prepare_python
from shelfline.llm.learning import labelled_sample, logistic, sigmoid

MAX_TRAIN = 6000
BITS = 20
MIN_DOCUMENTS = 4
SMOOTH = 1.0
C = 0.5
EPOCHS = 15
FOLDS = 3
THRESHOLD = 0.3
#: Shares of a text's n-grams from which an n-gram is marked.
SHARES = (1 / 64, 1 / 16, 1 / 4)
CACHE_WORDS = 500_000

_RUN = re.compile(r"(.)\1+", re.DOTALL)


class _Marks(dict):
    """Upper case A, other letters a, digits 0, any other sign itself."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        found = self[code] = "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c
        return found


_MARKS = _Marks()


def shape(word: str) -> str:
    return _RUN.sub(r"\1", word.translate(_MARKS))[:8]


class WordFeatures(dict):
    """Hash of the lower-cased word (high half) and of its shape (low half)."""

    def __missing__(self, word: str) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        found = self[word] = (zlib.crc32(word.lower().encode("utf-8", "surrogatepass")) << 32
                              | zlib.crc32(shape(word).encode("utf-8", "surrogatepass")))
        return found


_WORDS = WordFeatures()
_M = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x + np.uint64(salt)) * _M
        x ^= x >> np.uint64(29)
        x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x >> np.uint64(64 - BITS)


def features(text: str | None) -> np.ndarray:
    """Sorted distinct feature ids of a text."""
    words = (text or "").split()
    n = len(words)
    if not n:
        return np.empty(0, np.int32)
    both = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, n)
    word, kind = both >> np.uint64(32), both & np.uint64(0xFFFFFFFF)
    distinct, first = np.unique(word, return_index=True)
    found = [_mix(distinct, 1)]
    again = np.ones(n, np.uint64)
    again[first] = 0                                    # the word came before in this text
    same = np.r_[False, word[1:] == word[:-1]].astype(np.uint64)
    token = _mix(kind * np.uint64(4) + same * np.uint64(2) + again * same, 2)
    for size in (1, 2, 3):
        if n < size:
            break
        gram = token[:n - size + 1].copy()
        for k in range(1, size):
            gram = gram * np.uint64(1 << BITS) + token[k:n - size + 1 + k]
        ids, counts = np.unique(gram, return_counts=True)
        found.append(_mix(ids, 10 * size))
        for j, share in enumerate(SHARES):
            found.append(_mix(ids[counts >= share * n], 10 * size + 1 + j))
    if n >= 5:
        five = word[:n - 4].copy()
        for k in range(1, 5):
            with np.errstate(over="ignore"):
                five = five * _M + word[k:n - 4 + k]
        five.sort()
        fresh = (1 + np.count_nonzero(five[1:] != five[:-1])) / len(five)
        found.append(_mix(np.flatnonzero(fresh < np.array([0.95, 0.8, 0.5])).astype(np.uint64), 50))
    found.append(_mix(np.arange(min(int(np.log2(n)), 12) + 1, dtype=np.uint64), 60))
    return np.unique(np.concatenate(found)).astype(np.int32)


# ---- training


def log_count_ratio(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """The ratio of each feature; 0 for one seen in few rows."""
    size = 1 << BITS
    p, q = (np.bincount(np.concatenate([r for r, t in zip(rows, y) if t == c] or [np.empty(0, np.int32)]),
                        minlength=size).astype(float) for c in (1, 0))
    ratio = np.log((p + SMOOTH) / (p + SMOOTH).sum()) - np.log((q + SMOOTH) / (q + SMOOTH).sum())
    ratio[p + q < MIN_DOCUMENTS] = 0
    return ratio


def dual_coordinate_descent(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, size: int,
                            c: np.ndarray, epochs: int, seed: int = 7) -> tuple[np.ndarray, float]:
    """Weights and bias of the L1-loss support vector machine; ``c`` bounds the
    dual variable of each row."""
    w, bias = np.zeros(size), 0.0
    alpha = np.zeros(len(rows))
    sign = np.where(y == 1, 1.0, -1.0)
    norm = np.array([v @ v + 1.0 for v in values])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        most = 0.0
        for i in rng.permutation(len(rows)):
            idx, val = rows[i], values[i]
            g = sign[i] * (w[idx] @ val + bias) - 1.0
            new = min(max(alpha[i] - g / norm[i], 0.0), c[i])
            step = (new - alpha[i]) * sign[i]
            if step:
                alpha[i] = new
                w[idx] += step * val
                bias += step
                most = max(most, abs(step))
        if most < 1e-3:
            break
    return w, bias


def _fit(rows: list[np.ndarray], y: np.ndarray) -> tuple[np.ndarray, float]:
    """Folded weights: ratio times support vector weights, and the bias."""
    ratio = log_count_ratio(rows, y)
    kept = [r[ratio[r] != 0] for r in rows]
    values = []
    for r in kept:
        v = ratio[r]
        values.append(v / max(np.sqrt(v @ v), 1e-9))
    share = np.array([max((y == c).mean(), 1e-9) for c in (0, 1)])
    c = C * 0.5 / share[y]                              # both classes weigh the same
    w, bias = dual_coordinate_descent(kept, values, y, 1 << BITS, c, EPOCHS)
    return np.column_stack([ratio, w]), bias


def margin(ids: np.ndarray, model: np.ndarray, bias: float) -> float:
    r = model[ids, 0]
    return float(r @ model[ids, 1] / max(np.sqrt(r @ r), 1e-9) + bias)


class Model:
    """Weights by feature (ratio, support vector weight), bias and calibration."""

    def __init__(self, weights, bias, slope, intercept):
        self.weights, self.bias, self.slope, self.intercept = weights, bias, slope, intercept

    def score(self, text: str | None) -> float:
        return float(sigmoid(self.slope * margin(features(text), self.weights, self.bias) + self.intercept))


def train(rows: list[np.ndarray], y: np.ndarray) -> Model:
    y = np.asarray(y, int)
    if len(set(y.tolist())) < 2:
        share = (y.sum() + 1.0) / (len(y) + 2.0)
        return Model(np.zeros((1 << BITS, 2), np.float32), 0.0, 0.0, float(np.log(share / (1 - share))))
    margins, fold = np.zeros(len(y)), np.arange(len(y)) % FOLDS
    for k in range(FOLDS):
        inside = np.flatnonzero(fold != k)
        if len(set(y[inside].tolist())) < 2:
            continue
        weights, bias = _fit([rows[i] for i in inside], y[inside])
        for i in np.flatnonzero(fold == k):
            margins[i] = margin(rows[i], weights, bias)
    slope, intercept = logistic(margins[:, None], y)
    weights, bias = _fit(rows, y)
    return Model(weights.astype(np.float32), bias, max(slope, 0.0), intercept)


def train_on(docs: DataFrame, labelled: DataFrame, target: str = "quality", most: int = MAX_TRAIN) -> Model:
    prepare_python(docs.sparkSession)
    sample = labelled_sample(docs, labelled, target, most)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([features(t) for t in texts], dtype=object)
    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    # at most ``most`` rows of hashed features
    got = sample.select("doc_id", "y", F.pandas_udf(run, "array<int>")(F.col("text")).alias("f")).toPandas()
    got = got.sort_values("doc_id", kind="stable")
    return train([np.asarray(f, np.int32) for f in got["f"]], got["y"].to_numpy(int))


def quality_scores(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    spark = docs.sparkSession
    prepare_python(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = shared.value
        for texts in batches:
            yield pd.Series([m.score(t) for t in texts], dtype=float)
    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                         F.pandas_udf(run, "double")(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op2_nbsvm(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return quality_scores(docs, train_on(docs, labels(spark, sf_dir)))
