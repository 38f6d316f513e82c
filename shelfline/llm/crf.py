"""Toxicity by a linear-chain conditional random field over tokens.

Labels mark documents, so tokens are labelled first: word forms and word
beginnings that occur almost only in toxic training documents are picked
greedily, each new one having to explain toxic documents that none before
explained; a token of a toxic document that carries a picked form is labelled
toxic.  The field has state features of a token (its form, beginnings and
shape) and transitions between toxic and clean; it is trained by AdaGrad on the
likelihood of the labelled token sequences (sentences).

Scoring runs forward-backward over every sentence of every text; a token's
marginal of the toxic state gives the offending offsets, and the largest
marginals of a text give its score through a small logistic model fitted on the
training documents.

Training takes at most MAX_TRAIN labelled rows outside the held-out fold, on
the driver; the fitted weights (a fixed 2^BITS table) are broadcast.  Inputs of a
score are the tokens of the text alone.

Defined cases: null and empty texts have no tokens and score the logistic
model's value for a clean text; without any training row, or with one class
only, every score is that class's smoothed share; an empty table gives an empty
result; repeated rows score alike; extra columns are kept by ``drop_toxic`` and
not read.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import documents, held_out, labels, prepare_python, release
from shelfline.llm.learning import labelled_sample, logistic, sigmoid

MAX_TRAIN = 3000
BITS = 18
#: A picked form occurs in so many toxic training documents that no form
#: before explained, and so large a share of its documents is toxic.
MIN_EXPLAINED = 4
MIN_PRECISION = 0.6
BEGINNINGS = (3, 4, 5, 6, 7, 8)
#: Sentences longer than this are cut for the chain (no token is left out).
MAX_CHAIN = 64
#: Clean sentences trained on for each toxic one.
CLEAN_PER_TOXIC = 5
EPOCHS, BATCH, RATE, L2 = 8, 256, 0.3, 1e-5
THRESHOLD = 0.5
#: Marginal from which a token's offsets are reported.
SPAN_MARGINAL = 0.5
CACHE_WORDS = 150_000

_TOKEN = re.compile(r"\S+")
_SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~¡¿«»“”‘’…–—"
_MASK = (1 << BITS) - 1


def core(token: str) -> str:
    return token.strip(_SIGNS).lower()


def forms(token: str) -> list[str]:
    """The form and the beginnings of a token."""
    c = core(token)
    return [f"w={c}"] + [f"b={c[:k]}" for k in BEGINNINGS if len(c) > k]


def state_features(token: str) -> list[int]:
    """Feature numbers: form, beginnings, ending, kind, bias."""
    c = core(token)
    found = [zlib.crc32(c.encode("utf-8", "surrogatepass"), 1) & _MASK]
    found += [zlib.crc32(c[:k].encode("utf-8", "surrogatepass"), 2) & _MASK for k in BEGINNINGS if len(c) > k]
    found.append(zlib.crc32(c[-3:].encode("utf-8", "surrogatepass"), 3) & _MASK)
    found.append(4 if c.isalpha() else 5)
    found.append(7 if len(token) > 1 and token.isupper() else 6)
    return found


def sentence_ends(tokens: list[str]) -> np.ndarray:
    """Positions after which a chain ends: at a full stop, or after MAX_CHAIN."""
    n = len(tokens)
    ends, last = [], -1
    for e in [*(i for i, t in enumerate(tokens) if t[-1] in ".!?"), n - 1]:
        while e - last > MAX_CHAIN:
            last += MAX_CHAIN
            ends.append(last)
        if e > last:
            ends.append(e)
            last = e
    return np.array(ends, np.int64)


# ---- labelling of tokens


def pick_forms(docs: list[list[str]], y: np.ndarray) -> set[str]:
    """Greedy cover of the toxic documents by forms that are rarely clean."""
    where: dict[str, list[int]] = defaultdict(list)
    clean: Counter = Counter()
    for i in np.flatnonzero(y).tolist():
        for f in {f for t in set(docs[i]) for f in forms(t)}:
            where[f].append(i)
    # only forms of enough toxic documents can be picked; the others of a clean
    # document's many tokens are not kept
    asked = {f: f for f, at in where.items() if len(at) >= MIN_EXPLAINED}
    memo: dict[str, tuple[str, ...]] = {}
    for i in np.flatnonzero(np.asarray(y) == 0).tolist():
        found = set()
        for t in set(docs[i]):
            if t not in memo:
                memo[t] = tuple(asked[f] for f in forms(t) if f in asked)
            found.update(memo[t])
        clean.update(found)
    share = max(float(np.mean(y)), 1e-9)
    good = {}
    for f, at in where.items():
        n = len(at)
        # clean documents are many more: weigh both classes by their counts as they are
        if n >= MIN_EXPLAINED and n / (n + clean[f]) >= max(MIN_PRECISION, share):
            good[f] = at
    picked: set[str] = set()
    open_ = set(np.flatnonzero(y).tolist())
    # a longer and purer form counts a little more, so a beginning is picked only
    # if it covers more documents than any one word with it
    pure = {f: (len(at) / (len(at) + clean[f])) ** 2 * (1 + 0.03 * len(f)) for f, at in good.items()}
    gain = {f: len(at) for f, at in good.items()}
    while gain:
        f = max(gain, key=lambda g: (gain[g] * pure[g], g))
        now = sum(i in open_ for i in good[f])
        if now < gain[f]:                                # gains are refreshed when they come first
            if now < MIN_EXPLAINED:
                del gain[f]
            else:
                gain[f] = now
            continue
        picked.add(f)
        del gain[f]
        open_.difference_update(good[f])
    return picked


def widen(picked: set[str], docs: list[list[str]], y: np.ndarray) -> set[str]:
    """All forms as rarely clean as the picked ones that occur in toxic documents
    beside them: the other words of the same lists."""
    toxic, clean = Counter(), Counter()
    for tokens, t in zip(docs, y):
        words = {core(x) for x in tokens}
        (toxic if t else clean).update(words)
    found = set(picked)
    for w, n in toxic.items():
        if w and n >= 3 * MIN_EXPLAINED and n / (n + clean[w]) >= 0.95:
            found.add(f"w={w}")
    return found


# ---- the field


def pad(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of equal length from a flat array: (index matrix, mask)."""
    width = int(lengths.max())
    at = np.arange(width)
    mask = at[None, :] < lengths[:, None]
    index = np.where(mask, starts[:, None] + at[None, :], 0)
    return index, mask


def forward_backward(emit: np.ndarray, mask: np.ndarray, trans: np.ndarray, pairs: bool = False):
    """Marginals of the toxic state (rows, time) and, if asked for, expected
    transitions.  ``emit`` is the toxic state's score, the clean one's is 0;
    ``trans[i, j]`` scores a step from i to j.  Messages are scaled to sum 1."""
    rows, width = emit.shape
    step = np.exp(trans - trans.max())
    odds = np.exp(np.clip(emit, -30, 30)).T.copy()       # (time, rows)
    live = mask.T
    clean, toxic = np.empty((width, rows)), np.empty((width, rows))
    a0, a1 = np.ones(rows), odds[0]
    for t in range(width):
        if t:
            n0, n1 = a0 * step[0, 0] + a1 * step[1, 0], (a0 * step[0, 1] + a1 * step[1, 1]) * odds[t]
            a0, a1 = np.where(live[t], n0, a0), np.where(live[t], n1, a1)
        total = a0 + a1
        a0, a1 = a0 / total, a1 / total
        clean[t], toxic[t] = a0, a1
    b0, b1 = np.ones(rows), np.ones(rows)
    marginal = np.empty((width, rows))
    expected = np.zeros((2, 2))
    for t in range(width - 1, -1, -1):
        m0, m1 = clean[t] * b0, toxic[t] * b1
        marginal[t] = m1 / (m0 + m1)
        if t:
            w1 = odds[t] * b1
            if pairs:
                p = [[clean[t - 1] * step[0, 0] * b0, clean[t - 1] * step[0, 1] * w1],
                     [toxic[t - 1] * step[1, 0] * b0, toxic[t - 1] * step[1, 1] * w1]]
                z = p[0][0] + p[0][1] + p[1][0] + p[1][1]
                for i in range(2):
                    for j in range(2):
                        expected[i, j] += (p[i][j] / z)[live[t]].sum()
            n0, n1 = step[0, 0] * b0 + step[0, 1] * w1, step[1, 0] * b0 + step[1, 1] * w1
            total = n0 + n1
            b0, b1 = np.where(live[t], n0 / total, 1.0), np.where(live[t], n1 / total, 1.0)
    return np.where(mask, marginal.T, 0.0), expected


def fit(sentences: list[np.ndarray], marks: list[np.ndarray], words: list[np.ndarray], seed: int = 5
        ) -> tuple[np.ndarray, np.ndarray]:
    """State weights and transitions.  Sentences hold word numbers; ``words``
    their state features."""
    width = max((len(w) for w in words), default=1)
    table = np.full((len(words), width), 1 << BITS, np.int32)        # the last weight stays 0
    for i, w in enumerate(words):
        table[i, :len(w)] = w
    theta = np.zeros((1 << BITS) + 1)
    trans = np.zeros((2, 2))
    g_theta, g_trans = np.full_like(theta, 1e-8), np.full_like(trans, 1e-8)
    rng = np.random.default_rng(seed)
    lengths = np.array([len(s) for s in sentences])
    flat = np.concatenate(sentences)
    gold = np.concatenate(marks).astype(float)
    starts = np.r_[0, np.cumsum(lengths)[:-1]]
    for _ in range(EPOCHS):
        # batches of like lengths, in random order
        order = np.argsort(lengths + 4 * rng.random(len(sentences)), kind="stable")
        for k in rng.permutation(-(-len(order) // BATCH)):
            rows = order[k * BATCH:(k + 1) * BATCH]
            index, mask = pad(flat, starts[rows], lengths[rows])
            ids, y = flat[index], gold[index] * mask
            marginal, pair = forward_backward(theta[table[ids]].sum(-1), mask, trans, pairs=True)
            diff = (marginal - y) * mask / len(rows)
            grad = np.bincount(table[ids[mask]].ravel(), np.repeat(diff[mask], width), minlength=len(theta))
            grad[-1] = 0
            grad += L2 * theta
            seen = np.zeros((2, 2))
            a, b, both = y[:, :-1].astype(int), y[:, 1:].astype(int), mask[:, 1:]
            np.add.at(seen, (a[both], b[both]), 1)
            gt = (pair - seen) / len(rows) + L2 * trans
            g_theta += grad ** 2
            g_trans += gt ** 2
            theta -= RATE * grad / np.sqrt(g_theta)
            trans -= RATE * gt / np.sqrt(g_trans)
            theta[-1] = 0
    return theta, trans


class Emissions(dict):
    """Toxic-state score of a token, remembered."""

    def __init__(self, theta: np.ndarray):
        super().__init__()
        self.theta = theta.tolist()

    def __missing__(self, token: str) -> float:
        if len(self) > CACHE_WORDS:
            self.clear()
        found = self[token] = sum([self.theta[i] for i in state_features(token)])
        return found


def marginals(texts_tokens: list[list[str]], emissions: Emissions, trans: np.ndarray) -> list[np.ndarray]:
    """Marginals of the toxic state of every token; the sentences of all texts
    are taken together, grouped by length."""
    sizes = np.array([len(t) for t in texts_tokens], np.int64)
    total = int(sizes.sum())
    if not total:
        return [np.empty(0) for _ in texts_tokens]
    flat = np.fromiter((emissions[t] for tokens in texts_tokens for t in tokens), float, total)
    base = np.r_[0, np.cumsum(sizes)]
    ends = np.concatenate([b + sentence_ends(t) for b, t in zip(base, texts_tokens) if t])
    starts = np.r_[0, ends[:-1] + 1]
    lengths = ends - starts + 1
    out = np.zeros(total)
    order = np.argsort(lengths, kind="stable")
    cuts = np.searchsorted(lengths[order], [1, 3, 5, 8, 12, 16, 24, 32, 48, MAX_CHAIN + 1])
    for a, b in zip(cuts, cuts[1:]):
        for lo in range(a, b, 4096):
            rows = order[lo:min(lo + 4096, b)]
            index, mask = pad(flat, starts[rows], lengths[rows])
            found, _ = forward_backward(np.where(mask, flat[index], 0.0), mask, trans)
            out[index[mask]] = found[mask]
    return [out[i:j] for i, j in zip(base, base[1:])]


def aggregates(found: np.ndarray) -> tuple[float, float, float]:
    """Of a text's marginals: log-odds of the two largest, log expected count."""
    if not len(found):
        return -8.0, -8.0, 0.0
    top = np.sort(found)[-2:] if len(found) > 1 else np.r_[0.0, found]
    odds = np.clip(np.log(np.clip(top, 1e-9, 1 - 1e-9) / (1 - np.clip(top, 1e-9, 1 - 1e-9))), -8, 8)
    return float(odds[1]), float(odds[0]), float(np.log1p(found.sum()))


class Model:
    def __init__(self, theta: np.ndarray, trans: np.ndarray, weights: np.ndarray):
        self.theta, self.trans, self.weights = theta, trans, weights
        self.emissions = None

    def __getstate__(self):
        return self.theta, self.trans, self.weights

    def __setstate__(self, state):
        self.theta, self.trans, self.weights = state
        self.emissions = None

    def of(self, texts: list[str | None]) -> list[tuple[float, np.ndarray]]:
        """(score, marginals) of each text."""
        if self.emissions is None:
            self.emissions = Emissions(self.theta)
        found = marginals([(t or "").split() for t in texts], self.emissions, self.trans)
        x = np.array([aggregates(f) for f in found]).reshape(-1, 3)
        return list(zip(sigmoid(x @ self.weights[:-1] + self.weights[-1]).tolist(), found))


def train(texts: list[str], y: np.ndarray, seed: int = 5) -> Model:
    y = np.asarray(y, int)
    share = (y.sum() + 0.5) / (len(y) + 2.0)            # without labels: not toxic
    flat = Model(np.zeros((1 << BITS) + 1), np.zeros((2, 2)), np.array([0, 0, 0, np.log(share / (1 - share))]))
    if len(set(y.tolist())) < 2:
        return flat
    docs = [[sys.intern(w) for w in t.split()] for t in texts]    # a word is held once
    picked = widen(pick_forms(docs, y), docs, y)
    if not picked:
        return flat
    number: dict[str, int] = {}
    words: list[np.ndarray] = []
    hit: list[bool] = []
    toxic_sentences, clean_sentences = [], []
    for tokens, toxic in zip(docs, y):
        if not tokens:
            continue
        for t in set(tokens):
            if t not in number:
                number[t] = len(words)
                words.append(np.array(state_features(t), np.int32))  # small: there are very many words
                hit.append(any(f in picked for f in forms(t)))
        ids = np.fromiter((number[t] for t in tokens), np.int64, len(tokens))
        marks = np.fromiter((hit[i] for i in ids), bool, len(ids)) & bool(toxic)
        ends = sentence_ends(tokens)
        for a, b in zip(np.r_[0, ends[:-1] + 1], ends + 1):
            (toxic_sentences if marks[a:b].any() else clean_sentences).append((ids[a:b], marks[a:b]))
    rng = np.random.default_rng(seed)
    most = min(len(clean_sentences), CLEAN_PER_TOXIC * max(len(toxic_sentences), 250))
    some = [clean_sentences[i] for i in rng.permutation(len(clean_sentences))[:most]]
    used = toxic_sentences + some
    theta, trans = fit([s for s, _ in used], [m for _, m in used], words, seed)
    model = Model(theta.astype(np.float32), trans, np.zeros(4))
    model.emissions = Emissions(model.theta)
    x = []
    for lo in range(0, len(docs), 256):
        x += [aggregates(f) for f in marginals(docs[lo:lo + 256], model.emissions, trans)]
    model.weights = logistic(np.array(x), y, ridge=0.1)
    model.emissions = None
    return model


def train_on(docs: DataFrame, labelled: DataFrame, target: str = "toxic", most: int = MAX_TRAIN) -> Model:
    # at most ``most`` labelled documents
    got = labelled_sample(docs, labelled, target, most).toPandas().sort_values("doc_id", kind="stable")
    got = got.drop_duplicates("text")
    model = train([t or "" for t in got["text"]], got["y"].to_numpy(int))
    del got
    release()
    return model


_SCHEMA = "score double, spans array<struct<start:int,end:int,marginal:double>>"


def spans_of(text: str | None, found: np.ndarray) -> list[dict]:
    """Offsets (code points, end exclusive) of the tokens in the toxic state."""
    hot = np.flatnonzero(found >= SPAN_MARGINAL)
    if not len(hot):
        return []
    want, out = set(hot.tolist()), []
    for i, m in enumerate(_TOKEN.finditer(text or "")):
        if i in want:
            out.append({"start": m.start(), "end": m.end(), "marginal": float(found[i])})
    return out


def toxicity(docs: DataFrame, model: Model, text: str = "text", column: str = "_crf_toxic") -> DataFrame:
    """All rows and columns with a struct (score, spans)."""
    spark = docs.sparkSession
    prepare_python(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for texts in batches:
            for lo in range(0, len(texts), 256):
                some = texts.iloc[lo:lo + 256].tolist()
                rows = [(s, spans_of(t, f)) for t, (s, f) in zip(some, m.of(some))]
                yield pd.DataFrame(rows, columns=["score", "spans"])
        release()
    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return docs.withColumn(column, F.pandas_udf(run, _SCHEMA)(F.col(text)))


def drop_toxic(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows scored below the threshold, all columns."""
    return toxicity(docs, model, text).where(F.col("_crf_toxic.score") < THRESHOLD).drop("_crf_toxic")


def op6_crf(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    scored = toxicity(docs, train_on(docs, labels(spark, sf_dir)))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("_crf_toxic.score").alias("score"),
                         (F.col("_crf_toxic.score") >= THRESHOLD).cast("int").alias("predicted"),
                         F.size("_crf_toxic.spans").alias("n_spans"),
                         F.array_join(F.transform("_crf_toxic.spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
                         .alias("spans"))
