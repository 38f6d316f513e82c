"""Packing documents into fixed-length sequences by cutting-stock column
generation.

1. Tokens.  Each document is its token ids and the end id.  Whole sequences
   are cut off the front; the rest is cut once more, down to the next smaller
   standard length, so that every piece has a standard length (1/16 of the
   rest at most is cut off, itself in standard lengths).  The length histogram
   thus has a fixed number of classes at any corpus size.
2. Patterns.  The driver solves the cutting-stock linear program over the
   histogram (a bounded table): minimise the number of sequences so that every
   class is used up.  Columns are patterns (how many pieces of each class lie in
   one sequence); a knapsack dynamic program over the dual prices makes new
   ones until none pays.  The solution is rounded down; what remains is less
   than one sequence a pattern and is packed largest first.
3. Assignment.  Pieces of one class are ranked over all tasks (a count for each
   task and class, summed); a piece's rank says which use of which pattern it
   fills.  This is a join with the bounded pattern table, without any group of
   rows being gathered.

Defined cases: a null text is empty; an empty text is the end id alone; an empty
table gives an empty result; repeated rows are packed each; a document longer
than a sequence takes whole sequences first; a clash of input columns cannot
arise as only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import gc
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfline.llm.common import Scratch, documents, prepare_python, release

LENGTH = 4096
END = 2
#: Standard lengths: all up to STEPS, then STEPS to each doubling.
STEPS = 16
#: The linear program stops when its value is within this share of the least
#: number of sequences that could hold all tokens.
GAP = 1e-3
MAX_COLUMNS = 4000
#: Bytes of text that are tokenised together; a word is encoded once for them.
SLICE_BYTES = 12 << 20
#: A table of pieces a task and class is broadcast up to this many rows.
BROADCAST_ROWS = 200_000
#: Signs that are a part of their own after a word.
MARKS = tuple(".,;:!?")

PIECE_SCHEMA = "doc_id long, start long, length long, doc_tokens long, cls int, part int, local long"


def standard_lengths(length: int = LENGTH, steps: int = STEPS) -> list[int]:
    found, n, step = [], 1, 1
    while n <= length:
        found.append(n)
        if n >= 2 * steps * step:
            step *= 2
        n += step
    return found if found[-1] == length else [*found, length]


def cuts(n: int, lengths: list[int]) -> list[int]:
    """Piece lengths of ``n`` tokens: whole sequences, then standard lengths."""
    top = lengths[-1]
    out = [top] * (n // top)
    n %= top
    while n:
        m = lengths[bisect_right(lengths, n) - 1]
        out.append(m)
        n -= m
    return out


# ---- tokens


class WordIds:
    """Ids of words.  The tokenizer drops white space before it encodes, so a
    text's ids are those of its words in turn.  A word of Latin letters has the ids
    of the parts that the tokenizer's own pattern cuts it into, any other word is
    encoded whole.  Nothing is remembered from one call to the next."""

    def __init__(self, path: str | None = None):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path or public_tokenizers.path("word_bpe_49k.json"))
        self.tokenizer.encode_special_tokens = True  # such strings in a text are text
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        import regex
        # fixed value: the vocabulary's split pattern, after lower-casing
        self.parts = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+").findall

    def cut(self, word: str) -> tuple[str, ...] | list[str]:
        low = word.lower()
        if low.isalpha():
            return (low,)
        if low[-1:] in MARKS and low[:-1].isalpha():
            return low[:-1], low[-1]
        return self.parts(low)

    def words(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words as little-endian bytes."""
        cut = {w: self.cut(w) for w in words if w.isascii() or (max(w) < "\u0250" and "\u0130" not in w)}
        parts = list({p for found in cut.values() for p in found})
        known = dict(zip(parts, self.ids_of(parts)))
        whole = [w for w in words if w not in cut]
        coded = self.tokenizer.encode_batch_fast(whole, add_special_tokens=False)
        other = {w: np.array(e.ids, "<u4").tobytes() for w, e in zip(whole, coded)}
        return [other[w] if w in other else known[cut[w][0]] if len(cut[w]) == 1 else
                b"".join([known[p] for p in cut[w]]) for w in words]

    def ids_of(self, parts: list[str]) -> list[bytes]:
        """Ids of single parts: all encoded in one text and cut at the ids that
        end a part."""
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(parts)], add_special_tokens=False)[0].ids, "<u4")
        data, ends = ids.tobytes(), [0, *(4 * (np.flatnonzero(self.ends_word[ids]) + 1)).tolist()]
        if len(ends) != len(parts) + 1:
            raise ValueError("the vocabulary does not end each part with an end-of-word id")
        return [data[i:j] for i, j in zip(ends, ends[1:])]

    def encode(self, text: str) -> bytes:
        ids, _ = self.encode_all(pa.array([text]))
        return ids.tobytes()

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and where each text's begin (with
        the end).  Words are told apart and put together again in Arrow and NumPy;
        Python meets each distinct word once."""
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = split.flatten().dictionary_encode()
        found = self.words(coded.dictionary.to_pylist())
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        starts, which = np.cumsum(sizes) - sizes, coded.indices.to_numpy()
        n = sizes[which]
        ends = np.cumsum(n)
        at = np.repeat(starts[which] - (ends - n), n) + np.arange(n.sum())
        return np.frombuffer(b"".join(found), "<u4")[at], np.r_[0, ends][split.offsets.to_numpy()]


_IDS: dict = {}


def word_ids(path: str | None) -> WordIds:
    if path not in _IDS:
        _IDS[path] = WordIds(path)
    return _IDS[path]


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows of SLICE_BYTES or less (a longer text is one range)."""
    sizes = pc.binary_length(texts).to_numpy()
    ends, lo = np.cumsum(sizes), 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + SLICE_BYTES, "right")))
        yield lo, hi
        lo = hi


def _pieces_fn(path: str | None, lengths: list[int], content, kind: pa.DataType):
    cls = {n: i for i, n in enumerate(lengths)}
    end = np.array([END], "<u4").tobytes()
    names = [*(c.split()[0] for c in PIECE_SCHEMA.split(", ")), "content"]
    kinds = [pa.int64()] * 4 + [pa.int32()] * 2 + [pa.int64(), kind]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, ids, used = TaskContext.get().partitionId(), word_ids(path), [0] * len(lengths)
        gc.disable()                                    # many words at once, and no cycles among them
        try:
            for batch in batches:
                doc_ids, texts = batch.column("doc_id"), pc.fill_null(batch.column("text"), "")
                for lo, hi in _slices(texts):
                    found, edges = ids.encode_all(texts.slice(lo, hi - lo))
                    rows = []
                    for doc_id, a, b in zip(doc_ids.slice(lo, hi - lo).to_pylist(), edges.tolist(), edges[1:].tolist()):
                        tokens, at = found[a:b].tobytes() + end, 0
                        for m in cuts(b - a + 1, lengths):
                            c = cls[m]
                            rows.append((doc_id, at, m, b - a + 1, c, part, used[c], content(tokens[4 * at:4 * (at + m)])))
                            used[c] += 1
                            at += m
                    yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], names)
        finally:
            gc.enable()
            release()
    return run


def pieces(docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH, checksums: bool = False) -> DataFrame:
    """Pieces of all documents, with the task that made a piece and the piece's
    place among those of its class there; with their ``tokens`` (little-endian 32-bit
    ids) or those tokens' ``ids_crc32`` alone.  Write it before reading it twice."""
    prepare_python(docs.sparkSession)
    made = _pieces_fn(tokenizer, standard_lengths(length), *((zlib.crc32, pa.int64()) if checksums else (bytes, pa.binary())))
    schema = f"{PIECE_SCHEMA}, content {'long' if checksums else 'binary'}"
    return (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(made, schema)
            .withColumnRenamed("content", "ids_crc32" if checksums else "tokens"))


# ---- patterns


def knapsack(values: np.ndarray, lengths: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """Best pattern at these prices: unbounded knapsack, one class after
    another; within a class ``f[c] = max(f[c], f[c - l] + v)`` is a running
    maximum along steps of ``l``."""
    f = np.zeros(room + 1)
    stages = []
    # a class that costs more room for no more value never helps
    by_size = np.argsort(lengths, kind="stable")
    before = np.concatenate([[0.0], np.maximum.accumulate(values[by_size])[:-1]])
    order = [int(i) for i, b in zip(by_size, before) if values[i] > b + 1e-12]
    for i in order:
        size, v = int(lengths[i]), values[i]
        stages.append(f)
        k = -(-(room + 1) // size)
        padded = np.full(k * size, -np.inf)
        padded[:room + 1] = f
        gain = np.arange(k)[:, None] * v
        grid = np.maximum.accumulate(padded.reshape(k, size) - gain, axis=0) + gain
        f = grid.reshape(-1)[:room + 1]
    pattern = np.zeros(len(lengths), np.int64)
    c = int(np.argmax(f))
    best = float(f[c])
    for i, before in zip(reversed(order), reversed(stages)):
        size, v = int(lengths[i]), values[i]
        while c >= size and f[c] > before[c] + 1e-13:
            pattern[i] += 1
            c -= size
        f = before
    return best, pattern


def column_generation(lengths: np.ndarray, demand: np.ndarray, room: int,
                      gap: float = GAP, most: int = MAX_COLUMNS) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (rows) and how often each is used, for the linear program
    ``min sum x, sum x_p pattern_p = demand, x >= 0``: revised simplex, each
    entering column priced by the knapsack."""
    m = len(lengths)
    per = room // lengths
    basis = np.diag(per).astype(float)          # columns are patterns
    inverse = np.diag(1.0 / per)
    x = demand / per
    least = float((lengths * demand).sum()) / room
    for step in range(most):
        if x.sum() <= least * (1 + gap):
            break
        prices = inverse.sum(axis=0)
        value, pattern = knapsack(prices, lengths, room)
        if value <= 1 + 1e-7:
            break
        d = inverse @ pattern
        rising = d > 1e-9
        if not rising.any():
            break
        ratio = np.full(m, np.inf)
        ratio[rising] = x[rising] / d[rising]
        out = int(np.argmin(ratio))
        theta = ratio[out]
        x = x - theta * d
        x[out] = theta
        x[x < 0] = 0
        basis[:, out] = pattern
        if step % 200 == 199:
            inverse = np.linalg.inv(basis)
        else:
            inverse[out] /= d[out]
            other = np.arange(m) != out
            inverse[other] -= np.outer(d[other], inverse[out])
    return basis.T.round().astype(np.int64), x


def plan(histogram: dict[int, int], lengths: list[int], room: int = LENGTH) -> list[tuple[int, dict[int, int]]]:
    """(uses, {class: pieces}) of each pattern: the rounded-down solution, then
    single sequences for what remains.  ``histogram``: class -> pieces."""
    left = {c: n for c, n in histogram.items() if n}
    full = len(lengths) - 1
    out = [(left.pop(full), {full: 1})] if full in left else []
    if left:
        classes = sorted(left)
        size = np.array([lengths[c] for c in classes])
        patterns, x = column_generation(size, np.array([left[c] for c in classes], float), room)
        for pattern, uses in zip(patterns, x):
            uses = int(uses + 1e-6)
            used = {classes[i]: int(pattern[i]) for i in np.flatnonzero(pattern)}
            uses = min([uses, *(left[c] // k for c, k in used.items())])
            if uses > 0:
                out.append((uses, used))
                for c, k in used.items():
                    left[c] -= uses * k
    # what remains: largest first, each sequence filled greedily from the large classes
    while any(left.values()):
        space, used = room, {}
        for c in sorted((c for c, n in left.items() if n), reverse=True):
            k = min(left[c], space // lengths[c])
            if k:
                used[c] = k
                space -= k * lengths[c]
        uses = min(left[c] // k for c, k in used.items())
        out.append((uses, used))
        for c, k in used.items():
            left[c] -= uses * k
    return out


def slots(planned: list[tuple[int, dict[int, int]]], lengths: list[int]) -> list[tuple]:
    """The plan as ranges of ranks: (class, first rank, ranks, pieces a sequence,
    first sequence, offset of the first piece in its sequence)."""
    rank: dict[int, int] = {}
    sequence, rows = 0, []
    for uses, used in planned:
        at = 0
        for c in sorted(used, reverse=True):
            k = used[c]
            rows.append((c, rank.get(c, 0), uses * k, k, sequence, at))
            rank[c] = rank.get(c, 0) + uses * k
            at += k * lengths[c]
        sequence += uses
    return rows


# ---- assignment


def place(cut: DataFrame, length: int = LENGTH) -> DataFrame:
    """``sequence_id`` and ``offset`` for every row of a written table of pieces
    (any of its columns may be left out but cls, part, local, length)."""
    spark = cut.sparkSession
    lengths = standard_lengths(length)
    counts = cut.groupBy("cls", "part").agg(F.count(F.lit(1)).alias("_n"))
    scratch = Scratch(spark, "cutting-stock")
    counts = scratch.write(counts, "counts")
    # at most one row for each standard length
    histogram = {r["cls"]: r["n"] for r in counts.groupBy("cls").agg(F.sum("_n").alias("n")).collect()}
    rows = slots(plan(histogram, lengths, length), lengths)
    table = spark.createDataFrame(
        rows, "_cls int, _first long, _ranks long, _each long, _sequence long, _at long")
    # patterns and their classes: bounded by the number of standard lengths
    ranges = (table.groupBy("_cls").agg(F.array_sort(F.collect_list(
        F.struct("_first", "_ranks", "_each", "_sequence", "_at"))).alias("_ranges")))
    before = Window.partitionBy("cls").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("cls").alias("_c"), F.col("part").alias("_p"),
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    offsets = offsets.join(F.broadcast(ranges), F.col("_c") == F.col("_cls")).drop("_cls")
    # the range of ranks that a task's pieces of a class meet: usually one
    offsets = offsets.select("_c", "_p", "_before", F.explode("_ranges").alias("_r"))
    per_part = counts.select(F.col("cls").alias("_c2"), F.col("part").alias("_p2"), "_n")
    offsets = (offsets.join(per_part, (F.col("_c") == F.col("_c2")) & (F.col("_p") == F.col("_p2")))
               .where("_r._first < _before + _n and _r._first + _r._ranks > _before")
               .select("_c", "_p", "_before", "_r.*"))
    offsets = scratch.write(offsets, "offsets")
    if offsets.count() <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    rank = F.col("_before") + F.col("local")
    inside = rank - F.col("_first")
    return (cut.join(offsets, (F.col("cls") == F.col("_c")) & (F.col("part") == F.col("_p"))
                     & (rank >= F.col("_first")) & (rank < F.col("_first") + F.col("_ranks")))
            .withColumn("sequence_id", F.expr("_sequence + (_before + local - _first) div _each"))
            .withColumn("offset", F.col("_at") + F.pmod(inside, F.col("_each")) * F.col("length"))
            .drop("_c", "_p", "_before", "_first", "_ranks", "_each", "_sequence", "_at"))


def cut_documents(docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH,
                  checksums: bool = False) -> DataFrame:
    """The written table of pieces."""
    scratch = Scratch(docs.sparkSession, "pieces")
    return scratch.write(pieces(docs, tokenizer, length, checksums), "pieces")


def pack(docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH) -> DataFrame:
    """Pieces with their tokens (little-endian 32-bit ids) and places."""
    return place(cut_documents(docs, tokenizer, length), length).drop("cls", "part", "local")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences: id, tokens in order (a group holds one sequence),
    number of tokens."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "tokens")))
    return (packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("_parts"))
            .select("sequence_id", "n_tokens",
                    F.expr("aggregate(_parts, cast('' as binary), (a, p) -> concat(a, p.tokens))").alias("tokens")))


def placements(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """The digest rows of ``pack``: ids as a checksum, taken where they are made."""
    cut = cut_documents(docs, tokenizer, checksums=True)
    return place(cut).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op1_cutting_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    return placements(documents(spark, sf_dir))
