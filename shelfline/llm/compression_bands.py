"""Quality rules with compression bands.

Every whole text is compressed with zstandard, as a whole and in fixed chunks.
Repetitive text compresses too well, random text hardly at all; the limits
depend on the length because short texts never compress well.  A document is
kept if it passes the base rules and every ratio lies within its band.

Defined cases: a null text has no words, fails the base rules and is not kept;
an empty table gives an empty result; repeated rows are judged each on their
own; other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import documents, prepare_python, words_of

LEVEL = 3
CHUNK = 4096
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"

#: (bytes from, least ratio, largest ratio); ratio: compressed / raw.
#: Below the first length compression says nothing, so any ratio passes.
BANDS = ((0, 0.0, 9.0), (200, 0.35, 0.95), (1000, 0.32, 0.70), (4096, 0.30, 0.62),
         (32768, 0.25, 0.60))
#: The same for chunks of ``CHUNK`` bytes (the last, shorter one is judged by
#: its own length in BANDS).
CHUNK_BAND = (0.28, 0.65)

SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, "
          "n_repeat_words long, base_failed boolean, ratio double, chunk_low double, "
          "chunk_high double, kept boolean")


def band(n_bytes: int) -> tuple[float, float]:
    low, high = BANDS[0][1:]
    for least, a, b in BANDS:
        if n_bytes >= least:
            low, high = a, b
    return low, high


def repeated_words(words: list) -> int:
    """Words covered by windows of five words found twice or more.  Windows
    are compared exactly: ids of words, ranks of pairs, of fours, of fives."""
    n = len(words)
    if n <= WINDOW:
        return 0
    seen: dict = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    v = len(seen) + 1
    two = np.unique(ids[:-1] * v + ids[1:], return_inverse=True)[1].astype(np.int64)
    four = np.unique(two[:-2] * n + two[2:], return_inverse=True)[1].astype(np.int64)
    five = four[:-1] * v + ids[4:]
    _, inverse, counts = np.unique(five, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[inverse] > 1)
    if not len(starts):
        return 0
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + WINDOW, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def duplicate_lines(text: str) -> int:
    seen: set = set()
    dup = 0
    for line in text.split("\n"):
        if line.strip(SPACES):
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    return dup


def ratios(data: bytes, compressor) -> tuple[float, float, float, bool]:
    """Whole ratio, least and largest chunk ratio, and whether all pass."""
    n = len(data)
    if not n:
        return 0.0, 0.0, 0.0, True
    whole = len(compressor.compress(data)) / n
    low, high = band(n)
    ok = low <= whole <= high
    least = most = whole
    if n > CHUNK:
        parts = [data[i:i + CHUNK] for i in range(0, n, CHUNK)]
        each = [len(compressor.compress(p)) / len(p) for p in parts]
        least, most = min(each), max(each)
        for p, r in zip(parts, each):
            a, b = CHUNK_BAND if len(p) == CHUNK else band(len(p))
            ok = ok and a <= r <= b
    return whole, least, most, ok


def judge(text: str | None, compressor) -> tuple:
    text = text or ""
    words = words_of(text)
    n = len(words)
    chars = len(text) - sum(text.count(c) for c in SPACES)
    symbols = sum(text.count(c) for c in SYMBOLS)
    repeat = repeated_words(words)
    failed = n < MIN_WORDS or 100 * repeat > MAX_REPEAT_PERCENT * n
    whole, least, most, ok = ratios(text.encode("utf-8", "surrogatepass"), compressor)
    return (n, chars, symbols, duplicate_lines(text), repeat, failed, whole, least, most,
            ok and not failed)


def _judge_column():
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import zstandard
        compressor = zstandard.ZstdCompressor(level=LEVEL)
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        for texts in batches:
            yield pd.DataFrame([judge(t, compressor) for t in texts], columns=names)
    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(run, SCHEMA)


def compression_bands(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of each row with its counts, ratios and verdict."""
    prepare_python(df.sparkSession)
    return (df.select(*[F.col(c) for c in keep], _judge_column()(F.col(text)).alias("_judged"))
            .select(*keep, "_judged.*"))


def op7_compression_bands(spark, sf_dir):
    return compression_bands(documents(spark, sf_dir))
