"""Secret scans by a token-efficiency test.

Base rules find assignments, access keys and hex runs by pattern.  On top, any
long run of key characters is encoded with a tiktoken vocabulary: text that
people write costs few tokens for its characters, a random string many.  A run
with few characters per token is reported as ``random`` unless it is a known
digest (hex of a digest's length, a UUID, a git-style ``sha256:`` value) or an
identifier (words joined by case, ``_``, ``-`` or ``.``; a plain number).  Words
would dilute a random string in the same run, so of a run that passes as a whole
the pieces between separators are tested too, and then sliding windows of what is
left between words.

Spans count code points, end exclusive.  Base spans always stay; of a run that
meets a base span, what lies outside is tested on its own.

Defined cases: a null text is an empty one; texts without finds give counts 0,
an empty ``spans`` and the digest of the empty string; an empty table gives an
empty result; repeated rows are scanned each on their own; other columns are
not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import documents, prepare_python

KINDS = ("assign", "access", "hex", "random")

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: A maximal run of 16 or more is what the rule ``[0-9a-f]+`` keeps.
HEX = re.compile(r"[0-9a-f]{16,}")
MIN_VALUE, MIN_ACCESS = 12, 18

#: Runs the token test looks at, and the most characters per token of a random
#: one.  Prose has 3 to 5 characters a token, random base64 under 2.
MIN_RUN = 16
RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_RUN)
MAX_CHARS_PER_TOKEN = 2.0
DIGEST_LENGTHS = frozenset({32, 40, 48, 56, 64, 96, 128})
_HEX = re.compile(r"[0-9a-f]+|[0-9A-F]+")
_UUID = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
#: One word of an identifier: letters with a vowel, or a short number.
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
_WORD = re.compile(r"[A-Za-z]*[aeiouyAEIOUY][A-Za-z]*|[0-9]{1,4}")
#: Letters that no word has: five consonants in succession, or too many.
_NO_WORD = re.compile(r"[b-df-hj-np-tv-xzB-DF-HJ-NP-TV-XZ]{5}|[A-Za-z]{20}")
_PIECE = re.compile(r"[^/_=-]+")
_UUID_INSIDE = re.compile(rf"(?<![0-9A-Za-z]){_UUID.pattern}(?![0-9A-Za-z])")
#: Characters of a sliding window over a longer run.
WINDOW = 20
#: A sliding window has at most so many separators and at least so many letters
#: (dates and version numbers have few characters a token, too); a piece of so
#: many characters that is known parts what windows slide over.
MAX_SEPARATORS, MIN_LETTERS, MIN_KNOWN_PIECE = 2, 4, 5
#: For windows of letters of one case: rare compounds come near 2 in places.
MAX_ONE_CASE = 1.6

SCHEMA = ("n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, "
          "spans string, found array<struct<kind:string,start:int,end:int>>")


def known(run: str) -> bool:
    """Digests and identifiers."""
    if _HEX.fullmatch(run) and len(run) in DIGEST_LENGTHS or _UUID.fullmatch(run):
        return True
    body = run.strip("=_-/+")
    if not body or body.isdigit() or len(set(body)) <= 4:
        return True
    if not any(c.isalpha() for c in body):
        return True  # digits and signs only
    if sum(ord(d) - ord(c) == 1 for c, d in zip(body, body[1:])) * 5 >= len(body) * 4:
        return True  # an alphabet
    if "+" in body or "=" in run:
        return False
    parts = [p for x in re.split(r"[_/-]", body) for p in _PART.findall(x)]
    return (all(_WORD.fullmatch(p) and not _NO_WORD.search(p) for p in parts) and len(body) >= 4 * len(parts))


def base_spans(text: str) -> list[tuple[int, str, int]]:
    found = [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text)
             if m.end(2) - m.start(2) >= MIN_VALUE]
    found += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text)
              if m.end() - m.start() >= MIN_ACCESS]
    found += [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda f: (f[0], KINDS.index(f[1])))


class Gaps:
    """What spans leave free.  Spans are merged once; a question then costs what lies
    in its range, so a text with very many runs and spans takes linear time."""

    def __init__(self, spans: list[tuple[int, int]]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for x, y in sorted(spans):
            if self.ends and x <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], y)
            else:
                self.starts.append(x)
                self.ends.append(y)

    def within(self, a: int, b: int, least: int) -> Iterator[tuple[int, int]]:
        """The parts of a..b of at least ``least`` that no span meets."""
        i = bisect_right(self.ends, a)
        while a < b:
            x, y = (self.starts[i], self.ends[i]) if i < len(self.starts) else (b, b)
            if min(x, b) - a >= least:
                yield a, min(x, b)
            a, i = max(a, y), i + 1


def _dense(run: str, encode, most: float = MAX_CHARS_PER_TOKEN) -> bool:
    return len(run) <= most * len(encode(run)) and not known(run)


def _window(run: str, encode) -> bool:
    """Whether a run of at most WINDOW characters is random by itself.  Letters of one
    case are judged in WINDOW characters only: a shorter compound is too often dense."""
    one_case = not any(c.isdigit() for c in run) and (run[1:].islower() or run.isupper())
    if one_case and len(run) < WINDOW:
        return False
    return (sum(c in "/_=-" for c in run) <= MAX_SEPARATORS and sum(c.isalpha() for c in run) >= MIN_LETTERS
            and _dense(run, encode, MAX_ONE_CASE if one_case else MAX_CHARS_PER_TOKEN))


def _windows(run: str, encode) -> list[tuple[int, int]]:
    """Unions of the random windows of WINDOW characters."""
    out: list[tuple[int, int]] = []
    for a in range(len(run) - WINDOW + 1):
        if _window(run[a:a + WINDOW], encode):
            if out and a <= out[-1][1]:
                out[-1] = out[-1][0], a + WINDOW
            else:
                out.append((a, a + WINDOW))
    return out


def random_parts(run: str, encode) -> list[tuple[int, int]]:
    """The random spans of a run: the whole, else its pieces and windows."""
    if known(run):
        return []
    if (_window if len(run) < WINDOW else _dense)(run, encode):
        return [(0, len(run))]
    uuids = [m.span() for m in _UUID_INSIDE.finditer(run)]
    found, words = [], []
    for a, b in Gaps(uuids).within(0, len(run), MIN_RUN):
        for m in _PIECE.finditer(run, a, b):
            n = m.end() - m.start()
            if n >= MIN_RUN and (_window if n < WINDOW else _dense)(m.group(), encode):
                found.append(m.span())
            elif m.end() - m.start() >= MIN_KNOWN_PIECE and known(m.group()):
                words.append(m.span())
    for a, b in Gaps(uuids + found + words).within(0, len(run), WINDOW):
        found += [(a + x, a + y) for x, y in _windows(run[a:b], encode)]
    return sorted(found)


def random_spans(text: str, base: list, encode) -> list[tuple[int, str, int]]:
    out, gaps = [], Gaps([(s, e) for s, _, e in base])
    for m in RUN.finditer(text):
        for a, b in gaps.within(*m.span(), MIN_RUN):
            out += [(a + x, "random", a + y) for x, y in random_parts(text[a:b], encode)]
    return out


def joined(found: list) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, kind, b in found)


def scan(text: str | None, encode) -> tuple:
    text = text or ""
    base = base_spans(text)
    more = random_spans(text, base, encode)
    both = sorted(base + more, key=lambda f: (f[0], KINDS.index(f[1])))
    n = [sum(f[1] == k for f in both) for k in KINDS]
    return (*n, hashlib.sha256(joined(base).encode()).hexdigest(), joined(both),
            [{"kind": k, "start": a, "end": b} for a, k, b in both])


def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}


_ENCODERS: dict = {}


def encoder(vocabulary: str | None = None):
    """``encode_ordinary`` of a vocabulary file (by default that of the public
    tokenizers installed beside Python); one for each worker process."""
    if vocabulary not in _ENCODERS:
        import public_tokenizers
        import tiktoken
        path = vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken")
        _ENCODERS[vocabulary] = tiktoken.Encoding(
            "secrets", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks_of(path), special_tokens={})
    return _ENCODERS[vocabulary].encode_ordinary


def _scan_column(vocabulary: str | None):
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encode = encoder(vocabulary)
        for texts in batches:
            yield pd.DataFrame([scan(t, encode) for t in texts], columns=names)
    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(run, SCHEMA)


def scan_secrets(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
                 vocabulary: str | None = None) -> DataFrame:
    """``keep`` and the counts, digest and spans of each row's text."""
    prepare_python(df.sparkSession)
    return (df.select(*[F.col(c) for c in keep], _scan_column(vocabulary)(F.col(text)).alias("_scan"))
            .select(*keep, "_scan.*"))


def masked(text: str | None, encode) -> str | None:
    """The text with each secret replaced by ``<kind>``; overlapping spans are
    one.  Of an assignment only the value goes."""
    if not text:
        return text
    spans = []
    for m in ASSIGN.finditer(text):
        if m.end(2) - m.start(2) >= MIN_VALUE:
            spans.append((m.start(2), m.end(2), "assign"))
    base = base_spans(text)
    spans += [(a, b, k) for a, k, b in base if k != "assign"]
    spans += [(a, b, k) for a, k, b in random_spans(text, base, encode)]
    out, at = [], 0
    for a, b, k in sorted(spans):
        if a >= at:
            out += [text[at:a], f"<{k}>"]
        at = max(at, b)
    return "".join(out) + text[at:]


def mask_secrets(df: DataFrame, text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """All rows and columns, secrets in ``text`` masked."""
    prepare_python(df.sparkSession)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = encoder(vocabulary)
        for texts in batches:
            yield pd.Series([masked(t, encode) for t in texts], dtype=object)
    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return df.withColumn(text, F.pandas_udf(run, "string")(F.col(text)))


def op4_token_efficiency(spark, sf_dir):
    out = scan_secrets(documents(spark, sf_dir))
    return out.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random")
