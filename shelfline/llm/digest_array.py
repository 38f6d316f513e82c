"""URL filters by a sorted array of 64-bit digests.

The list holds rules: a host and a path prefix with an action.  Spark hashes
each rule's string (xxhash64), range-partitions the rules by digest and
writes each range as one slice: sorted digests, the full strings, their
actions.  The slices are shipped to the executors as files and memory-mapped
there.  A url's candidate strings (for each pair of a number of host labels and a
path length that occurs in the list, the host's last labels and the path's prefix)
are hashed and probed by vectorised binary search; a digest that matches counts only if the stored
string is equal, so collisions decide nothing.  Of the rules that fit, the least
``rank`` wins (an optional column, 0 if absent), then the longest.

Memory-mapping keeps the resident size small however long the list is; no
slice and no list passes through the driver.

Defined cases: a null url, or one without ``://``, has empty host and path and
fits no rule; rules with a null or empty host or a null action are dropped, a
null path is the empty prefix; of equal rules the least (rank, action) counts; an empty
list or an empty table of urls is fine; repeated urls are judged each on their own; urls
of any length are judged whole; other columns are not read.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm.common import Scratch, prepare_python
from shelfline.sources.tables import table_path

#: Rules a slice holds (about 100 MB of strings).
SLICE_RULES = 1_000_000
#: Spark's xxhash64 seed.
SEED = 42
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_SLICE_SCHEMA = ("n long, digests binary, ends binary, strings binary, action_ends binary, "
                 "actions binary, shapes array<struct<labels:int,path:int>>")


def url_parts(url):
    """Host (A-Z lower-cased) and path of a url column: the host lies after the
    first ``://`` up to ``/ ? #``; the path from there up to ``?`` or ``#``."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(_url, instr(_url, '://') + 3)"))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def _pack(parts: list[bytes]) -> tuple[bytes, bytes]:
    return np.cumsum([len(p) for p in parts], dtype=np.int64).tobytes(), b"".join(parts)


def _slice(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One partition (a digest range, sorted) as one row of raw buffers."""
    held = [b for b in batches if len(b)]
    if not held:
        return
    rows = pd.concat(held)
    ends, strings = _pack([k.encode() for k in rows["key"]])
    action_ends, actions = _pack([a.encode() for a in rows["action"]])
    yield pd.DataFrame({
        "n": [len(rows)], "digests": [rows["digest"].to_numpy(np.int64).tobytes()], "ends": [ends],
        "strings": [strings], "action_ends": [action_ends], "actions": [actions],
        "shapes": [[{"labels": a, "path": b} for a, b in sorted(set(zip(rows["labels"].tolist(), rows["path_length"].tolist())))]]})


class DigestArray:
    """The written index: names of the slice files that tasks find by
    ``SparkFiles``."""

    def __init__(self, names: list[str]):
        self.names = names

    @staticmethod
    def build(spark: SparkSession, rules: DataFrame) -> DigestArray:
        prepare_python(spark)
        path = F.coalesce(F.col("path"), F.lit(""))
        host = F.translate(F.col("host"), UPPER, LOWER)
        rank = F.coalesce(F.col("rank"), F.lit(0)) if "rank" in rules.columns else F.lit(0)
        keyed = (rules.where((host != "") & F.col("action").isNotNull())
                 .select(F.concat(host, path).alias("key"), F.length(path).alias("path_length"),
                         F.struct(rank.cast("int").alias("rank"), F.col("action").alias("action")).alias("say"))
                 .groupBy("key", "path_length").agg(F.min("say").alias("say"))
                 .select("key", "path_length", F.concat_ws("\t", "say.rank", "say.action").alias("action"),
                         F.xxhash64("key").alias("digest"),
                         F.size(F.split(F.expr("substring(key, 1, length(key) - path_length)"), r"\.")).alias("labels")))
        scratch = Scratch(spark, "digest-array")
        keyed = scratch.write(keyed, "rules")
        n = max(1, -(-keyed.count() // SLICE_RULES))
        ranged = keyed.repartitionByRange(n, "digest") if n > 1 else keyed.coalesce(1)
        scratch.write(ranged.sortWithinPartitions("digest").mapInPandas(_slice, _SLICE_SCHEMA), "slices")
        scratch.drop("rules")
        return DigestArray(_ship(spark, scratch.path("slices")))


def _ship(spark: SparkSession, folder: str) -> list[str]:
    """Add each slice file to the job's files (executors fetch them)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = []
    for status in fs.listStatus(p):
        name = status.getPath().getName()
        if name.endswith(".parquet"):
            spark.sparkContext.addFile(status.getPath().toString())
            names.append(name)
    return sorted(names)


def _mapped(data: bytes, dtype) -> np.ndarray:
    """The bytes as a memory-mapped array; its file is already unlinked, so
    nothing stays behind."""
    if not data:
        return np.empty(0, dtype)
    handle, path = tempfile.mkstemp(prefix="digests-")
    with os.fdopen(handle, "wb") as f:
        f.write(data)
    array = np.memmap(path, dtype=dtype, mode="r")
    os.unlink(path)
    return array


_OPEN: dict[str, tuple] = {}


def _open(name: str) -> tuple:
    if name not in _OPEN:
        import pyarrow.parquet as pq
        from pyspark import SparkFiles
        row = pq.read_table(SparkFiles.get(name)).to_pylist()
        r = row[0] if row else None
        _OPEN[name] = (_mapped(r["digests"], np.int64), _mapped(r["ends"], np.int64),
                       _mapped(r["strings"], np.uint8), _mapped(r["action_ends"], np.int64),
                       _mapped(r["actions"], np.uint8), tuple((x["labels"], x["path"]) for x in r["shapes"])) if r else ()
    return _OPEN[name]


def candidates(host: str, path: str, shapes) -> list[str]:
    """Rule strings that would fit the url, longest first.  ``shapes``: the (host
    labels, path length) of the list's rules; no other string can be in it, so a very
    long host or path makes no more candidates than another."""
    if not host:
        return []
    labels = host.rsplit(".", max((n for n, _ in shapes), default=0))
    most = len(labels) if len(labels) <= max((n for n, _ in shapes), default=0) else len(labels) - 1
    found = {".".join(labels[-n:]) + path[:m] for n, m in shapes if n <= most and m <= len(path)}
    return sorted(found - {""}, key=len, reverse=True)


def _field(ends: np.ndarray, data: np.ndarray, i: int) -> bytes:
    return data[(ends[i - 1] if i else 0):ends[i]].tobytes()


def probe(keys: list[bytes], slices: list[tuple]) -> list[str | None]:
    """The action of each key, or None: binary search of all digests at once,
    then the stored string must be equal."""
    import xxhash
    hashes = np.array([xxhash.xxh64_intdigest(k, seed=SEED) for k in keys], np.uint64).view(np.int64)
    out: list[str | None] = [None] * len(keys)
    for digests, ends, strings, action_ends, actions, _ in slices:
        left = np.searchsorted(digests, hashes, "left")
        right = np.searchsorted(digests, hashes, "right")
        for k in np.flatnonzero(right > left):
            for i in range(left[k], right[k]):  # more than one only on a collision
                if _field(ends, strings, i) == keys[k]:
                    out[k] = _field(action_ends, actions, i).decode()
    return out


def _match_column(names: list[str]):
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        slices = [s for s in map(_open, names) if s]
        shapes = sorted({n for s in slices for n in s[5]})
        for hosts, paths in batches:
            keys, owner = [], []
            for i, (h, p) in enumerate(zip(hosts, paths)):
                for c in candidates(h, p, shapes):
                    keys.append(c.encode())
                    owner.append(i)
            best: list[tuple | None] = [None] * len(hosts)
            for k, i, said in zip(keys, owner, probe(keys, slices)):
                if said is not None:
                    rank, action = said.split("\t", 1)
                    if best[i] is None or int(rank) < best[i][0]:  # keys come longest first
                        best[i] = int(rank), k.decode(), action
            yield pd.DataFrame([b[1:] if b else (None, None) for b in best], columns=["rule", "action"])
    run.__annotations__ = {"batches": Iterator[tuple[pd.Series, pd.Series]],
                           "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(run, "rule string, action string")


def url_filter(df: DataFrame, rules: DataFrame, url: str = "url",
               keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """``keep`` and host, path, the longest fitting rule of ``rules`` (host,
    path, action) as host + path, and its action; both null if none fits."""
    prepare_python(df.sparkSession)
    index = DigestArray.build(df.sparkSession, rules)
    host, path = url_parts(F.col("_url"))
    parts = (df.select(*[F.col(c) for c in keep], F.col(url).alias("_url"))
             .select(*keep, host.alias("host"), path.alias("path")))
    return (parts.withColumn("_match", _match_column(index.names)(F.col("host"), F.col("path")))
            .select(*keep, "host", "path", F.col("_match.rule").alias("rule"),
                    F.col("_match.action").alias("action")))


#: Fixed rules of the contract: host, path, action.
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block"))
#: Fixed terms: a host with one of them as a hyphen-separated word of a label
#: is put on the block list.
BLOCKED_TERMS = ("ads", "adult", "bets", "casino", "pills", "spam")
_TERM = rf"(^|[.-])({'|'.join(BLOCKED_TERMS)})([.-]|$)"


def blocked_hosts(pages: DataFrame) -> DataFrame:
    """Block list from the pages: each host with a blocked term, ranked after
    the fixed rules."""
    host, _ = url_parts(F.col("_url"))
    hosts = pages.select(F.col("url").alias("_url")).select(host.alias("host")).distinct()
    return hosts.where(F.col("host").rlike(_TERM)).select(
        "host", F.lit("").alias("path"), F.lit("block").alias("action"), F.lit(1).alias("rank"))


def op9_digest_array(spark, sf_dir):
    """The fixed rules and the block list in one array; a url that fits a rule
    takes its verdict, any other is blocked if its host is listed."""
    pages = spark.read.parquet(table_path(sf_dir, "pages")).select("page_id", "url")
    fixed = spark.createDataFrame([(*r, 0) for r in RULES], "host string, path string, action string, rank int")
    out = url_filter(pages, fixed.unionByName(blocked_hosts(pages)))
    is_rule = F.col("rule").isin([h + p for h, p, _ in RULES])
    return out.select("page_id", "host", "path", F.when(is_rule, F.col("rule")).alias("rule"),
                      F.coalesce(F.col("action"), F.lit("allow")).alias("verdict"))


ORACLE_SQL = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
split AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts),
ruled AS (
  SELECT page_id, host, path, CASE
    WHEN ('.' || host) LIKE '%.example.org' AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN ('.' || host) LIKE '%.example.org' AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM split)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('org/', 'com/fr/') THEN 'allow'
    WHEN rule IS NOT NULL THEN 'block'
    WHEN regexp_matches(host, '(^|[.-])(ads|adult|bets|casino|pills|spam)([.-]|$)') THEN 'block'
    ELSE 'allow' END AS verdict
FROM ruled"""
