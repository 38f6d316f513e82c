"""Cheapest repair of a conversation's structure, by cost dynamic programming and
prefix-doubling path ranking.

A conversation is repaired by keeping (K), re-roling (R), deleting (D) and
inserting (I) turns until its roles read: nothing, or an optional system turn and
then user and assistant in turn, assistant last.  Nodes of the edit graph are
(rows read, state), arcs are edits.

1. Cost.  Cheapest costs to the end, from the last row to the first, for all
   conversations of a batch at once.
2. Ranking.  Arcs on cheapest paths are optimal.  Nodes are ranked by the least
   audit (string of edits) of length 1, then 2, 4, 8, ...: a node's rank of twice
   the length is the rank of its own rank and that of the node its pointer
   reaches, and pointers are doubled with it.  Of a node's optimal arcs the one of
   least (edit, rank of its target) is chosen; the edits that leave a node differ,
   so one pointer a node is enough.  A whole path is read off the doubled pointers.
3. Long conversations.  Those of more than BLOCK rows are cut into blocks of BLOCK
   consecutive rows (places by ``ranking``).  A block is a min-plus matrix between
   the states at its ends; products of matrices, taken over blocks of blocks, give
   each block its costs to the end, and then the state in which the least path
   enters it.  No task holds more than BLOCK rows of a conversation at a time; the
   hash of a repaired conversation alone reads its rows one after another (in one
   task, batch by batch), as it must.

Defined cases: a null role or text is one space; a null conv_id is a conversation
of its own; rows with equal turns are ordered by role, then text; a null turn comes
first; a role is judged by its first character, so an empty or other role can be
re-roled or deleted only; repeated rows are duplicates; a text of any length is
read whole; a conversation without rows has no audit and the hash of nothing; an
empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm.common import Scratch, prepare_python, session_of
from shelfline.llm.ranking import ranked
from shelfline.sources.tables import table_path

#: Rows of a conversation that are held at once.
BLOCK = 4096
#: Keys of long conversations are broadcast up to this many.
BROADCAST_KEYS = 100_000

KEEP, REROLE, DELETE, INSERT, CUT = 0, 2, 3, 2, 1       # costs
LETTERS = np.frombuffer(b"\0DIKR", np.uint8)            # edits in ASCII order; 0 ends an audit
START, SYSTEM, USER, ASSISTANT = range(4)               # states
#: State after a turn of the role that a state expects.
THEN = np.array([USER, USER, ASSISTANT, USER])
#: State after keeping a turn whose role has this initial (none, s, u, a); -1: not possible.
KEPT = np.array([[-1, -1, -1, -1], [SYSTEM, -1, -1, -1], [USER, USER, -1, USER], [-1, -1, ASSISTANT, -1]])
FAR = 1 << 40
#: Costs at the very end, with the turns still to be inserted.
END = np.array([0, 2 * INSERT, INSERT, 0], np.int64)
FAULTS = ("blank", "duplicate", "truncated")            # numbered from 1
SPACES = "\t\n\x0b\x0c\r "

REPORT = ("key string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
          "audit string, repaired_sha256 string")
LINES = "key string, pos long, n long, role string, text string"


# ---- costs and paths of many conversations (or blocks of them)


def _reading(after: np.ndarray, initial: np.ndarray, must_go: np.ndarray, cut: np.ndarray) -> list[np.ndarray]:
    """Costs of D, K and R for rows in each state, given the costs after them."""
    to = KEPT[initial]
    kept = np.where(to >= 0, np.take_along_axis(after, np.maximum(to, 0), 1) + KEEP + CUT * cut[:, None], FAR)
    reroled = after[:, THEN] + REROLE + CUT * cut[:, None]
    kept[must_go] = FAR
    reroled[must_go] = FAR
    return [after + DELETE, kept, reroled]


class Paths:
    """Cheapest paths through segments of rows.  ``ends``: costs after each
    segment's last row, one for each state; ``last``: whether turns may be inserted
    there (else that is up to the next block)."""

    def __init__(self, lengths, initial, must_go, cut, ends, last):
        self.lengths = lengths = np.asarray(lengths, np.int64)
        m, total = len(lengths), int(lengths.sum())
        rows = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if m else np.empty(0, np.int64)
        self.first = rows + np.arange(m)                # a segment has a place more than rows
        finish = self.first + lengths
        self.cost = np.full((total + m, 4), FAR, np.int64)
        self.cost[finish] = ends
        longest = np.argsort(-lengths, kind="stable")
        falling = -lengths[longest]
        for t in range(1, int(lengths.max(initial=0)) + 1):
            s = longest[:np.searchsorted(falling, -t, "right")]
            p, r = finish[s] - t, rows[s] + lengths[s] - t
            best = np.minimum.reduce(_reading(self.cost[p + 1], initial[r], must_go[r], cut[r]))
            ahead = np.minimum(best[:, [USER, ASSISTANT]], best[:, [ASSISTANT, USER]] + INSERT)
            best[:, [USER, ASSISTANT]] = ahead
            best[:, [START, SYSTEM]] = np.minimum(best[:, [START, SYSTEM]], ahead[:, :1] + INSERT)
            self.cost[p] = np.minimum(best, FAR)
        at = np.arange(total) + np.repeat(np.arange(m), lengths)
        self._rows = at, finish[np.asarray(last, bool)], initial, must_go, cut

    def _rank(self, at, open_ends, initial, must_go, cut) -> None:
        places, nodes = len(self.cost), 4 * len(self.cost)
        state = np.arange(4)
        arcs = []                                       # (edit, is optimal, target) by node, edits in order

        def arc(edit, where, costs, to):
            ok, target = np.zeros((places, 4), bool), np.tile(4 * np.arange(places)[:, None], (1, 4)) + state
            ok[where] = (costs == self.cost[where]) & (costs < FAR)
            target[where] = to
            arcs.append((edit, ok.ravel(), target.ravel()))

        removed, kept, reroled = _reading(self.cost[at + 1], initial, must_go, cut)
        after = 4 * (at + 1)[:, None]
        arc(1, at, removed, after + state)
        inside = np.concatenate([at, open_ends])
        arc(2, inside, self.cost[inside][:, THEN] + INSERT, 4 * inside[:, None] + THEN)
        arc(3, at, kept, after + np.maximum(KEPT[initial], 0))
        arc(4, at, reroled, after + THEN)

        rank, pointer = np.zeros(nodes, np.int64), np.arange(nodes)
        for edit, ok, target in reversed(arcs):         # the least edit last
            rank[ok] = edit
            pointer[ok] = target[ok]
        steps = (rank > 0).astype(np.int64)
        while (pointer[pointer] != pointer).any():
            rank = np.unique(rank * (rank.max() + 1) + rank[pointer], return_inverse=True)[1]
            steps, pointer = steps + steps[pointer], pointer[pointer]
        self.steps = steps
        least = np.full(nodes, np.iinfo(np.int64).max)
        self.edit, follow = np.zeros(nodes, np.uint8), np.arange(nodes)
        for edit, ok, target in arcs:
            better = ok & (edit * nodes + rank[target] < least)
            least[better] = edit * nodes + rank[target[better]]
            self.edit[better], follow[better] = edit, target[better]
        self.pointers = [follow]                        # 1, 2, 4, ... edits ahead
        while len(self.pointers) < int(steps.max(initial=0)).bit_length() + 1:
            self.pointers.append(self.pointers[-1][self.pointers[-1]])

    def audits(self, state: int = START) -> tuple[list[str], np.ndarray]:
        """Each segment's least audit from this state, and the state it ends in."""
        if not hasattr(self, "steps"):
            self._rank(*self._rows)
        starts = 4 * self.first + state
        steps = self.steps[starts]
        found: list[str] = [""] * len(starts)
        out = np.full(len(starts), -1)
        rounds = np.array([int(n).bit_length() for n in steps])
        for k in np.unique(rounds):
            s = np.flatnonzero(rounds == k)
            path = starts[s][:, None]
            for j in range(k):
                path = np.hstack([path, self.pointers[j][path]])
            letters = LETTERS[self.edit[path]]
            for i, row, n in zip(s, letters, steps[s]):
                found[i] = row[:n].tobytes().decode()
            out[s] = path[np.arange(len(s)), steps[s]] % 4
        return found, out


def walk(audit: str, state: int, roles, texts) -> Iterator[tuple[str, str]]:
    """The repaired turns of an audit."""
    at = 0
    for edit in audit:
        if edit == "D":
            at += 1
            continue
        kept = edit == "K"
        state = int(KEPT[_initial(roles[at])][state]) if kept else int(THEN[state])
        role = roles[at] if kept else "user" if state == USER else "assistant"
        if edit == "I":
            yield role, ""
        else:
            yield role, texts[at]
            at += 1


def _initial(role: str) -> int:
    return "sua".find(role[0]) + 1 if role else 0


def _illegal(initial: np.ndarray, joined: np.ndarray) -> np.ndarray:
    """Which adjacent pairs (``joined``: of one conversation) break su, ua, au."""
    a, b = initial[:-1], initial[1:]
    return joined & ~(((a == 1) & (b == 2)) | ((a == 2) & (b == 3)) | ((a == 3) & (b == 2)))


# ---- whole conversations


def _repair(table: pd.DataFrame, lines: bool) -> pd.DataFrame:
    """Rows of whole conversations, in order, to their reports or repaired turns."""
    keys = table["key"].to_numpy()
    new = np.r_[True, keys[1:] != keys[:-1]]
    names, segment = keys[new], np.cumsum(new) - 1
    live = table["live"].to_numpy(bool)
    table, segment = table[live], segment[live]
    m = len(names)
    lengths = np.bincount(segment, minlength=m)
    initial = table["initial"].to_numpy(np.int64)
    repeated = table.duplicated(["key", "role", "text"]).to_numpy()
    fault = np.where(table["blank"], 1, np.where(repeated, 2, np.where(table["cut"], 3, 0)))
    paths = Paths(lengths, initial, (fault == 1) | (fault == 2), fault == 3, END, np.ones(m, bool))
    audits, _ = paths.audits()
    edges = np.concatenate([[0], np.cumsum(lengths)])
    roles, texts = table["role"].tolist(), table["text"].tolist()
    turns = [list(walk(a, START, roles[i:j], texts[i:j])) for a, i, j in zip(audits, edges, edges[1:])]
    if lines:
        rows = [(k, 0, n, role, text) for k, found in zip(names, turns) for n, (role, text) in enumerate(found)]
        return pd.DataFrame(rows, columns=["key", "pos", "n", "role", "text"])
    known = table["has_turn"].to_numpy(bool)
    numbered = pd.DataFrame({"s": segment[known], "turn": table["turn"].to_numpy(np.int64)[known]})
    spans = numbered.groupby("s")["turn"].agg(["min", "max", "nunique"])
    gaps = np.zeros(m, np.int64)
    gaps[spans.index] = spans["max"] - spans["min"] + 1 - spans["nunique"]
    bad = _illegal(initial, segment[1:] == segment[:-1]) if len(initial) else np.empty(0, bool)
    return pd.DataFrame({
        "key": names, "gaps": gaps,
        **{name: np.bincount(segment[fault == i + 1], minlength=m) for i, name in enumerate(FAULTS)},
        "illegal": np.bincount(segment[1:][bad], minlength=m), "cost": paths.cost[paths.first, START], "audit": audits,
        "repaired_sha256": [sha256("\n".join(f"{r}:{t}" for r, t in found).encode("utf-8", "surrogatepass")).hexdigest()
                            for found in turns]})


def _whole_fn(lines: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            table = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            open_ = (table["key"] == table["key"].iloc[-1]).to_numpy()
            rest = table[open_]
            if not open_.all():
                yield _repair(table[~open_], lines)
        if rest is not None:
            yield _repair(rest, lines)
    return run


ORDER = ["turn", "role", "text"]                        # nulls first


def _prepared(rows: DataFrame) -> DataFrame:
    """Rows (key, turn, role, text, live) with what the repair reads of them;
    equal conversations are told by ``key``."""
    core = F.rtrim(F.col("text"), F.lit(SPACES))
    return rows.select(
        "key", "turn", "role", "text", "live", F.position(F.substring("role", 1, 1), F.lit("sua")).alias("_at"),
        (core == "").alias("blank"), (~F.right(core, F.lit(1)).isin(".", "!", "?")).alias("cut")).withColumn(
        "initial", F.when(F.col("role") == "", 0).otherwise(F.col("_at"))).drop("_at")


def _short(rows: DataFrame, lines: bool) -> DataFrame:
    """Conversations of at most BLOCK rows: one shuffle, a task reads them one
    after another."""
    return (rows.withColumns({"has_turn": F.col("turn").isNotNull(), "sorted": F.col("turn")})
            .withColumn("turn", F.coalesce("turn", F.lit(0)))
            .repartition("key").sortWithinPartitions("key", "sorted", "role", "text").drop("sorted")
            .mapInPandas(_whole_fn(lines), LINES if lines else REPORT))


# ---- long conversations


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum((a[:, :, None] + b[None, :, :]).min(axis=1), FAR)


def _chain(items: DataFrame, vector: list[int], forward: bool, scratch: Scratch, name: str, block: int) -> DataFrame:
    """Of matrices ``m`` in a row (key, pos, size, m): the costs (key, pos, v)
    before each of them from ``vector`` at the front (forward), or after each of
    them to ``vector`` at the end; by products over blocks of blocks."""
    def product(table: pd.DataFrame) -> pd.DataFrame:
        table = table.sort_values("pos")
        out = np.where(np.eye(4, dtype=bool), 0, FAR)
        for m in table["m"]:
            out = _times(out, np.reshape(m, (4, 4)))
        return pd.DataFrame({"key": [table["key"].iloc[0]], "pos": [int(table["pos"].iloc[0]) // block],
                             "size": [-(-int(table["size"].iloc[0]) // block)], "m": [out.ravel().tolist()]})

    def spread(table: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        table = table.sort_values("pos", ascending=forward)
        now, found = np.array(outer["v"].iloc[0]), []
        for m in table["m"]:
            found.append(now.tolist())
            m = np.reshape(m, (4, 4))
            now = np.minimum((now[:, None] + m if forward else (m + now).T).min(axis=0), FAR)
        return pd.DataFrame({"key": table["key"], "pos": table["pos"], "v": found})

    group = F.expr(f"pos div {block}")
    above = scratch.write(items.groupBy("key", group).applyInPandas(product, "key string, pos long, size long, m array<long>"),
                          f"{name}+")
    if above.where("size > 1").isEmpty():
        outer = above.select("key", "pos", F.array(*[F.lit(v).cast("long") for v in vector]).alias("v"))
    else:
        outer = _chain(above, vector, forward, scratch, f"{name}+", block)
    out = items.groupBy("key", group).cogroup(outer.groupBy("key", "pos")).applyInPandas(
        spread, "key string, pos long, v array<long>")
    return scratch.write(out, f"{name}-v")


def _segment(table: pd.DataFrame):
    table = table.sort_values("pos")
    fault = table["fault"].to_numpy()
    return table, (np.array([len(table)]), table["initial"].to_numpy(np.int64), (fault == 1) | (fault == 2), fault == 3)


class _Long:
    """The conversations of more than ``block`` rows."""

    def __init__(self, rows: DataFrame, block: int):
        self.spark, self.block = rows.sparkSession, block
        self.scratch = scratch = Scratch(self.spark, "long-conversations")
        placed = ranked(rows.where("live"), "key", ORDER, scratch, "rows")
        placed = placed.withColumn("same", F.sha2(F.concat("role", F.lit("\0"), "text").cast("binary"), 256))
        first = placed.groupBy("key", "same").agg(F.min("pos").alias("_first"))
        fault = (F.when(F.col("blank"), 1).when(F.col("pos") > F.col("_first"), 2).when(F.col("cut"), 3).otherwise(0))
        self.rows = scratch.write(placed.join(first, ["key", "same"]).select(
            "key", "pos", F.expr(f"pos div {block}").alias("block"), F.expr(f"(size + {block - 1}) div {block}").alias("blocks"),
            "turn", "role", "text", "initial", fault.alias("fault")), "marked")
        self.pieces = self._pieces()

    def _pieces(self) -> DataFrame:
        """(key, block, state, cost, audit): how the least path runs through each
        block."""
        def matrix(table: pd.DataFrame) -> pd.DataFrame:
            table, segment = _segment(table)
            ends = np.where(np.eye(4, dtype=bool), 0, FAR)
            m = np.stack([Paths(*segment, ends[q][None], [False]).cost[0] for q in range(4)], axis=1)
            initial = segment[1]
            return pd.DataFrame({"key": [table["key"].iloc[0]], "pos": [table["block"].iloc[0]], "size": [table["blocks"].iloc[0]],
                                 "m": [m.ravel().tolist()], "head": [initial[0]], "tail": [initial[-1]],
                                 "illegal": [int(_illegal(initial, np.ones(len(initial) - 1, bool)).sum())]})

        def paths(table: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
            table, segment = _segment(table)
            block, blocks = int(table["block"].iloc[0]), int(table["blocks"].iloc[0])
            found = Paths(*segment, np.array(outer["v"].iloc[0])[None], [block == blocks - 1])
            through = [found.audits(q) for q in range(4)]
            m = np.full((4, 4), FAR)
            for q, (_, out) in enumerate(through):
                m[q, out[0]] = 0
            return pd.DataFrame({"key": [table["key"].iloc[0]], "pos": [block], "size": [blocks], "m": [m.ravel().tolist()],
                                 "cost": [int(found.cost[0, START])], "audits": [[a[0] for a, _ in through]]})

        narrow = self.rows.select("key", "pos", "block", "blocks", "initial", "fault")
        self.blocks = self.scratch.write(narrow.groupBy("key", "block").applyInPandas(
            matrix, "key string, pos long, size long, m array<long>, head int, tail int, illegal long"), "blocks")
        ends = _chain(self.blocks.select("key", "pos", "size", "m"), END.tolist(), False, self.scratch, "ends", self.block)
        through = self.scratch.write(
            narrow.groupBy("key", "block").cogroup(ends.groupBy("key", "pos")).applyInPandas(
                paths, "key string, pos long, size long, m array<long>, cost long, audits array<string>"), "paths")
        states = _chain(through.select("key", "pos", "size", "m"), [0, FAR, FAR, FAR], True, self.scratch, "states", self.block)
        state = F.array_position("v", F.lit(0).cast("long")).cast("int")
        return self.scratch.write(through.join(states, ["key", "pos"]).select(
            "key", F.col("pos").alias("block"), (state - 1).alias("state"), "cost",
            F.element_at("audits", state).alias("audit")), "pieces")

    def lines(self) -> DataFrame:
        """The repaired turns (key, pos, n, role, text), in the order of pos, n."""
        def turns(table: pd.DataFrame, piece: pd.DataFrame) -> pd.DataFrame:
            table = table.sort_values("pos")
            found = walk(piece["audit"].iloc[0], int(piece["state"].iloc[0]), table["role"].tolist(), table["text"].tolist())
            rows = [(table["key"].iloc[0], int(table["block"].iloc[0]), n, role, text) for n, (role, text) in enumerate(found)]
            return pd.DataFrame(rows, columns=["key", "pos", "n", "role", "text"])

        return self.rows.select("key", "pos", "block", "role", "text").groupBy("key", "block").cogroup(
            self.pieces.groupBy("key", "block")).applyInPandas(turns, LINES)

    def report(self) -> DataFrame:
        def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            key, digest = None, sha256()
            for batch in batches:
                done = []
                for k, role, text in zip(batch["key"], batch["role"], batch["text"]):
                    line = f"{role}:{text}".encode("utf-8", "surrogatepass")
                    if k != key:
                        if key is not None:
                            done.append((key, digest.hexdigest()))
                        key, digest = k, sha256(line)
                    else:
                        digest.update(b"\n" + line)
                yield pd.DataFrame(done, columns=["key", "repaired_sha256"])
            if key is not None:
                yield pd.DataFrame([(key, digest.hexdigest())], columns=["key", "repaired_sha256"])

        hashes = (self.lines().repartition("key").sortWithinPartitions("key", "pos", "n").select("key", "role", "text")
                  .mapInPandas(hashed, "key string, repaired_sha256 string"))
        counts = self.rows.groupBy("key").agg(
            F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"),
            *[F.count_if(F.col("fault") == i + 1).alias(name) for i, name in enumerate(FAULTS)])
        legal = F.expr("(a.tail, b.head) in ((1, 2), (2, 3), (3, 2))")
        seams = (self.blocks.alias("a").join(self.blocks.alias("b"), F.expr("a.key = b.key and a.pos + 1 = b.pos"))
                 .where(~legal).select(F.col("a.key").alias("key"), F.lit(1).cast("long").alias("illegal")))
        illegal = self.blocks.select("key", "illegal").unionByName(seams).groupBy("key").agg(F.sum("illegal").alias("illegal"))
        pieces = F.array_sort(F.collect_list(F.struct("block", "audit")))    # the audit is one value by contract
        audits = self.pieces.groupBy("key").agg(
            F.max(F.when(F.col("block") == 0, F.col("cost"))).alias("cost"),
            F.array_join(F.transform(pieces, lambda p: p["audit"]), "").alias("audit"))
        return (counts.join(illegal, "key").join(audits, "key").join(hashes, "key", "left")
                .withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.lit(sha256().hexdigest()))))


# ---- the operator


def _run(rows: DataFrame, lines: bool, block: int) -> DataFrame:
    if block < 2:
        raise ValueError("a block has two rows or more")
    spark = session_of(rows)
    prepare_python(spark)
    rows = _prepared(rows)
    long = Scratch(spark, "conversations").write(
        rows.where("live").groupBy("key").count().where(F.col("count") > block).select("key"), "long")
    many = long.count()
    if not many:
        return _short(rows, lines)
    keys = F.broadcast(long) if many <= BROADCAST_KEYS else long
    others = _short(rows.join(keys, "key", "left_anti"), lines)
    cut = _Long(rows.join(keys, "key", "left_semi"), block)
    return others.unionByName((cut.lines() if lines else cut.report()).select(others.columns))


def rows_of(conversations: DataFrame) -> DataFrame:
    """Conversations (conv_id, turn, role, text) as the operator reads them: a
    key that is never null, nulls as one space."""
    space = F.lit(" ")
    return conversations.select(F.coalesce(F.col("conv_id").cast("string"), space).alias("key"), F.col("turn").cast("long").alias("turn"),
                                F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"),
                                F.lit(True).alias("live"))


def audits(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """One report (REPORT) for each conversation of rows (key, turn, role, text,
    live); rows that are not live only name their conversation."""
    return _run(rows, False, block)


def repaired(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """The repaired turns (LINES) of all conversations; a conversation's turns are
    in the order of pos, n."""
    return _run(rows, True, block)


def damaged(rows: DataFrame) -> DataFrame:
    """The query's damage, drawn by crc32 of ``conv_id:turn``.  Of a
    conversation's dropped rows one remains that is not live."""
    space, text = F.lit(" "), F.col("text")
    draw = F.crc32(F.concat_ws(":", "key", F.coalesce(F.col("turn").cast("string"), space)).cast("binary")) % 20
    drawn = rows.withColumn("draw", draw)
    gone = drawn.where("draw = 0").select("key").distinct().select(
        "key", F.lit(None).cast("long").alias("turn"), space.alias("role"), space.alias("text"), F.lit(False).alias("live"))
    copies = F.when(F.col("draw") == 3, F.sequence(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    left = (drawn.where("draw <> 0").withColumn("copy", F.explode(copies))
            .withColumns({"text": F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.regexp_replace(text, "[.!?]", ""))
                          .otherwise(text),
                          "role": F.when(F.col("draw") == 4, "user").otherwise(F.col("role"))}))
    return left.select(rows.columns).unionByName(gone.select(rows.columns))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = audits(damaged(rows_of(spark.read.parquet(table_path(sf_dir, "conversations")))))
    conv_id = F.when(F.col("key") != " ", F.col("key")).cast("long").alias("conv_id")
    return found.select(conv_id, *[c for c in found.columns if c != "key"])
