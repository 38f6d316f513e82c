"""Traces and conversations: span depth (E9), tree lines (I1), sessions
with turns (E8), assistant messages (D6, I2), delta assembly (I3) and
latest traces (G5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.session import checkpoint_dir


def span_depth(spans: DataFrame) -> DataFrame:
    """Depth of every span = number of existing ancestors above it.

    Pointer jumping: each round replaces a span's pointer with its
    pointer's pointer and adds the pointer's hop count, so a chain of length
    L resolves in about log2(L) equi-joins on (trace_id, span_id) — no
    recursion per level and no per-trace grouping.  A parent that does not
    exist ends the climb (orphan = depth 0).  Each round is checkpointed to
    the shared checkpoint folder to cut lineage.  While any chain is open, each
    round closes at least one of its spans; a round that closes none leaves
    only spans on or below a cycle, which get a null depth."""
    checkpoint_dir(spans.sparkSession)
    nodes = spans.select("trace_id", "span_id", "parent_id")
    exists = nodes.select("trace_id", F.col("span_id").alias("parent_id"),
                          F.lit(True).alias("_ok")).distinct()
    cur = (nodes.join(exists, ["trace_id", "parent_id"], "left")
           .select("trace_id", "span_id",
                   F.when(F.col("_ok"), F.col("parent_id")).alias("ptr"),
                   F.when(F.col("_ok"), F.lit(1)).otherwise(F.lit(0)).cast("long").alias("depth")))
    open_before = None
    while True:
        cur = cur.checkpoint(eager=True)
        still_open = cur.filter(F.col("ptr").isNotNull()).count()
        if still_open == 0 or still_open == open_before:
            break
        open_before = still_open
        a, b = cur.alias("a"), cur.alias("b")
        cur = (a.join(b, (F.col("a.trace_id") == F.col("b.trace_id")) &
                      (F.col("a.ptr") == F.col("b.span_id")), "left")
               .select(F.col("a.trace_id").alias("trace_id"), F.col("a.span_id").alias("span_id"),
                       F.when(F.col("a.ptr").isNotNull(), F.col("b.ptr")).alias("ptr"),
                       (F.col("a.depth") + F.coalesce(F.col("b.depth"), F.lit(0))).alias("depth")))
    return cur.select("trace_id", "span_id",
                      F.when(F.col("ptr").isNull(), F.col("depth")).cast("int").alias("depth"))


def tree_order(spans: DataFrame, depths: DataFrame) -> DataFrame:
    """``(trace_id, span_id, ord)``: each span's place (from 0) when the trees of its
    trace are walked depth first, children and roots by span id.

    The walk as a linked list (Euler tour): a span is entered, then its first child or
    its own leaving follows; after a span is left comes its next sibling or its
    parent's leaving.  The list is ranked by pointer doubling: each round adds up the
    entered spans ahead and doubles the pointers, so a walk of n steps takes about
    log2(n) equi-joins, whatever the tree's shape, and no trace is gathered.  Spans on or
    below a cycle (null depth) have no place."""
    checkpoint_dir(spans.sparkSession)
    tree = (spans.select("trace_id", "span_id", "parent_id").join(depths.where("depth is not null"), ["trace_id", "span_id"])
            .withColumn("up", F.when(F.col("depth") > 0, F.col("parent_id"))))
    siblings = Window.partitionBy("trace_id", "up").orderBy("span_id")
    first = tree.where("up is not null").groupBy("trace_id", "up").agg(F.min("span_id").alias("child"))
    linked = (tree.withColumn("next", F.lead("span_id").over(siblings)).alias("s")
              .join(first.select("trace_id", F.col("up").alias("span_id"), "child"), ["trace_id", "span_id"], "left"))

    def step(span, leaving) -> F.Column:
        return F.struct(span.alias("span"), F.lit(leaving).alias("leaving"))

    into = F.when(F.col("child").isNotNull(), step(F.col("child"), False)).otherwise(step(F.col("span_id"), True))
    out = F.when(F.col("next").isNotNull(), step(F.col("next"), False)).when(F.col("up").isNotNull(), step(F.col("up"), True))
    cur = linked.select("trace_id", F.inline(F.array(
        F.struct(step(F.col("span_id"), False).alias("at"), into.alias("ptr"), F.lit(1).cast("long").alias("ahead")),
        F.struct(step(F.col("span_id"), True).alias("at"), out.alias("ptr"), F.lit(0).cast("long").alias("ahead")))))
    while True:
        cur = cur.checkpoint(eager=True)
        if cur.where("ptr is not null").isEmpty():
            break
        a, b = cur.alias("a"), cur.alias("b")
        cur = (a.join(b, (F.col("a.trace_id") == F.col("b.trace_id")) & (F.col("a.ptr") == F.col("b.at")), "left")
               .select("a.trace_id", "a.at", F.col("b.ptr").alias("ptr"),
                       (F.col("a.ahead") + F.coalesce("b.ahead", F.lit(0))).alias("ahead")))
    spans_of = cur.where("not at.leaving").groupBy("trace_id").agg(F.max("ahead").alias("all"))
    return (cur.where("not at.leaving").join(spans_of, "trace_id")
            .select("trace_id", F.col("at.span").alias("span_id"), (F.col("all") - F.col("ahead")).alias("ord")))


def trace_tree(spans: DataFrame, depths: DataFrame, order: DataFrame | None = None) -> DataFrame:
    """One indented line per span with its place in the printed tree (``ord``), plus
    the trace's span count.  Lines stay rows rather than one collected list, so a huge
    trace is never gathered into a single value."""
    order = order if order is not None else tree_order(spans, depths)
    counts = spans.groupBy("trace_id").agg(F.count(F.lit(1)).alias("num_spans"))
    j = (spans.join(depths, ["trace_id", "span_id"]).join(order, ["trace_id", "span_id"], "left")
         .join(counts, "trace_id"))
    line = F.concat(F.expr("repeat('  ', depth)"), F.lit("- "), F.col("name"), F.lit(" ["),
                    F.col("span_type"), F.lit("]"))
    return j.select("trace_id", "span_id", "ord", "depth", "num_spans", line.alias("line"))


def sessions_with_turns(chat: DataFrame) -> DataFrame:
    """Sessions with at least one assistant turn, newest first — the
    EXISTS test folded into the same aggregate as the turn count (one
    shuffle instead of a distinct plus a semi join)."""
    g = chat.groupBy("session_id").agg(
        F.count(F.lit(1)).alias("n_turns"),
        F.count_if(F.col("role") == "assistant").alias("n_assistant"))
    return g.filter(F.col("n_assistant") > 0).orderBy(F.desc("session_id"))


def assistant_messages(chat: DataFrame) -> DataFrame:
    """Keep assistant output events only."""
    return chat.filter(F.col("role") == "assistant").select("session_id", "turn", "content")


def message_text(parts) -> "F.Column":
    """Text of a message given as an array of parts (type, text): its text
    parts joined in order; parts of other types and null texts are skipped."""
    kept = F.filter(parts, lambda p: p["type"].isin(*TEXT_PARTS) & p["text"].isNotNull())
    return F.array_join(F.transform(kept, lambda p: p["text"]), "")


# Part types that carry message text.
TEXT_PARTS = ("output_text", "text")


def last_assistant_message(chat: DataFrame) -> DataFrame:
    """Per session, the text of its last assistant message (max_by is a
    partial aggregate: no per-session sort).  A chat with a ``parts`` column has
    its message texts put together from them first."""
    if "parts" in chat.columns:
        chat = chat.withColumn("content", message_text(F.col("parts")))
    a = chat.filter(F.col("role") == "assistant")
    return a.groupBy("session_id").agg(F.max("turn").alias("turn"),
                                       F.max_by("content", "turn").alias("content"))


def assemble_deltas(deltas: DataFrame) -> DataFrame:
    """Final text per item from its text deltas in sequence order.  A part
    delivered twice counts once (of differing texts the least)."""
    once = (deltas.filter(F.col("type") == "output_text.delta")
            .groupBy("item_id", "seq").agg(F.min("text").alias("text")))
    parts = F.sort_array(F.collect_list(F.struct("seq", "text")))
    return (once.groupBy("item_id").agg(parts.alias("p"))
            .select("item_id", F.array_join(F.transform("p", lambda x: x["text"]), " ")
                    .alias("text")))


def latest_traces(events: DataFrame, n: int = 5) -> DataFrame:
    """The n most recent records by timestamp (TakeOrderedAndProject)."""
    return (events.select("event_id", "ts", "user_id", "event_type")
            .orderBy(F.desc("ts"), F.desc("event_id")).limit(n))
