"""Tables that are kept up to date: the model's manifest, snapshots with digests, the
index, and what is derived by position (phrases, tree order)."""

import os
import random
import re
import shutil
import tempfile

import pytest
from pyspark.sql import functions as F

from shelfline.operators import evals, text, traces
from shelfline.plans import dashboard
from shelfline.plans.catalog import QUERIES
from shelfline.plans.model import Model
from shelfline.sources import sinks
from shelfline.sources import views as V
from shelfline.sources.tables import SCHEMAS, read_table
from shelfline.sources.versions import Versions
from shelfline.streaming import sync
from shelfline.streaming.buckets import Buckets
from tests.conftest import SMALL


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(repr, df.collect()))


# ---- A13


@pytest.fixture
def shared(spark, tmp_path, monkeypatch):
    """A shared folder as a cluster names it, and a source folder in several files."""
    source, root = str(tmp_path / "source"), str(tmp_path / "shared")
    os.makedirs(root)
    os.makedirs(source)
    for name in SCHEMAS:
        df = read_table(spark, SMALL, name)
        if name in ("lineitem", "orders", "documents", "embeddings"):
            key = df.columns[0]
            for k in range(2):
                df.where(F.col(key) % 3 == k).coalesce(1).write.mode("append").parquet(f"{source}/{name}.parquet")
        else:
            shutil.copyfile(f"{SMALL}/{name}.parquet", f"{source}/{name}.parquet")
    monkeypatch.setattr("shelfline.plans.model.shared_root", lambda spark: root)
    return source


def add(spark, source, name, keep):
    read_table(spark, SMALL, name).where(keep).coalesce(1).write.mode("append").parquet(f"{source}/{name}.parquet")


def fresh(spark, source):
    """The model's tables computed from the sources."""
    ln = V.lines(spark, source)
    return {"lines": ln, "sales": V.sales_from(ln), "promotions": V.promotions_from(ln),
            "market_share": V.market_share_from(ln, V.products(spark, source)), "documents": V.documents(spark, source)}


def assert_current(spark, source, model):
    for name, want in fresh(spark, source).items():
        assert rows(getattr(model, name)().select(want.columns)) == rows(want), name
    assert model.max_of("sales", "week_ending") == fresh(spark, source)["sales"].agg(F.max("week_ending")).first()[0]


def test_second_session_builds_nothing_and_added_files_are_merged(spark, shared):
    first = Model(spark, shared).build()
    assert set(first.made) >= {"lines", "sales", "promotions", "market_share", "documents", "doc_positions", "vectors"}
    assert_current(spark, shared, first)
    other = Model(spark.newSession(), shared).build()
    assert other.made == []

    # late lines of known orders: only their months are written again
    month = first.lines().agg(F.max(F.trunc("d", "month"))).first()[0]
    late = (F.col("l_orderkey") % 3 == 2) & (F.trunc("l_shipdate", "month") >= F.lit(month))
    add(spark, shared, "orders", F.col("o_orderkey") % 3 == 2)
    add(spark, shared, "lineitem", late)
    grown = Model(spark, shared)
    before, entry = first._entry("sales"), grown._entry("sales")
    kept = set(before["parts"]) & set(entry["parts"])
    assert kept and len(set(before["parts"]) - kept) <= 2
    assert len(grown._entry("lines")["parts"]) == 2
    assert_current(spark, shared, grown)

    # orders that arrive after their lines
    add(spark, shared, "lineitem", (F.col("l_orderkey") % 3 == 2) & ~late)
    add(spark, shared, "documents", F.col("doc_id") % 3 == 2)
    again = Model(spark, shared)
    assert_current(spark, shared, again)
    assert "sales" in again.made and "vectors" not in again.build().made
    assert len(again._entry("documents")["parts"]) == 2


def test_orders_after_their_lines(spark, shared):
    add(spark, shared, "lineitem", F.col("l_orderkey") % 3 == 2)
    early = Model(spark, shared).build("sales")
    n = early.sales().count()
    add(spark, shared, "orders", F.col("o_orderkey") % 3 == 2)
    assert_current(spark, shared, Model(spark, shared))
    assert early.sales().count() == n                   # a handle reads one version


def test_changed_input_rebuilds_and_stale_versions_go(spark, shared):
    first = Model(spark, shared, keep_seconds=0).build("sales", "documents")
    old = first._entry("documents")["parts"][0]
    folder = f"{shared}/documents.parquet"
    gone = sorted(f for f in os.listdir(folder) if f.endswith(".parquet"))[0]
    os.unlink(os.path.join(folder, gone))
    second = Model(spark, shared, keep_seconds=0).build("sales", "documents")
    assert second.made == ["documents"]
    assert rows(second.documents()) == rows(V.documents(spark, shared))
    assert not second.files.exists(old) and second.files.exists(second._entry("documents")["parts"][0])
    assert rows(second.sales()) == rows(first.sales())
    assert len(second.versions._numbers()) == 1


def test_versions(spark, tmp_path):
    v = Versions(spark, str(tmp_path / "p"))
    assert v.latest() == (0, {}) and v.retire(0) == []
    assert v.publish({"a": 1}) == 1
    v.files.create(v._path(2, "claim"), "")             # a writer that died after its claim
    assert v.publish(lambda now: now | {"b": 2}) == 3 and v.latest() == (3, {"a": 1, "b": 2})
    assert not v.files.create(v._path(3), "x")
    assert v.retire(3600) == [] and v.retire(0) == [{"a": 1}] and v._numbers() == [3]


# ---- A12


@pytest.mark.parametrize("key", ["dashboard_payload", "dashboard_json"])
def test_one_scan_of_the_sales_fact(spark, key):
    p = plan_of(dashboard.dashboard_payload(spark, SMALL) if key == "dashboard_payload" else QUERIES[key](spark, SMALL))
    assert "Expand" in p
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", p)
    assert sum("pos_sum#" in s for s in scans) == 1 and sum("roi#" in s for s in scans) == 1
    assert sum("dollar_share_pct#" in s for s in scans) == 1


def test_dashboard_of_empty_tables(spark, tmp_path):
    for name, schema in SCHEMAS.items():
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    got = [(r.ord, r.value) for r in dashboard.kpi_cards(spark, str(tmp_path)).orderBy("ord").collect()]
    assert got == [(1, "$0"), (2, "0"), (3, "0"), (4, "0"), (5, "0")]
    assert dashboard.dashboard_payload(spark, str(tmp_path)).count() == 5


# ---- A5


DOCS = "doc_id long, doc_type string, category string, content string"


def test_change_feed_reads_differing_buckets_only(spark, tmp_path):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("t").alias("doc_type"),
                                    F.when(F.col("id") % 2 == 0, "c").alias("category"),
                                    F.concat(F.lit("text "), F.col("id").cast("string")).alias("content"))
    new = (docs.where("doc_id <> 5").withColumn("content", F.when(F.col("doc_id") == 17, F.lit(None)).otherwise(F.col("content")))
           .withColumn("doc_type", F.when(F.col("doc_id") == 40, None).otherwise(F.col("doc_type")))
           .withColumn("category", F.when(F.col("doc_id") == 40, "t").otherwise(F.col("category")))
           .unionByName(spark.createDataFrame([(9001, "t", None, "new")], DOCS)))
    a, b, same = (sync.Snapshot.write(df, str(tmp_path / name), buckets=64)
                  for name, df in (("a", docs), ("b", new), ("same", docs.repartition(5))))
    assert sync.changed_buckets(a, same) == [] and sync.change_feed(a, same).count() == 0
    changed = sync.changed_buckets(a, b, group=8)
    assert 1 <= len(changed) <= 4
    feed = sync.change_feed(a, b)
    got = {r.doc_id: (r.change_type, r.content) for r in feed.collect()}
    assert got == {5: ("delete", None), 17: ("update", None), 40: ("update", "text 40"), 9001: ("insert", "new")}
    p = plan_of(feed)
    pushed = [set(map(int, x.split(","))) for x in re.findall(r"PartitionFilters: \[[^\]]*bucket#\d+ IN \(([\d,]+)\)", p)]
    pushed += [{int(x)} for x in re.findall(r"PartitionFilters: \[[^\]]*\(bucket#\d+ = (\d+)\)", p)]
    assert pushed and all(x == set(changed) for x in pushed)


# ---- A6


def changes(spark, *found):
    return spark.createDataFrame([(i, kind, v, "t", "c", content) for i, kind, v, content in found], sync.CHANGE_SCHEMA)


def state(index):
    return sorted((r.doc_id, r.content) for r in index.state().collect())


def test_replayed_and_interrupted_batches(spark, tmp_path, monkeypatch):
    index = sync.Index(spark, str(tmp_path / "i"), buckets=4)
    assert state(index) == []
    one = changes(spark, *[(i, "insert", 0, f"v0 {i}") for i in range(20)])
    index.upsert(one, "s", 0)
    two = changes(spark, (1, "delete", 1, None), (2, "update", 1, "v1 2"), (2, "update", 2, "v2 2"), (30, "insert", 1, "v1 30"))
    want = sorted([(i, f"v0 {i}") for i in range(20) if i not in (1, 2)] + [(2, "v2 2"), (30, "v1 30")])

    # cut off between write and switch: readers see the old index, the batch runs again
    def stop(*_, **__):
        raise OSError("lost")
    monkeypatch.setattr(Buckets, "switch", stop)
    before = state(index)
    with pytest.raises(OSError):
        index.upsert(two, "s", 1)
    monkeypatch.undo()
    assert state(index) == before
    for _ in range(2):                                  # and is replayed after the switch
        index.upsert(two, "s", 1)
        assert state(index) == want and index.store.rows_in() == 24
    index.upsert(changes(spark, (1, "update", 0, "too late"), (2, "update", 1, "too late")), "other", 0)
    assert state(index) == want
    assert state(sync.Index(spark, str(tmp_path / "i"))) == want


def test_untouched_buckets_stay_and_compaction_drops_marks(spark, tmp_path):
    index = sync.Index(spark, str(tmp_path / "i"), buckets=8)
    index.upsert(changes(spark, *[(i, "insert", 0, "x") for i in range(50)]), "s", 0)
    old = index.store.pointer()["kinds"]["rows"]
    index.upsert(changes(spark, (7, "delete", 1, None)), "s", 1)
    new = index.store.pointer()["kinds"]["rows"]
    assert sum(old[b] != new[b] for b in old) == 1
    before = state(index)
    index.compact()
    assert state(index) == before and index.store.read("rows").count() == 49
    index.upsert(changes(spark, (8, "delete", 1, None)), "s", 1)       # still known to be applied
    assert state(index) == before
    index.store.retire(0)
    held = {p for found in index.store.pointer()["kinds"]["rows"].values() for p in found}
    left = {os.path.join(d, n) for d, names, _ in os.walk(tmp_path / "i" / "data") for n in names if n.startswith("bucket=")}
    assert left == held and state(index) == before


def test_stream_replays_a_batch_whose_commit_was_lost(spark, tmp_path):
    index = sync.Index(spark, str(tmp_path / "i"))
    source, ckpt = str(tmp_path / "changes"), str(tmp_path / "ckpt")
    changes(spark, (1, "insert", 0, "a"), (2, "insert", 0, "b")).write.parquet(source)
    assert sync.sync_once(index, source, ckpt) == 2
    for name in os.listdir(f"{ckpt}/commits"):
        if not name.startswith("_"):
            os.unlink(f"{ckpt}/commits/{name}")
    assert sync.sync_once(index, source, ckpt) == 0
    assert state(index) == [(1, "a"), (2, "b")]


# ---- A1, A3


def test_names_follow_their_folders(spark, tmp_path):
    df = spark.createDataFrame([(1, "2024-01-05")], "k long, d string")
    assert sinks.write_audit(df, "t", str(tmp_path / "a"), ("d",), namespace="shelfline_t").first() == ("t", 1)
    assert spark.table("shelfline_t.t").dtypes == [("k", "bigint"), ("d", "date")]
    sinks.write_audit(df.unionByName(df), "t", str(tmp_path / "b"), ("d",), namespace="shelfline_t")
    assert spark.table("shelfline_t.t").count() == 2
    sinks.write_audit(df.withColumn("x", F.lit(1)), "t", str(tmp_path / "c"), namespace="shelfline_t")
    assert spark.table("shelfline_t.t").columns == ["k", "d", "x"]
    names = {sinks.publish_source(spark, "shelfline_t", "t", str(tmp_path / x)) for x in "ab"}
    assert len(names) == 2 and sorted(spark.table(n).count() for n in names) == [1, 2]


# ---- I6


def test_phrases_by_position(spark):
    """Against a scan for the words, with phrases of common terms, repeats inside a
    phrase and phrases longer than a text."""
    rng = random.Random(3)
    docs = [(i, " ".join(rng.choice("a a a b c d".split()) for _ in range(rng.randrange(0, 60)))) for i in range(120)]
    facts = [(i, " ".join(rng.choice("aabcd") for _ in range(n))) for i, n in enumerate([1, 2, 2, 3, 3, 4, 5, 6, 7, 9] * 4)]
    facts += [(100, "a a a a"), (101, "A, b!"), (102, "zzz"), (103, "zzz a"), (104, " ".join("abcd" * 30)), (105, "...")]
    d, f = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(facts, "item_id long, text string")
    index = text.term_positions(d, "text")
    clean = {i: " " + " ".join(re.findall("[a-z]+", t.lower())) + " " for i, t in facts}
    want = {(i, j) for i, p in clean.items() if p.strip() for j, t in docs if p in f" {t} "}
    from shelfline.functions import columns as C
    phrases = f.select("item_id", F.filter(C.terms("text"), lambda t: t != "").alias("terms")).where(F.size("terms") > 0)
    assert {(r.item_id, r.doc_id) for r in evals.phrase_hits(phrases, index).collect()} == want
    p = plan_of(evals.fact_coverage(f, d, index))
    assert "instr" not in p.lower() and "Contains" not in p and "NestedLoop" not in p


# ---- I1


def test_tree_order_of_branching_traces(spark):
    rng = random.Random(8)
    spans, want = [], {}
    for t in range(6):
        parent = {}
        for s in range(1, 30 + 10 * t):
            parent[s] = rng.choice([None, *range(max(1, s - 6), s)]) if s > 1 and rng.random() < .9 else None
        ids = dict(zip(parent, rng.sample(range(1000), len(parent))))
        kids = {}
        for s, p in parent.items():
            kids.setdefault(p, []).append(s)
        out = []

        def walk(p):
            for s in sorted(kids.get(p, []), key=ids.get):
                out.append(ids[s])
                walk(s)
        walk(None)
        spans += [(t, ids[s], ids.get(p), "n", "T") for s, p in parent.items()]
        want |= {(t, s): k for k, s in enumerate(out)}
    spans += [(9, 1, 2, "n", "T"), (9, 2, 1, "n", "T"), (9, 3, None, "r", "T"), (9, 4, 77, "orphan", "T"), (9, 5, 3, "n", "T")]
    want |= {(9, 1): None, (9, 2): None, (9, 3): 0, (9, 5): 1, (9, 4): 2}
    df = spark.createDataFrame(spans, "trace_id long, span_id long, parent_id long, name string, span_type string").repartition(4)
    tree = traces.trace_tree(df, traces.span_depth(df))
    assert {(r.trace_id, r.span_id): r.ord for r in tree.collect()} == want
    lines = [r.line for r in tree.where("trace_id = 9 and ord is not null").orderBy("ord").collect()]
    assert lines == ["- r [T]", "  - n [T]", "- orphan [T]"]


def test_a_long_chain_has_an_order(spark):
    df = spark.range(3000).select(F.lit(1).alias("trace_id"), F.col("id").alias("span_id"),
                                  F.when(F.col("id") > 0, F.col("id") - 1).alias("parent_id"), F.lit("n").alias("name"), F.lit("T").alias("span_type"))
    order = traces.tree_order(df, df.select("trace_id", "span_id", F.col("span_id").cast("int").alias("depth")))
    assert order.where("ord <> span_id").count() == 0 and order.count() == 3000


# ---- F13, H5, C18/C19, H3


def test_sketches_merge_over_parts_and_months(spark):
    import datetime as dt
    from shelfline.operators import share
    rng = random.Random(2)
    rows = [(p, r, dt.date(2024, m, d)) for p in range(3) for r in range([40, 900, 5000][p]) for m, d in
            [(rng.choice([1, 2, 3, 4]), rng.randrange(1, 25)) for _ in range(2)]]
    lines = spark.createDataFrame(rows, "product_id int, retailer_id long, d date")
    half = [share.store_sketches(lines.where(F.col("retailer_id") % 2 == k)) for k in (0, 1)]
    merged = half[0].unionByName(half[1]).unionByName(half[0])      # a part counted twice adds nothing
    weeks = lines.withColumn("week_ending", F.expr("next_day(date_sub(d, 1), 'Sat')"))
    for months in (1, 3, 6):
        latest = dt.date(2024, 4, 27)
        exact = {r.product_id: r.stores_selling for r in share.stores_exact(weeks, months, latest).collect()}
        got = {r.product_id: r.stores_estimate for r in share.stores_over(merged, months, latest).collect()}
        assert set(got) == set(exact)
        assert all(abs(got[p] - n) <= share.SKETCH_BOUND * n for p, n in exact.items())
    assert 0.08 < share.SKETCH_BOUND < 0.09


def test_a_session_is_read_from_its_bucket(spark):
    from shelfline.operators import memory
    # buckets are pruned either way; the plan names them where the planner does not turn
    # off bucket-wise reading because nothing is joined
    key = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    spark.conf.set(key, "false")
    m = Model(spark, SMALL)
    history = memory.chat_history(m.chat(), F.lit(m.max_of("chat", "session_id")))
    p = plan_of(history)
    spark.conf.unset(key)
    assert "SelectedBucketsCount: 1 out of 16" in p
    assert rows(m.chat()) == rows(V.chat(spark, SMALL))
    other = Model(spark.newSession(), SMALL)
    assert rows(memory.chat_history(other.chat(), F.lit(5))) == rows(V.chat(spark, SMALL).where("session_id = 5")) and other.made == []


def test_fields_of_nested_values(spark):
    import datetime as dt
    from shelfline.operators import memory
    at = dt.datetime(2024, 1, 1)
    log = [("u", "a", '{"x": 1, "y": {"z": [1, "two"]}, "s": "text \\"q\\"", "n": null}', "put", at, 1),
           ("u", "a", "[1]", "put", at, 2), ("u", "b", '{"k": 1}', "put", at, 3), ("u", "b", None, "delete", at, 4),
           ("u", "c", "{}", "put", at, 5), ("v", "a", '{"k": true}', "put", at, 6), ("v", "a", '{"k": 2.5}', "put", at, 7)]
    df = spark.createDataFrame(log, "user_id string, key string, value_json string, op string, ts timestamp_ntz, seq long")
    want = [("u", "a", "n", "null"), ("u", "a", "s", 'text "q"'), ("u", "a", "x", "1"), ("u", "a", "y", '{"z":[1,"two"]}'),
            ("v", "a", "k", "2.5")]
    assert sorted((r.user_id, r.key, r.field, r.text) for r in memory.memory_fields(df).collect() if r.field) == want
    stored = memory.parsed(df)
    assert memory.parsed(stored) is stored
    m = Model(spark, SMALL)
    for q in (memory.live_memories(m.memory_log()), memory.json_validate(m.memory_log()), memory.memory_fields(m.memory_log())):
        assert "parse_json" not in plan_of(q)


def test_one_scan_serves_many_query_blocks(spark, monkeypatch):
    from shelfline.operators import retrieval
    monkeypatch.setattr(retrieval, "QUERY_BLOCK", 3)
    vec = lambda i, n=4: [float((i * 7 + j * j) % 11 - 5) for j in range(n)]
    docs = spark.createDataFrame([(i, vec(i), i % 3) for i in range(60)] + [(100, vec(1, 2), 0), (101, None, 1), (102, vec(3, 2), 0)],
                                 "doc_id long, embedding array<double>, label int")
    queries = spark.createDataFrame([(i, vec(i + 90)) for i in range(11)] + [(50, vec(5, 2)), (51, None)], "qid long, qvec array<double>")
    found = retrieval.vector_topk_batch(spark, docs, queries, 3)
    assert plan_of(found).count("MapInPandas") == 1
    import numpy as np
    got = {}
    for r in found.collect():
        got.setdefault(r.qid, []).append((r.rank, r.doc_id, r.score))
    data = [(r.doc_id, r.embedding) for r in docs.collect() if r.embedding]
    for q in queries.collect():
        if q.qvec:
            scored = sorted((-round(float(np.dot(q.qvec, e) / np.linalg.norm(q.qvec) / np.linalg.norm(e)), 6), i)
                            for i, e in data if len(e) == len(q.qvec) and any(e))
            assert [(d, s) for _, d, s in sorted(got[q.qid])] == [(i, -s) for s, i in scored[:3]]
    assert 51 not in got
    centre = {r.qid: len(r.qvec) for r in retrieval.label_centroids(docs).collect()}
    assert centre == {0: 4, 1: 4, 2: 4}


# ---- H2


def test_posting_blocks_leave_the_ranking_as_it_is(spark, monkeypatch):
    """Same rows as without blocks, from fewer postings; with literals and with joins."""
    rng = random.Random(9)
    vocabulary = [f"t{i}" for i in range(30)]
    docs = []
    for i in range(1500):
        words = rng.choices(vocabulary, weights=[1 / (j + 1) for j in range(30)], k=rng.randrange(0, 20))
        docs.append((i * 3 if i % 2 else -i, " ".join(words + (["t5"] * rng.randrange(20, 40) if i in (40, 41, 700, 901) else []))))
    d = spark.createDataFrame(docs, "doc_id long, content string")
    monkeypatch.setattr(text, "BLOCK_DOCS", 32)
    index = text.with_blocks(text.term_index(d)).cache()
    blocks = text.posting_blocks(index).cache()
    read, real = [], text._literal

    def counted(rows, key, wanted, most):
        out = real(rows, key, wanted, most)
        if key == "block":
            read.append(out.count())
        return out
    for words, k in ((["t5", "t1"], 3), (["t5"], 4), (["t0", "t2", "t29"], 10), (["zzz"], 3), (["zzz", "t9"], 5), (["t29"], 5000)):
        q = spark.createDataFrame([(w,) for w in words], "term string")
        want = rows_in_order(text.text_search(d, q, k, index))
        for most in (0, 1000):
            monkeypatch.setattr(text, "PUSHED_TERMS", most)
            monkeypatch.setattr(text, "PUSHED_BLOCKS", most)
            monkeypatch.setattr(text, "_literal", counted)
            read.clear()
            assert rows_in_order(text.text_search(d, q, k, index, blocks)) == want
            if words == ["t5", "t1"]:
                assert sum(read) < index.where(F.col("term").isin(words)).count() / 4
            monkeypatch.setattr(text, "_literal", real)


def rows_in_order(df):
    return [tuple(r) for r in df.collect()]


# ---- H1


@pytest.mark.parametrize("spread, most", [(0.05, 0.4), (5.0, 1.0)])
def test_pivots_leave_the_nearest_as_they_are(spark, spread, most):
    """Equal to brute force; of clustered vectors a fraction is scored, of scattered ones
    up to all."""
    import numpy as np
    from shelfline.functions import vectors as VX
    from shelfline.operators import retrieval
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 16))
    data = [(i, (centres[i % 12] + spread * rng.normal(size=16)).tolist()) for i in range(1200)]
    data += [(5000, None), (5001, [0.0] * 16), (5002, [1.0, 2.0]), (5003, data[7][1])]
    v = spark.createDataFrame(data, "doc_id long, embedding array<double>").withColumn("norm", VX.norm("embedding"))
    pivots = retrieval.choose_pivots(v)
    assert len(pivots) == retrieval.PIVOTS
    stored = v.withColumn("pivot_distances", retrieval.pivot_distances(pivots)).cache()
    scored = []
    for i in (0, 7, 100):
        q = data[i][1]
        want = [tuple(r) for r in retrieval.vector_topk(v, q, 4).collect()]
        assert [tuple(r) for r in retrieval.vector_topk(stored, q, 4, pivots).collect()] == want
        scored.append(retrieval.nearby(stored, q, 4, pivots).count() / len(data))
    print(f"fraction scored, spread {spread}: {max(scored):.3f}")
    assert max(scored) <= most
    every = [tuple(r) for r in retrieval.vector_topk(stored, data[0][1], 3000, pivots).collect()]
    assert every == [tuple(r) for r in retrieval.vector_topk(v, data[0][1], 3000).collect()]
    for odd in ([0.0] * 16, [1.0, 2.0]):
        assert [tuple(r) for r in retrieval.vector_topk(stored, odd, 4, pivots).collect()] == [
            tuple(r) for r in retrieval.vector_topk(v, odd, 4).collect()]
    assert retrieval.choose_pivots(v.limit(0)) == []
