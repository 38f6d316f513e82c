"""Hand-made edge rows (FIXTURES.md part C) and brute-force cross-checks."""

import datetime as dt
import math
import os
import tempfile
from decimal import Decimal

import numpy as np
from pyspark.sql import functions as F

from shelfline.functions import columns as C
from shelfline.operators import evals, grid, inventory, memory, metrics, retrieval, text, traces
from shelfline.operators.ids import sequential_ids
from shelfline.operators.windows import trailing_weeks
from shelfline.sources import views as V
from shelfline.streaming import sync

SAT0 = dt.date(2001, 1, 6)  # a Saturday


def _weeks(spark, n):
    return spark.createDataFrame([(SAT0 + dt.timedelta(days=7 * i),) for i in range(n)],
                                 "week_ending date")


def test_inclusive_trailing_window(spark):
    assert trailing_weeks(_weeks(spark, 20), "week_ending", 13).count() == 14
    assert trailing_weeks(_weeks(spark, 30), "week_ending", 26).count() == 27


def test_kpi_on_empty_window_defaults_to_zero(spark):
    empty = spark.createDataFrame([], "week_ending date, pos_revenue decimal(18,2), units_sold bigint")
    row = metrics.kpi_sums(empty, 13).collect()[0]
    assert row["revenue"] == 0.0 and row["units"] == 0


def test_week_ending_boundaries(spark):
    df = spark.createDataFrame([(dt.date(2001, 11, 4),), (dt.date(2001, 11, 3),)], "d date")
    got = [r[0] for r in df.select(C.week_ending("d")).collect()]
    assert got == [dt.date(2001, 11, 10), dt.date(2001, 11, 3)]


def test_zero_shipped_gives_null_sell_through(spark):
    df = spark.createDataFrame([(5, 0), (3, 4)], "sold bigint, shipped bigint")
    got = [r[0] for r in df.select(C.safe_ratio("sold", "shipped", 3)).collect()]
    assert got == [None, 0.75]


def test_zero_spend_gives_zero_roi(spark):
    df = spark.createDataFrame([(4.0, 10.0, Decimal("0.05"), Decimal("0.00")),
                                (0.0, 10.0, Decimal("0.05"), Decimal("5.00"))],
                               "incr double, qty double, disc decimal(4,2), spend decimal(18,2)")
    got = [r[0] for r in df.select(V.promo_roi_value("incr", "qty", "disc", "spend")).collect()]
    assert got == [Decimal("0.000"), Decimal("-1.000")]


def test_zero_sold_weeks_of_supply(spark):
    df = spark.createDataFrame([(40, 0), (40, 8)], "on_hand bigint, sold bigint")
    got = [float(r[0]) for r in df.select(inventory.weeks_of_supply("on_hand", "sold")).collect()]
    assert got == [40.0, 5.0]


def test_top_k_tie_takes_lowest_key(spark):
    sales = spark.createDataFrame([(1, Decimal("10.00")), (2, Decimal("10.00")), (3, Decimal("10.00"))],
                                  "retailer_id long, pos_revenue decimal(18,2)")
    rets = spark.createDataFrame([(1, "c"), (2, "a"), (3, "b")], "retailer_id long, retailer_name string")
    got = [r[0] for r in metrics.top_retailers(sales, rets, 2).collect()]
    assert got == ["a", "b"]


def _log(spark, rows):
    return spark.createDataFrame(
        [(u, k, v, op, dt.datetime(2024, 1, 1, 0, 0, ts), seq) for u, k, v, op, ts, seq in rows],
        "user_id string, key string, value_json string, op string, ts timestamp_ntz, seq long")


def test_latest_wins_put_delete_put(spark):
    log = _log(spark, [("u", "k", '{"v": 1}', "put", 1, 1), ("u", "k", None, "delete", 2, 2),
                       ("u", "k", '{"v": 3}', "put", 3, 3),
                       ("u", "gone", '{"v": 1}', "put", 1, 4), ("u", "gone", None, "delete", 2, 5),
                       ("u", "tie", '{"v": "a"}', "put", 5, 1), ("u", "tie", '{"v": "b"}', "put", 5, 2)])
    live = {r["key"]: r["value_json"] for r in memory.live_memories(log).collect()}
    assert live == {"k": '{"v": 3}', "tie": '{"v": "b"}'}


def test_memory_value_must_be_object(spark):
    log = _log(spark, [("u", "a", "[1]", "put", 1, 1), ("u", "b", '"x"', "put", 1, 2),
                       ("u", "c", "{bad", "put", 1, 3), ("u", "d", '{"ok": true}', "put", 1, 4)])
    got = {r["key"]: (r["is_valid"], r["reason"]) for r in memory.json_validate(log).collect()}
    assert got == {"a": (False, "not a JSON object"), "b": (False, "not a JSON object"),
                   "c": (False, "invalid JSON"), "d": (True, None)}


def test_seed_if_absent_is_idempotent(spark):
    chat = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "hello"),
                                  (2, 0, "system", "sys")],
                                 "session_id long, turn long, role string, content string")
    first = memory.seed_if_absent(chat)
    assert [r["session_id"] for r in first.collect()] == [1]
    again = memory.seed_if_absent(chat.unionByName(first))
    assert again.count() == 0


def test_orphan_span_depth_zero_and_cycles_null(spark):
    spans = spark.createDataFrame(
        [("t", 1, None), ("t", 2, 1), ("t", 3, 2), ("t", 4, 99),   # 4 is an orphan
         ("c", 1, 2), ("c", 2, 1)],                                # a cycle
        "trace_id string, span_id long, parent_id long")
    got = {(r["trace_id"], r["span_id"]): r["depth"]
           for r in traces.span_depth(spans).collect()}
    assert got == {("t", 1): 0, ("t", 2): 1, ("t", 3): 2, ("t", 4): 0, ("c", 1): None, ("c", 2): None}


def test_deep_chain_depth(spark):
    n = 10_000
    spans = spark.createDataFrame([("t", i, i - 1 if i else None) for i in range(n)],
                                  "trace_id string, span_id long, parent_id long")
    got = {r["span_id"]: r["depth"] for r in traces.span_depth(spans).collect()}
    assert got == {i: i for i in range(n)}


def test_verdicts(spark):
    a = spark.createDataFrame([("t1", "s", "Yes "), ("t2", "s", "1.0"), ("t3", "s", "FAIL"),
                               ("t4", "s", "maybe"), ("t5", "s", None)],
                              "trace_id string, name string, value string")
    got = {r["trace_id"]: r["verdict"] for r in evals.verdict_normalize(a).collect()}
    assert got == {"t1": "pass", "t2": "pass", "t3": "fail", "t4": "other"}
    rate = evals.eval_pass_rates(a).collect()[0]
    assert (rate["pass"], rate["fail"], rate["other"], rate["pass_rate"]) == (2, 1, 1, 0.5)


def test_sequential_ids_dense_and_ordered(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("k"))
    got = sequential_ids(df, ["k"], "rid", partitions=7).orderBy("k").collect()
    assert [r["rid"] for r in got] == list(range(1, 1001))


def test_sync_second_run_appends_nothing(spark):
    base = tempfile.mkdtemp(prefix="sync-test-")
    docs = spark.createDataFrame([(i, "t", "en", f"doc {i}") for i in range(1, 41)],
                                 "doc_id long, doc_type string, category string, content string")
    index = sync.docs_index_sync(spark, *sync.snapshots(docs), base)
    _, new = sync.snapshots(docs)
    assert sorted(map(tuple, index.state().collect())) == sorted(map(tuple, new.collect()))
    assert index.store.rows_in() == 36 + 12
    assert sync.sync_once(index, os.path.join(base, "changes"), os.path.join(base, "_checkpoint")) == 0


def test_change_feed_kinds(spark):
    docs = spark.createDataFrame([(i, "t", "en", f"doc {i}") for i in range(1, 31)],
                                 "doc_id long, doc_type string, category string, content string")
    old, new = sync.snapshots(docs)
    kinds = {r["doc_id"]: r["change_type"] for r in sync.docs_change_feed(spark, old, new).collect()}
    assert kinds == {10: "insert", 20: "insert", 30: "insert", 1: "delete", 11: "delete",
                     21: "delete", 2: "update", 12: "update", 22: "update"}


def _brute_topk(vecs, q, k):
    out = []
    for doc_id, v in vecs:
        v = np.asarray(v, dtype=float)
        s = float(v @ q / (np.linalg.norm(v) * np.linalg.norm(q)))
        out.append((-round(s, 6), doc_id))
    return [d for _, d in sorted(out)[:k]]


def test_vector_batch_blocks_agree_with_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(7)
    vecs = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(200)]
    docs = spark.createDataFrame([(i, v, i % 3) for i, v in vecs],
                                 "doc_id long, embedding array<float>, label int").repartition(5)
    queries = spark.createDataFrame([(q, vecs[q][1]) for q in (0, 5, 9)],
                                    "qid long, qvec array<float>")
    expect = {q: _brute_topk(vecs, np.asarray(vecs[q][1], dtype=float), 4) for q in (0, 5, 9)}

    def ranked(df):
        got = {}
        for r in df.orderBy("qid", "rank").collect():
            got.setdefault(r["qid"], []).append(r["doc_id"])
        return got

    assert ranked(retrieval.vector_topk_batch(spark, docs, queries, 4)) == expect
    monkeypatch.setattr(retrieval, "QUERY_BLOCK", 2)
    monkeypatch.setattr(retrieval, "DOC_BLOCK", 7)
    assert ranked(retrieval.vector_topk_batch(spark, docs, queries, 4)) == expect


def test_text_search_matches_brute_force(spark):
    texts = ["red apple pie", "apple apple tart", "green pear", "red red red", "pie, apple!"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, content string")
    q = spark.createDataFrame([("apple",), ("red",)], "term string")
    got = [(r["doc_id"], r["score"]) for r in text.text_search(docs, q, 3).collect()]
    n = len(texts)
    toks = [t.replace(",", " ").replace("!", " ").split() for t in texts]
    dfreq = {t: sum(t in d for d in toks) for t in ("apple", "red")}
    scores = [(i, sum(d.count(t) * math.log(n / dfreq[t]) for t in dfreq)) for i, d in enumerate(toks)]
    scores = sorted([(-round(s, 6), i) for i, s in scores if s > 0])[:3]
    assert got == [(i, -s) for s, i in scores]


def test_fact_coverage_matches_brute_force(spark):
    facts = spark.createDataFrame([(1, "Quick brown"), (2, "lazy dog."), (3, "zebra"), (4, "...")],
                                  "item_id long, text string")
    answers = spark.createDataFrame([(10, "The quick, brown fox"), (11, "a lazy dog and a zebra"),
                                     (12, "quickbrown"), (13, "nothing")], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_facts_found"], r["coverage"])
           for r in evals.fact_coverage(facts, answers).collect()}
    assert got == {10: (1, round(1 / 3, 6)), 11: (2, round(2 / 3, 6)), 12: (0, 0.0), 13: (0, 0.0)}


def test_sales_grid_fills_gaps(spark):
    s = spark.createDataFrame([(1, 1, SAT0, 5), (1, 1, SAT0 + dt.timedelta(days=21), 7)],
                              "product_id long, retailer_id long, week_ending date, units_sold bigint")
    got = [(r["week"], r["units_sold"]) for r in grid.sales_grid(s).orderBy("week").collect()]
    assert [u for _, u in got] == [5, 0, 0, 7]


def test_delta_stream_waits_for_all_parts(spark):
    from shelfline.streaming import deltas as D
    base = tempfile.mkdtemp(prefix="deltas-test-")
    ev_dir, ck = (os.path.join(base, p) for p in ("events", "_ck"))
    items = D.Items(spark, os.path.join(base, "items"))
    rows = [("a", 0, D.DELTA, "hello"), ("a", 2, D.DELTA, "world"), ("b", 0, D.DELTA, "solo")]
    late = [("a", 1, D.DELTA, "big")]
    done = [("a", 3, D.DONE, None), ("b", 1, D.DONE, None)]
    for batch in (rows, done, late):       # done for "a" arrives before its last part
        spark.createDataFrame(batch, D.EVENT_SCHEMA).write.mode("append").parquet(ev_dir)
        D.assemble_stream(items, ev_dir, ck)
        got = {r["item_id"]: r["text"] for r in items.finished().collect()}
        if batch is done:
            assert got == {"b": "solo"}
    assert got == {"a": "hello big world", "b": "solo"}


def test_seed_rows_and_namespace(spark):
    from shelfline.sources import seed, sinks
    packs = seed.pack_variants(spark)
    assert packs.groupBy("pack_family").count().count() == 3 and packs.count() == 12
    sinks.ensure_namespace(spark, "shelfline_test_ns")
    sinks.ensure_namespace(spark, "shelfline_test_ns")  # idempotent
    assert "shelfline_test_ns" in [d.name for d in spark.catalog.listDatabases()]


def test_write_audit_counts_in_same_job(spark):
    from shelfline.sources import sinks
    path = os.path.join(tempfile.mkdtemp(prefix="write-test-"), "t")
    df = spark.createDataFrame([("2024-01-0%d" % i, i) for i in range(1, 6)], "d string, v int")
    audit = sinks.write_audit(df, "days", path, dates=("d",))
    assert [tuple(r) for r in audit.collect()] == [("days", 5)]
    back = spark.read.parquet(path)
    assert dict(back.dtypes)["d"] == "date" and back.count() == 5


def test_dashboard_json_orders_labels(spark):
    import json
    from shelfline.plans.dashboard import KPI_KEYS, KPI_LABELS, dashboard_json
    rows = [("kpis", i + 1, k, float(v)) for i, (k, v) in enumerate(zip(KPI_KEYS, (1234567, 2345, 12, 3, 1000)))]
    rows += [("revenue_trend", 2, "2024-01-13", 2.0), ("revenue_trend", 1, "2024-01-06", 12345678901.0), ("roi_by_type", 1, "B\"O", -0.125),
             ("roi_counts", 1, "B\"O", 7.0), ("share_by_brand", 1, "x", 9.5)]
    got = dashboard_json(spark.createDataFrame(rows, "tile string, ord int, label string, value double").repartition(3)).collect()
    assert len(got) == 1 and json.loads(got[0]["payload"]) == {
        "kpis": [{"label": a, "value": b} for a, b in zip(KPI_LABELS, ("$1,234,567", "2,345", "12", "3", "1000"))],
        "revenue_trend": {"labels": ["2024-01-06", "2024-01-13"], "values": [12345678901, 2]},
        "roi_by_type": {"labels": ["B\"O"], "avg_roi": [-0.125], "counts": [7]},
        "sales_by_category": {"labels": [], "values": []}, "top_retailers": {"labels": [], "values": []},
        "share_by_brand": {"labels": ["x"], "values": [9.5]}}


def test_rejected_put_keeps_previous_value(spark):
    log = _log(spark, [("u", "k", '{"v": 1}', "put", 1, 1), ("u", "k", "[2]", "put", 2, 2),
                       ("u", "k", "{oops", "put", 3, 3), ("u", "only_bad", '"x"', "put", 1, 4)])
    live = {r["key"]: r["value_json"] for r in memory.live_memories(log).collect()}
    assert live == {"k": '{"v": 1}'}


def test_model_rebuilds_a_missing_table(spark):
    from shelfline.plans.model import Model
    from tests.conftest import SMALL
    m = Model(spark, SMALL)
    n = m.promotions().count()
    folder = m._entry("promotions")["parts"][0]
    m.files.delete(folder)                              # removed from outside
    again = Model(spark, SMALL)
    assert again.promotions().count() == n and again.made == ["promotions"]


def test_python_operators_work_from_another_working_directory():
    """Executor Python workers must import the package even when the driver
    runs elsewhere (the package is shipped with addPyFile)."""
    import subprocess
    import sys
    from tests.conftest import ROOT, SMALL
    code = (
        "import sys; sys.path.insert(0, %r)\n"
        "from pyspark.sql import SparkSession\n"
        "s = (SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false')"
        ".config('spark.sql.shuffle.partitions', '2').getOrCreate())\n"
        "import __spark_entry__ as E\n"
        "print('ROWS', E.queries()['vector_topk_batch'](s, %r).count())\n" % (ROOT, SMALL))
    out = subprocess.run([sys.executable, "-c", code], cwd=tempfile.mkdtemp(prefix="cwd-test-"),
                         capture_output=True, text=True, timeout=600)
    assert "ROWS 50" in out.stdout, out.stderr[-2000:]


def test_terms_of_every_script(spark):
    """Accents, Cyrillic, CJK and marks stay; query and memory share a tokeniser."""
    from shelfline.functions import columns as C
    rows = spark.createDataFrame([("Crème BRÛLÉE, 2x!",), ("Привет, мир",), ("価格 表。比較",), ("किताब-घर",), ("",), (None,)], "t string")
    got = [[x for x in r[0] if x] if r[0] is not None else None for r in rows.select(C.terms("t")).collect()]
    assert got == [["crème", "brûlée", "2x"], ["привет", "мир"], ["価格", "表", "比較"], ["किताब", "घर"], [], None]
    facts = spark.createDataFrame([(1, "crème brûlée"), (2, "ПРИВЕТ"), (3, "比較")], "item_id long, text string")
    answers = spark.createDataFrame([(10, "Une Crème Brûlée."), (11, "привет мир"), (12, "価格 比較"), (13, "creme brulee")],
                                    "doc_id long, text string")
    assert {r["doc_id"]: r["n_facts_found"] for r in evals.fact_coverage(facts, answers).collect()} == \
        {10: 1, 11: 1, 12: 1, 13: 0}
    log = _log(spark, [("u", "a", '{"v": "purchase"}', "put", 1, 1), ("u", "b", '{"v": "Ünique click"}', "put", 2, 2)])
    def scores(query):
        return {r["key"]: r["score"] for r in memory.memory_search(log, "u", query, 5).collect()}
    assert scores("Purchase, click?") == {"a": 1, "b": 1} and scores("ÜNIQUE") == {"a": 0, "b": 1}


def test_every_scorer_survives_with_its_last_value(spark):
    import json
    a = spark.createDataFrame([("t", 0, "quality", "1"), ("t", 1, "tone", "No "), ("t", 2, "x\"y", "maybe"), ("t", 3, "quality", " Fail"),
                               ("t", 4, "quality", None), ("u", 0, "tone", "yes"), ("u", 1, "quality", None), ("v", 0, "tone", None)],
                              "trace_id string, seq long, name string, value string").repartition(3)
    got = {r["trace_id"]: (r["n_scorers"], json.loads(r["scores"])) for r in evals.eval_by_trace(a).collect()}
    assert got == {"t": (3, {"quality": "fail", "tone": "no", 'x"y': "maybe"}), "u": (1, {"tone": "yes"})}


def test_message_parts_concatenate(spark):
    schema = "session_id long, turn long, role string, parts array<struct<type:string,text:string>>"
    chat = spark.createDataFrame([(1, 0, "assistant", [("text", "old")]),
                                  (1, 1, "assistant", [("output_text", "a "), ("tool", "no"), ("text", "b"), ("text", None)]),
                                  (1, 2, "user", [("text", "q")]), (2, 0, "assistant", [])], schema)
    got = {r["session_id"]: (r["turn"], r["content"]) for r in traces.last_assistant_message(chat).collect()}
    assert got == {1: (1, "a b"), 2: (0, "")}


def test_repeated_parts_and_no_item_is_given_up(spark):
    """Parts come twice, late and after the done event; a replayed batch and events of
    a finished item change nothing; open parts stay however many runs pass."""
    from shelfline.streaming import deltas as D
    base = tempfile.mkdtemp(prefix="deltas-test-")
    ev_dir, ck = (os.path.join(base, p) for p in ("events", "_ck"))
    items = D.Items(spark, os.path.join(base, "items"), buckets=3)
    batches = [[("a", 0, D.DELTA, "x"), ("a", 0, D.DELTA, "x"), ("a", 2, D.DONE, None), ("n", 0, D.DELTA, "never"),
                ("e", 0, D.DONE, None), ("o", 0, D.DELTA, "open"), ("o", 5, "other", "?")],
               [("a", 1, D.DELTA, "y")], [("a", 1, D.DELTA, "late"), ("a", 2, D.DONE, None)],
               [("n", 1, D.DONE, None), ("b", 0, D.DELTA, "z"), ("b", 1, D.DONE, None)]]
    for batch in batches:
        spark.createDataFrame(batch, D.EVENT_SCHEMA).coalesce(1).write.mode("append").parquet(ev_dir)
        D.assemble_stream(items, ev_dir, ck)
    want = [("a", "x y"), ("b", "z"), ("e", ""), ("n", "never")]
    assert sorted((r["item_id"], r["text"]) for r in items.finished().collect()) == want
    assert [(r["item_id"], r["text"]) for r in items.open_parts().collect()] == [("o", "open")]
    items.take(spark.createDataFrame(batches[3], D.EVENT_SCHEMA), ck, 3)          # replayed
    items.take(spark.createDataFrame(batches[0][:1], D.EVENT_SCHEMA), ck, 4)      # an event of a finished item
    assert sorted((r["item_id"], r["text"]) for r in items.finished().collect()) == want
    once = traces.assemble_deltas(spark.createDataFrame(batches[0] + batches[1], D.EVENT_SCHEMA))
    assert {r["item_id"]: r["text"] for r in once.collect()} == {"a": "x y", "n": "never", "o": "open"}


def test_null_and_odd_vectors_score_nothing(spark):
    docs = spark.createDataFrame([(1, [1.0, 0.0], 0), (2, None, 0), (3, [1.0], 1), (4, [0.0, 0.0], 0)],
                                 "doc_id long, embedding array<float>, label int")
    queries = spark.createDataFrame([(7, [1.0, 1.0]), (8, None)], "qid long, qvec array<float>")
    got = [(r["qid"], r["doc_id"]) for r in retrieval.vector_topk_batch(spark, docs, queries, 3).collect()]
    assert got == [(7, 1)]


def test_defaults_and_id_chain(spark):
    items = spark.createDataFrame([(1, "s", "t", None), (2, "s", "t", "closed")], "id long, session_id string, title string, status string")
    items = items.withColumn("created_ts", F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz"))
    assert [r["status"] for r in memory.action_items_defaults(items).orderBy("item_id").collect()] == ["open", "closed"]
    ids = spark.createDataFrame([(1, "u.1", "e", "s"), (2, None, "a.b@c.d", "s"), (3, None, None, "s"), (4, None, None, None)],
                                "seq long, user_id string, email string, session_id string")
    assert [r["namespace"] for r in memory.resolve_ids(ids).orderBy("seq").collect()] == [
        "user_memories/u-1", "user_memories/a-b@c-d", "user_memories/s", "user_memories/default_user"]


def test_season_rule_and_unit_clamps(spark):
    months = spark.createDataFrame([("Beverages", 7), ("Beverages", 1), ("Beverages", 4), ("Snacks", 12), ("Snacks", 7), (None, 7)],
                                   "f string, m int")
    assert [float(r[0]) for r in months.select(grid.season_factor("f", "m")).collect()] == [1.25, 0.9, 1.0, 1.2, 1.0, 1.0]
    sales = spark.createDataFrame([(1, 1, SAT0, 10, 4), (1, 2, SAT0, 3, 9), (1, 3, SAT0, 7, 0)],
                                  "product_id long, retailer_id long, week_ending date, units_shipped bigint, units_sold bigint")
    got = [(r["units_left"], r["weeks_left"]) for r in grid.clamped_units(sales).orderBy("retailer_id").collect()]
    assert got == [(6, 1.5), (0, 0.0), (7, 7.0)]
