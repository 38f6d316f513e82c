"""Pair operators (Jaccard join, decontamination), trained operators, pipeline."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shelfline.llm import components, crf, nbsvm, ngram_join, pipeline, spaced_seeds
from shelfline.llm.common import Scratch
from shelfline.llm.learning import auc
from shelfline.llm.queries import QUERIES

from tests.conftest import SMALL
from tests.llm.test_rows import DOC, EDGES, docs_of, edges

MID = "/root/testdata/sf0.01"

# ---- components, op10


def union_find(nodes, pairs):
    up = {n: n for n in nodes}
    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(4)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 700)]
    pairs += [(rng.randrange(1000, 1400), rng.randrange(1000, 1400)) for _ in range(250)] + [(5, 5)]
    nodes = {x for p in pairs if p[0] != p[1] for x in p}
    scratch = Scratch(spark, "test")
    got = components.components(spark.createDataFrame(pairs, "u long, v long"), scratch).collect()
    want = union_find(nodes, [p for p in pairs if p[0] != p[1]])
    assert {r.node: r.component for r in got} == want and len(got) == len(nodes)
    scratch.drop()
    assert components.components(spark.createDataFrame([], "u long, v long"), scratch).count() == 0


def shingle_set(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset([tuple(words)]) if len(words) < 5 else frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def jaccard_by_hand(rows):
    """(n, component) of each row; equal ids are one node."""
    sets = [(i, shingle_set(t)) for i, t in rows]
    links = []
    inverted = defaultdict(set)
    for k, (i, s) in enumerate(sets):
        if i is not None:
            for x in s:
                inverted[x].add(k)
    for k, (i, s) in enumerate(sets):
        if i is None:
            continue
        for j in {j for x in s for j in inverted[x]}:
            o = sets[j][1]
            if j > k and 100 * len(s & o) >= 80 * len(s | o):
                links.append((i, sets[j][0]))
    comp = union_find({i for i, _ in rows if i is not None}, links)
    return [(i, len(s), (comp[i] if i is not None else None)) for i, s in sets]


def check_join(spark, rows):
    df = spark.createDataFrame(rows, DOC).withColumn("n", F.lit("x")).withColumn("rep", F.lit(1))
    got = sorted(map(tuple, ngram_join.jaccard_classes(df).collect()), key=repr)
    assert got == sorted(jaccard_by_hand(rows), key=repr)


def test_join_query(spark):
    got = sorted(map(tuple, QUERIES["op10_ngram_join"](spark, SMALL).collect()))
    assert got == sorted(jaccard_by_hand(sorted(docs_of(spark).items())))


def test_join_edges(spark):
    check_join(spark, [*EDGES, (9, "ONE"), (20, "a b c d e f"), (21, "A B C D E F"), (22, "a b c d e"), (5, "other words of id five")])
    assert ngram_join.jaccard_classes(spark.createDataFrame([], DOC)).count() == 0


def test_join_near_copies_passages_and_thresholds(spark):
    """A large group of near copies with drifting edits, a passage that most
    documents share, and pairs exactly at and below the threshold."""
    rng = random.Random(8)
    word = lambda: "w%d" % rng.randrange(100_000)
    rows, k = [], 0
    base = [word() for _ in range(150)]
    for i in range(250):
        copy = list(base)
        for _ in range(rng.randrange(0, 8)):
            copy[rng.randrange(150)] = word()
        rows.append((k := k + 1, " ".join(copy)))
    passage = [word() for _ in range(60)]
    for i in range(250):
        rows.append((k := k + 1, " ".join([word() for _ in range(rng.randrange(5, 80))] + passage)))
    for n in (45, 46, 90, 135, 180):                    # n shared shingles of n + extra
        shared = [word() for _ in range(n + 4)]
        for extra in (n // 8 - 1, n // 8, n // 8 + 1, n // 4):
            for _ in range(2):
                rows.append((k := k + 1, " ".join(shared + [word() for _ in range(extra)])))
    rows += [(k + 1 + i, rows[0][1].upper()) for i in range(40)]
    rng.shuffle(rows)
    check_join(spark, rows)


def test_join_repeated_rows_below_the_threshold(spark):
    """Rows that occur twice, and ids with two texts, do not count an overlap
    more than once: pairs at J = 0.74 and 0.7 stay apart."""
    rng = random.Random(21)
    words = lambda n: ["w%d" % rng.randrange(10 ** 9) for _ in range(n)]
    rows, k = [], 0
    for shared, own in ((85, 15), (82, 18)):
        for case in range(8):
            passage, k = words(shared + 4), k + 10
            left, right = " ".join(passage + words(own)), " ".join(passage + words(own))
            rows += [(k, left), (k + 1, right)]
            if case % 4 == 0:                           # one side, or both, repeated
                rows += [(k, left)]
            elif case % 4 == 1:
                rows += [(k, left), (k + 1, right)]
            elif case % 4 == 2:                         # the same set in other letters
                rows += [(k, left.upper())]
            else:                                       # one id with two similar sets
                rows += [(k, " ".join(passage + words(own)))]
    check_join(spark, rows)


def test_prefix_and_bounds():
    for n in range(1, 400):
        p = ngram_join.prefix_length(n)
        assert n - p + 1 == -(-80 * n // 100)
    assert ngram_join.possible(10, 0, 10, 0) and not ngram_join.possible(10, 2, 10, 0)


# ---- op5


def test_decontamination_query(spark):
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    import regex
    words = lambda t: regex.findall(r"[\p{L}\p{M}\p{N}]+", (t or "").lower())
    items = {i: words(t) for i, t in bench}
    rows = QUERIES["op5_spaced_seeds"](spark, SMALL).collect()
    texts = docs_of(spark)
    assert len(rows) == len(texts)
    for r in rows:
        doc = words(texts[r.doc_id])
        joined = " " + " ".join(doc) + " "
        for i, w in items.items():
            if len(w) >= spaced_seeds.SPAN and f" {' '.join(w)} " in joined:
                assert r.contaminated and i in r.item_ids
        for i in r.item_ids:                            # every report has a real overlap
            w = items[i]
            best = max(sum(a == b for a, b in zip(doc[max(d, 0):d + len(w)], w[max(-d, 0):])) for d in range(-len(w), len(doc)))
            assert best >= 7


def test_decontamination_tolerates_substitutions(spark):
    rng = random.Random(2)
    item = ["b%d" % i for i in range(40)]
    def within(words, edits):
        words = list(words)
        for e in edits:
            words[e] = "x%d" % rng.randrange(10_000)
        return " ".join(["y%d" % rng.randrange(10_000) for _ in range(200)] + words + ["z"] * 20)
    rows = [(1, within(item, [])), (2, within(item, [3, 12, 25, 33])), (3, within(item[10:30], [])),
            (4, within(item[:5], [])), (5, within([], [])), (6, within([w.upper() + "," for w in item], [20])),
            (7, within(item[::3], [])), *[(i if i else None, t) for i, t in [(None, within(item, [])), (8, None), (9, "")]],
            (10, "z " * 30_000 + " ".join(item)), (1, within(item, []))]
    df = spark.createDataFrame(rows, DOC).withColumn("_tokens", F.lit(1)).withColumn("item_id", F.lit("k"))
    bench = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(item)), (3, None), (4, "short"), (None, "")], "item_id long, text string")
    kept = spaced_seeds.decontaminate(df, bench)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect())) == [4, 5, 7, 8, 9]
    empty = spark.createDataFrame([], "item_id long, text string")
    assert spaced_seeds.decontaminate(df, empty).count() == len(rows)
    assert spaced_seeds.decontaminate(spark.createDataFrame([], DOC), bench).count() == 0


def test_every_item_that_shares_a_passage_is_reported(spark):
    """Items with equal texts and items that share only some windows."""
    words = ["s%d" % i for i in range(40)]
    own = lambda k: " ".join("%s%d" % (k, i) for i in range(20))
    bench = spark.createDataFrame([(1, " ".join(words[:20])), (2, " ".join(words[:20])), (3, " ".join(words[:20]) + " " + own("p")),
                                   (4, own("q") + " " + " ".join(words[20:])), (5, own("r"))], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b " + " ".join(words[:20]) + " c"), (2, "d " + " ".join(words[20:])),
                                  (3, "e " + own("q")), (None, "f " + " ".join(words)), (4, "nothing")], DOC)
    rows = spaced_seeds.overlaps(docs, bench).collect()
    found = defaultdict(set)
    for r in rows:
        found[r.doc_id].add(r.item_id)
    assert found == {1: {1, 2, 3}, 2: {4}, 3: {4}, None: {1, 2, 3, 4}} and len(rows) == 9
    by = {(r.doc_id, r.item_id): r for r in rows}
    assert by[1, 1][3:] == by[1, 2][3:] and by[1, 1].first_token == 2 and by[1, 1].last_token == 22


def test_short_items_are_found_whole(spark):
    bench = spark.createDataFrame([(1, "What is the capital of Peru?"), (2, "Lima."), (3, "one two three four five six seven eight"),
                                   (4, "what is the CAPITAL of peru"), (5, " ".join("t%d" % i for i in range(9)))],
                                  "item_id long, text string")
    rows = [(1, "x y what is the capital of Peru"), (2, "Lima"), (3, "one two three four five six seven"),
            (4, "(one two three four five six seven eight)"), (5, "what is the capital of all Peru"), (6, "limas"), (7, None),
            (8, ""), (9, "zero one two three four five six seven eight nine ten " + " ".join("t%d" % i for i in range(9))),
            (10, "capital of peru, what is the")]
    docs = spark.createDataFrame(rows, DOC)
    found = defaultdict(set)
    for r in spaced_seeds.overlaps(docs, bench).collect():
        found[r.doc_id].add(r.item_id)
    assert found == {1: {1, 4}, 2: {2}, 4: {3}, 9: {3, 5}}
    assert sorted(r.doc_id for r in spaced_seeds.decontaminate(docs, bench).collect()) == [3, 5, 6, 7, 8, 10]


def test_decontamination_in_several_passes(spark, monkeypatch):
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    once = sorted(map(tuple, spaced_seeds.overlaps(docs, bench).collect()))
    monkeypatch.setattr(spaced_seeds, "BROADCAST_SEEDS", 700)
    assert sorted(map(tuple, spaced_seeds.overlaps(docs, bench).collect())) == once and once


# ---- op2, op6


def held_out_truth(spark, target):
    rows = spark.read.parquet(f"{MID}/labels.parquet").collect()
    return {r.doc_id: r[target] for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0}


@pytest.mark.parametrize("key,target,threshold,least", [("op2_nbsvm", "quality", 0.3, 0.95), ("op6_crf", "toxic", 0.5, 0.85)])
def test_held_out_accuracy(spark, key, target, threshold, least):
    rows = QUERIES[key](spark, MID).collect()
    assert len(rows) == spark.read.parquet(f"{MID}/documents.parquet").count()
    truth = held_out_truth(spark, target)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= threshold)
    known = [r for r in rows if r.doc_id in truth]
    assert auc([r.score for r in known], [truth[r.doc_id] for r in known]) >= least
    assert np.mean([r.predicted == truth[r.doc_id] for r in known]) >= 0.9


def test_scores_read_the_text_only_and_never_the_held_out_fold(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    flipped = labels.withColumn("quality", F.expr("if(crc32(string(doc_id)) % 5 = 0, 1 - quality, quality)"))
    a, b = (nbsvm.train_on(docs, x) for x in (labels, flipped))
    assert np.array_equal(a.weights, b.weights) and (a.slope, a.intercept) == (b.slope, b.intercept)


@pytest.mark.parametrize("module,score", [(nbsvm, nbsvm.quality_scores), (crf, crf.toxicity)])
def test_model_edges(spark, module, score):
    docs = spark.createDataFrame(EDGES, DOC)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(4, 1, 1), (6, 1, 1), (None, 0, 0), (7, None, None)], "doc_id long, quality int, toxic int")
    for labelled in (none, one):
        model = module.train_on(docs, labelled)
        assert score(docs, model).count() == len(EDGES)
    mixed = spark.createDataFrame([(i, i % 2, i % 2) for i in range(1, 9)], "doc_id long, quality int, toxic int")
    model = module.train_on(docs, mixed)
    assert score(edges(spark), model).count() == len(EDGES)
    assert score(spark.createDataFrame([], DOC), model).count() == 0


def test_forward_backward_against_enumeration():
    from itertools import product
    rng = np.random.default_rng(3)
    emit, trans = rng.normal(size=(3, 5)), rng.normal(size=(2, 2))
    lengths = np.array([5, 3, 1])
    mask = np.arange(5)[None] < lengths[:, None]
    marginal, pairs = crf.forward_backward(emit, mask, trans, pairs=True)
    want_pairs = np.zeros((2, 2))
    for r, n in enumerate(lengths):
        weights = {s: np.exp(sum(emit[r, t] * s[t] for t in range(n)) + sum(trans[a, b] for a, b in zip(s, s[1:])))
                   for s in product((0, 1), repeat=int(n))}
        z = sum(weights.values())
        for t in range(n):
            assert marginal[r, t] == pytest.approx(sum(w for s, w in weights.items() if s[t]) / z)
        for s, w in weights.items():
            for a, b in zip(s, s[1:]):
                want_pairs[a, b] += w / z
    assert np.allclose(pairs, want_pairs) and not marginal[~mask].any()


def test_toxic_spans():
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("abcdefghij", k=5))
    texts, y = [], []
    for i in range(300):
        words = [word() + ("." if rng.random() < 0.1 else "") for _ in range(60)]
        bad = i % 4 == 0
        for _ in range(3 * bad):
            words[rng.randrange(60)] = rng.choice(["vilest!", "Horrid", "grotmok", "grotsil", "grotpan"])
        texts.append(" ".join(words))
        y.append(int(bad))
    model = crf.train(texts[:240], np.array(y[:240]))
    got = model.of([*texts[240:], "quiet words only.", "a Horrid grotnew thing,\n vilest of all", "", None])
    assert [int(s >= 0.5) for s, _ in got] == [*y[240:], 0, 1, 0, 0]
    text = "a Horrid grotnew thing,\n vilest of all"
    spans = crf.spans_of(text, got[61][1])
    assert [text[s["start"]:s["end"]] for s in spans] == ["Horrid", "grotnew", "vilest"]


def test_unlinked_classes_of_one_shingle_make_few_pairs_a_round(spark, monkeypatch):
    """Many sets share their first shingles, of sizes and places that do not rule a link
    out, and few link: rounds make pairs in proportion to the classes, and the
    components are exact."""
    rng = random.Random(6)
    common = "the first five words stay common to all of these rows".split()
    rows = []
    for i in range(90):
        own = [f"w{i}x{j}" for j in range(12)]
        rows.append((i, " ".join(common + own)))
        if i % 9 == 0:
            rows.append((1000 + i, " ".join(common + own + ["more"])))
    counts, real = [], ngram_join._across

    def counted(alive, centres, compared):
        out = real(alive, centres, compared)
        counts.append((out.count(), alive.select("rep").distinct().count()))
        return out
    monkeypatch.setattr(ngram_join, "_across", counted)
    monkeypatch.setattr(ngram_join, "CENTRES", 2)
    monkeypatch.setattr(ngram_join, "_POSSIBLE", "true")       # nothing is ruled out by size and place
    rng.shuffle(rows)
    got = sorted(map(tuple, ngram_join.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert got == sorted(jaccard_by_hand(rows))
    shingles = len(common) - 4
    assert all(n <= (2 << turn) * shingles * k for turn, (n, k) in enumerate(counts))


def test_dual_coordinate_descent_reaches_the_optimum():
    """The primal value of its weights equals the dual optimum of a plain projected
    gradient; the bias is a weight like any other."""
    rng = np.random.default_rng(3)
    for trial in range(4):
        n, size = 50, 12
        rows = [np.sort(rng.choice(size, rng.integers(1, 6), replace=False)) for _ in range(n)]
        values = [rng.normal(size=len(r)) for r in rows]
        y = (rng.random(n) < 0.4).astype(int)
        c = np.where(y == 1, 0.8, 0.5)
        w, bias = nbsvm.dual_coordinate_descent(rows, values, y, size, c, 2000)
        x = np.zeros((n, size + 1))
        for i, (r, v) in enumerate(zip(rows, values)):
            x[i, r] = v
        x[:, -1] = 1
        sign = np.where(y == 1, 1.0, -1.0)
        primal = 0.5 * (w @ w + bias * bias) + c @ np.maximum(0, 1 - sign * (x @ np.r_[w, bias]))
        q = (sign[:, None] * x) @ (sign[:, None] * x).T
        alpha, rate = np.zeros(n), 1 / np.linalg.eigvalsh(q)[-1]
        for _ in range(20_000):
            alpha = np.clip(alpha - rate * (q @ alpha - 1), 0, c)
        dual = alpha.sum() - 0.5 * alpha @ q @ alpha
        assert primal == pytest.approx(dual, rel=2e-3) and primal >= dual - 1e-6


def test_log_count_ratios_by_hand():
    rows = [np.array(r, np.int32) for r in ([1, 2], [1, 3], [1], [2, 3], [3], [3])]
    y = np.array([1, 1, 1, 0, 0, 0])
    got = nbsvm.log_count_ratio(rows, y)
    size, s = 1 << nbsvm.BITS, nbsvm.SMOOTH
    counts = {1: (3, 0), 2: (1, 1), 3: (1, 3)}
    total = 5 + s * size, 4 + s * size
    for f, (p, q) in counts.items():
        want = np.log((p + s) / total[0]) - np.log((q + s) / total[1]) if p + q >= nbsvm.MIN_DOCUMENTS else 0
        assert got[f] == pytest.approx(want)
    assert np.count_nonzero(got) <= 3


# ---- pipeline


def test_pipeline_stages(spark):
    """Each stage on the output of the one before, against brute force."""
    from pyspark.sql import Row  # noqa: F401
    base = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secrets", "packing"]
    docs = base
    outs = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL).cache()
        assert docs.columns == base.columns
        outs.append({r.doc_id: r for r in docs.collect()})
    tox, near, clean, masked = outs
    before = {r.doc_id: r for r in base.collect()}
    model = crf.train_on(base, spark.read.parquet(f"{SMALL}/labels.parquet"))
    scores = {i: s for (i, r), (s, _) in zip(before.items(), model.of([r.text for r in before.values()]))}
    assert set(tox) == {i for i, s in scores.items() if s < 0.5}
    assert set(near) == {i for i, _, c in jaccard_by_hand([(i, r.text) for i, r in tox.items()]) if i == c}
    bad = {r.doc_id for r in spaced_seeds.overlaps(base, spark.read.parquet(f"{SMALL}/benchmark.parquet")).collect()}
    assert set(clean) == set(near) - bad
    assert set(masked) == set(clean)
    from shelfline.llm.token_efficiency import encoder, masked as mask
    for i, r in masked.items():
        assert r.text == mask(clean[i].text, encoder())
        assert r.n_chars == (len(r.text) if r.text != clean[i].text else clean[i].n_chars)
    from tests.llm.test_rows import placed
    placed(corpus_pipeline.run(spark, SMALL).collect(), {i: r.text for i, r in masked.items()})


def test_pipeline_edges(spark, tmp_path):
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(i, t, None, None, None) for i, t in EDGES]
    for k, content in enumerate((rows, [])):
        d = str(tmp_path / str(k))
        spark.createDataFrame(content, columns).write.parquet(f"{d}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
        spark.createDataFrame([], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
        got = pipeline.run(spark, d).collect()
        # ids 5, 5, 6 are one text: one row stays
        assert len({(r.doc_id, r.start) for r in got}) == len(got)
        assert {r.doc_id for r in got} == ({1, 2, 3, None, 4, 5, 7, 8} if content else set())


@pytest.mark.parametrize("broadcast", [0, 1_000_000])
def test_pipeline_keeps_unlinked_texts_of_one_id(spark, monkeypatch, broadcast):
    """Rows of one doc_id stay apart where their texts do not link, whichever way
    the ids are joined; equal rows are one."""
    monkeypatch.setattr(ngram_join, "BROADCAST_IDS", broadcast)
    text = lambda k: " ".join(f"w{k}x{i}" for i in range(60))
    rows = [(5, text(1)), (5, text(2)), (5, text(2)), (3, text(1)), (9, text(2) + " more"), (8, text(3)), (None, text(3)),
            (6, None), (6, ""), (6, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("rep", F.lit("clash"))
    got = pipeline.near_duplicates(spark, docs, None)
    assert got.columns == docs.columns
    first = min(text(1), text(2), key=lambda t: hashlib.sha256(t.encode()).digest())    # the text that goes by id 5
    second = (5, text(2)) if first == text(2) else (9, text(2) + " more")
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == sorted(
        [(3, text(1)), (8, text(3)), second, (None, text(3)), (6, None)], key=repr)


def test_the_sample_is_bounded_in_rows(spark):
    """One labelled id on very many rows adds one row; long texts are whole."""
    from shelfline.llm.common import fold_of
    from shelfline.llm.learning import labelled_sample
    ids = [r.id for r in spark.range(60).where(fold_of(F.col("id")) != 0).collect()]
    docs = spark.range(3000).select(F.lit(ids[0]).alias("doc_id"), F.concat(F.lit("t"), F.col("id") % 3).alias("text"))
    docs = docs.unionByName(spark.createDataFrame([(i, "x" * 500_000) for i in ids[1:]], docs.schema))
    marks = spark.createDataFrame([(i, 1, 0) for i in ids] * 2, "doc_id long, quality int, toxic int")
    for most in (1, 20, 1000):
        got = labelled_sample(docs, marks, "quality", most).collect()
        assert len(got) == min(most, len(ids)) == len({r.doc_id for r in got})
    assert {len(r.text) for r in got} == {2, 500_000}
