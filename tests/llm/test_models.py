"""Classifiers (held-out accuracy) and neighbour search (brute force)."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strata.llm import bin_slack, centroid_langid, covering_simhash, nbsvm, nn_descent
from strata.llm.common import BATCH_BYTES
from strata.llm.queries import QUERIES, held_out

DATA = "/root/testdata/sf0.01"


def test_language_of_held_out_documents(spark):
    found = QUERIES["op7_nearest_centroid"](spark, DATA).join(spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang"), "doc_id")
    rows = found.filter("held_out").collect()
    assert len(rows) > 250 and np.mean([r.lang == r.lang_pred for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)
    assert found.filter("rejected").count() < 0.01 * found.count()


def test_language_odd_documents(spark, odd_docs):
    rows = centroid_langid.identify(odd_docs, ~held_out(), keep=odd_docs.columns).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        nothing = not any(c.isalpha() for c in r.text or "")
        assert (r[odd_docs.columns.__len__()] == "und") == nothing
    kept = centroid_langid.keep_known(odd_docs, ~held_out())
    assert kept.columns == odd_docs.columns and kept.filter("text IS NULL OR text = ''").count() == 0
    empty = odd_docs.limit(0)
    assert centroid_langid.identify(empty, ~held_out(), keep=["doc_id"]).count() == 0
    assert centroid_langid.keep_known(empty, ~held_out()).count() == 0


def test_a_foreign_script_is_rejected(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang")
    foreign = "съешь же ещё этих мягких французских булок да выпей чаю " * 4
    odd = spark.createDataFrame([(-5, foreign, None)], "doc_id long, text string, lang string")
    rows = centroid_langid.identify(docs.unionByName(odd), F.col("doc_id") >= 0, keep=["doc_id"])
    assert rows.filter("doc_id = -5").first().rejected


def test_texts_go_to_python_in_small_batches(spark):
    import pyarrow as pa

    def largest(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])

    text = F.concat(F.repeat(F.lit("a few words "), 2000), F.col("id").cast("string"))
    docs = spark.range(0, 1000, 1, 1).select(F.col("id").alias("doc_id"), text.alias("text"), F.lit("en").alias("lang"))  # 24 MB
    none = centroid_langid.Model(np.ones(1 << centroid_langid.BITS), [], np.zeros((0, 1 << centroid_langid.BITS), np.float32))
    steps = [
        lambda: centroid_langid.predict(docs, none, "text"),
        lambda: centroid_langid.document_frequencies(docs.select("text").limit(1)),
        lambda: bin_slack.pieces(docs, "{}"),
        lambda: covering_simhash.with_fingerprint(docs, "text", "print"),
    ]
    for step in steps:
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
        step()
        assert docs.mapInArrow(largest, "n long").agg(F.max("n")).first()[0] < 1.5 * BATCH_BYTES
    told = steps[0]().agg(F.count("text"), F.countDistinct("doc_id", "text"), F.max("lang_pred")).first()
    assert tuple(told) == (1000, 1000, "und")


def test_quality_of_held_out_documents(spark):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    found = QUERIES["op6_nbsvm"](spark, DATA).join(labels, "doc_id").filter("held_out").collect()
    assert len(found) > 80 and np.mean([r.predicted == r.quality for r in found]) > 0.95
    high = [r.score for r in found if r.quality == 1]
    low = [r.score for r in found if r.quality == 0]
    assert np.mean([a > b for a in high for b in low]) > 0.97


def test_quality_odd_documents(spark, odd_docs):
    labels = spark.createDataFrame([(5, 1), (5, 0), (7, 0), (8, 0), (None, 1), (4, None), (1, 1)], "doc_id long, quality int")
    for known in (labels, labels.filter("quality = 1"), labels.limit(0)):
        model = nbsvm.train(odd_docs, known)
        rows = nbsvm.score(odd_docs, model, "own_score").collect()
        assert len(rows) == odd_docs.count() and all(0 <= r.own_score <= 1 for r in rows)
        scores = [r.own_score for r in rows if r.doc_id in (5, 6)]
        assert len(set(scores)) == 1  # equal texts
    assert nbsvm.score(odd_docs.limit(0), model, "own_score").count() == 0


def drawn_first(spark, texts):
    """The text whose copies a draw by hash of the text takes first."""
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    return df.orderBy(F.pmod(F.xxhash64(F.lit("sample"), F.col("text")), F.lit(1_000_000))).first().text


def test_copies_do_not_fill_the_sample_of_a_language(spark):
    words = {"x": "alder birch cedar maple".split(), "y": "sei uno due tre".split(), "z": "kwik jazz vox pyx".split()}
    texts = [" ".join(words[kind][(i // 4**k) % 4] for k in range(5)) for kind in words for i in range(190)]
    copy = drawn_first(spark, texts)
    rows = [(t, "aa") for t in texts] + [(copy, "aa")] * 450
    df = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    model = centroid_langid.fit(df)
    assert len(model.centroids) == 3 and (model.centroids @ model.centroids.T)[~np.eye(3, dtype=bool)].max() < 0.9
    assert min(model.nearest(t)[1] for t in texts) > 0.4
    again = centroid_langid.fit(df.repartition(3, "text"))
    assert np.allclose(model.centroids, again.centroids)


def test_copies_do_not_fill_the_sample_of_a_class(spark, monkeypatch):
    monkeypatch.setattr(nbsvm, "SAMPLE", 60)
    texts = [(i % 2, f"{'good plain prose' if i % 2 else 'buy cheap now'} number {i} of many") for i in range(200)]
    copy = drawn_first(spark, [t for label, t in texts if label])
    df = spark.createDataFrame(texts + [(1, copy)] * 4000, "label int, text string")
    model = nbsvm.fit(df.repartition(4))
    assert not np.array_equal(model.weights, model.ratios)  # both classes were drawn
    assert np.mean([(model.score(t) >= 0.5) == bool(label) for label, t in texts]) > 0.95
    assert np.array_equal(model.weights, nbsvm.fit(df.repartition(3, "text")).weights)


def test_dual_descent_separates():
    turn = np.random.default_rng(1)
    rows = [np.flatnonzero(turn.random(50) < 0.3).astype(np.int32) for _ in range(200)]
    y = np.where([3 in set(r) for r in rows], 1.0, -1.0)
    values = [np.ones(len(r)) / max(1, np.sqrt(len(r))) for r in rows]
    w, b = nbsvm.dual_descent(rows, values, y, np.full(200, 10.0))
    assert np.mean([np.sign(w[r] @ v + b) == t for r, v, t in zip(rows, values, y)]) > 0.98


def plain_grams(text, sizes):
    return {(n, text[i : i + n]) for n in sizes for i in range(len(text) - n + 1)}


def test_nbsvm_is_a_plain_one(spark):
    """Counts, ratios and the solution against dictionaries and a plain solver."""
    turn = np.random.default_rng(8)
    word = lambda high: "".join(turn.choice(list("abcdef" if high else "defghi"), 4))
    rows = [(i % 2, " ".join(word(i % 2) for _ in range(12))) for i in range(60)]
    model = nbsvm.fit(spark.createDataFrame(rows, "label int, text string").repartition(3))
    # A text holds the places of its n-grams, and the indicators of repetition after them.
    for _, text in rows[:10]:
        grams = [nbsvm.count_grams(nbsvm.codes(g), (n,), nbsvm.BITS) for n, g in plain_grams(text, nbsvm.SIZES)]
        own = nbsvm.places_of(text)
        assert set(own[own < 1 << nbsvm.BITS].tolist()) == {int(p) for g in grams for p in np.flatnonzero(g)}
    # Ratios of smoothed shares, counted with sets.
    counts = np.zeros((2, nbsvm.PLACES))
    for label, text in rows:
        for p in set(nbsvm.places_of(text).tolist()):
            counts[label, p] += 1
    shares = (counts + nbsvm.SMOOTH) / (counts.sum(axis=1, keepdims=True) + nbsvm.SMOOTH * nbsvm.PLACES)
    assert np.allclose(model.ratios, np.log(shares[1] / shares[0]), atol=1e-12)
    # The solution: no feasible dual step improves it.
    x = np.zeros((len(rows), nbsvm.PLACES))
    for i, (_, t) in enumerate(rows):
        p = nbsvm.places_of(t)
        x[i, p] = nbsvm.scaled(p, model.ratios)
    y = np.where([label for label, _ in rows], 1.0, -1.0)
    z = np.hstack([x, np.ones((len(rows), 1))])
    q = (z @ z.T) * np.outer(y, y)
    alpha = np.zeros(len(rows))
    for _ in range(20_000):  # projected gradient on the dual
        alpha = np.clip(alpha + (1 - q @ alpha) / np.linalg.norm(q, 2), 0, nbsvm.COST)
    best = z.T @ (alpha * y)
    assert np.allclose(best[:-1], model.weights, atol=5e-3) and best[-1] == pytest.approx(model.bias, abs=5e-3)


def test_nearest_centroid_is_a_plain_one(spark):
    data = spark.read.parquet(f"{DATA}/documents.parquet").filter("doc_id < 120").select("text", "lang")
    model = centroid_langid.fit(data)
    rows = [(r.text, r.lang) for r in data.collect() if r.text]
    prepared = [centroid_langid.letters(t) for t, _ in rows]
    held = np.zeros(1 << centroid_langid.BITS)
    for chars in prepared:
        held += centroid_langid.count_grams(chars, centroid_langid.SIZES, centroid_langid.BITS) > 0
    n = sum(len(chars) > 0 for chars in prepared if chars is not None)
    known = sum(lang is not None for _, lang in rows)
    if known == len(rows):
        assert np.allclose(model.idf, np.log((1 + n) / (1 + held)) + 1)
    for (text, _), chars in zip(rows[:40], prepared[:40]):
        counts = centroid_langid.count_grams(chars, centroid_langid.SIZES, centroid_langid.BITS)
        v = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0) * model.idf
        cosines = model.centroids @ (v / (np.linalg.norm(v) or 1))
        lang, score, _ = model.nearest(text)
        if len(chars):
            assert lang == model.languages[int(np.argmax(cosines))] and score == pytest.approx(float(np.clip(cosines.max(), 0, 1)), abs=1e-5)


def nearest(ids, rows, query, k):
    sims = rows @ rows[query]
    order = [i for i in np.lexsort((ids, -sims)) if i != query][:k]
    return [(int(ids[i]), float(sims[i])) for i in order]


def test_neighbours_recall_and_scores(spark):
    table = spark.read.parquet(f"{DATA}/embeddings.parquet").orderBy("vec_id").collect()
    ids, rows = np.array([r.vec_id for r in table]), np.array([r.embedding for r in table], float)
    found = {}
    for r in QUERIES["op9_nn_descent"](spark, DATA).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(found) == {int(i) for i in ids if i % 20 == 0}
    hits = 0
    for q, own in found.items():
        own.sort()
        assert [x[0] for x in own] == list(range(1, 21))
        best = nearest(ids, rows, int(np.flatnonzero(ids == q)[0]), 20)
        hits += len({x[1] for x in own} & {x[0] for x in best})
        for _, v, s in own:
            assert s == pytest.approx(rows[ids == v][0] @ rows[ids == q][0], abs=1e-12)
    assert hits / (20 * len(found)) >= 0.9


def clustered_vectors(n, seed):
    turn = np.random.default_rng(seed)
    rows = turn.standard_normal((n // 20, 32))[turn.integers(0, n // 20, n)] + 0.5 * turn.standard_normal((n, 32))
    return rows / np.linalg.norm(rows, axis=1)[:, None]


def recall_of_20(spark, rows):
    ids = np.arange(len(rows))
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, rows)], "vec_id long, embedding array<double>")
    found = nn_descent.search(nn_descent.build(df), F.col("id") % 40 == 0, 20).collect()
    wanted = {(int(q), v) for q in ids if q % 40 == 0 for v, _ in nearest(ids, rows, q, 20)}
    return len(wanted & {(r.query_id, r.vec_id) for r in found}) / len(wanted)


def test_one_long_vector_leaves_the_others_ranked(spark):
    rows = clustered_vectors(2000, 3)
    rows[77] *= 10_000
    assert recall_of_20(spark, rows) > 0.95


def test_descent_goes_on_until_it_settles(spark, monkeypatch):
    rounds, improved = [], nn_descent.improved

    def watched(graph, nodes, width, salt):
        after = nn_descent.cut(improved(graph, nodes, width, salt))
        back = nn_descent._listing(graph, salt).select(F.col("other").alias("src"), F.col("node").alias("dst"))
        untried = graph.filter("back").join(back, ["src", "dst"], "anti")
        lost = after.join(untried, ["src", "dst"], "semi").filter("NOT back").count()
        rounds.append((after.filter("fresh").count(), lost))
        return after

    monkeypatch.setattr(nn_descent, "improved", watched)
    first = nn_descent.first_graph  # a poor one, for more rounds
    monkeypatch.setattr(nn_descent, "first_graph", lambda *a: first(*a).filter(F.pmod(F.xxhash64("src", "dst"), F.lit(12)) == 0))
    monkeypatch.setattr(nn_descent, "SETTLED", 0.001)
    recall = recall_of_20(spark, clustered_vectors(1600, 4))
    assert recall > 0.95
    assert len(rounds) > 3 and rounds[-1][0] <= 0.001 * nn_descent.WIDTH * 1600
    assert not any(lost for _, lost in rounds)  # what was not joined stays to be joined


def rows_moved(df):
    """Rows that all exchanges of a frame's plan wrote when it ran."""
    df._jdf.queryExecution().toRdd().count()
    plans, rows = [df._jdf.queryExecution().executedPlan()], 0
    while plans:
        plan = plans.pop()
        kind = plan.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            plans.append(plan.executedPlan())
        elif kind.endswith("QueryStageExec"):
            plans.append(plan.plan())
        else:
            if kind == "ShuffleExchangeExec":
                rows += plan.metrics().apply("shuffleRecordsWritten").value()
            plans += [plan.children().apply(i) for i in range(plan.children().size())]
    return rows


def indexed(spark, rows):
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")
    return nn_descent.cut(nn_descent._packed(nn_descent.distinct_vectors(nn_descent.usable(df, "vec_id", "embedding"), 6)))


def test_a_round_moves_few_rows(spark):
    nodes = indexed(spark, clustered_vectors(3000, 6))
    graph = nn_descent.cut(nn_descent.first_graph(nodes, 3000, 32))
    assert graph.count() == 3000 * nn_descent.WIDTH
    moved = rows_moved(nn_descent.improved(graph, nodes, 32, 0))
    assert 0 < moved < 3000  # arrays between buckets; with a row per link and neighbour it was 961,952


def test_a_round_joins_all_neighbours(spark):
    rows = clustered_vectors(900, 7)
    rows[5] *= 20
    nodes = indexed(spark, rows)
    graph = nn_descent.first_graph(nodes, 900, 32).filter(F.pmod(F.xxhash64("src", "dst"), F.lit(9)) != 0)
    old = F.pmod(F.xxhash64("dst", "src"), F.lit(3)) == 0
    graph = nn_descent.cut(graph.withColumn("fresh", ~old).withColumn("back", ~old))
    held = {r["node"]: r for r in nodes.collect()}
    unit = {n: nn_descent._unpack(pa.array([r["packed"]]), 32)[0] for n, r in held.items()}

    def near(a, b):
        return nn_descent._nearness(np.stack([unit[a], unit[b]]), np.array([held[a]["norm"], held[b]["norm"]]))[0, 1]

    links = {(r.src, r.dst): r for r in graph.collect()}
    listed = {(r["node"], r["other"]): r["fresh"] for r in nn_descent._listing(graph, 3).collect()}
    around, last = {}, {}
    for (a, b), r in links.items():
        around.setdefault(a, {})[b] = r.fresh
        last.setdefault(a, []).append(r.sim)
    last = {a: min(x) if len(x) >= nn_descent.WIDTH else -np.inf for a, x in last.items()}
    for (a, b), fresh in listed.items():
        around.setdefault(a, {})[b] = around.get(a, {}).get(b, False) or fresh
    best = {}  # src -> dst -> nearness, fresh, back
    for (a, b), r in links.items():
        best.setdefault(a, {})[b] = (r.sim, False, r.back and (b, a) not in listed)
    for others in around.values():
        for a in others:
            for b in others:
                if a != b and (others[a] or others[b]) and b not in best.get(a, {}) and (s := near(a, b)) > last.get(a, -np.inf):
                    best.setdefault(a, {})[b] = (s, True, True)
    wanted = {(a, b): x for a, found in best.items() for b, x in sorted(found.items(), key=lambda y: (-y[1][0], y[0]))[: nn_descent.WIDTH]}
    got = {(r.src, r.dst): (r.sim, r.fresh, r.back) for r in nn_descent.improved(graph, nodes, 32, 3).collect()}
    assert set(got) == set(wanted) and len(got) > len(links)
    assert all(got[k][1:] == wanted[k][1:] and got[k][0] == pytest.approx(wanted[k][0], abs=1e-6) for k in got)


@pytest.mark.parametrize("shortest", [0.5, 0.0001])
def test_the_nearest_of_a_block(shortest):
    turn = np.random.default_rng(8)
    rows, ids = clustered_vectors(200, 8).astype("f4"), np.arange(200)
    ids[150:] = ids[:50]  # the end of one tree and the begin of the next
    norms = turn.uniform(shortest, 1, 200)
    near = nn_descent._nearness(rows, norms)
    near[ids[:, None] == ids] = -np.inf
    best, sims = nn_descent._nearest(ids, rows, norms, 32)
    assert np.allclose(np.take_along_axis(near, best, 1), sims, rtol=1e-6)
    assert np.allclose(np.sort(sims, axis=1), np.sort(near, axis=1)[:, -32:], rtol=1e-4)
    best, sims = nn_descent._nearest(ids[:1], rows[:1], norms[:1], 32)
    assert sims.tolist() == [[-np.inf]]


def test_neighbours_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 2.0]) for i in range(0, 200)]  # equal vectors: ties to the smaller id
    rows += [(300, [2.0, 1.0]), (320, [-1.0, 0.5]), (300, [2.0, 1.0]), (340, None), (360, []), (380, [0.0, 0.0])]
    rows += [(400, [nan, 1.0]), (420, [inf, 1.0]), (440, [None, 1.0]), (None, [3.0, 3.0]), (460, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame([(a, b, "x") for a, b in rows], "vec_id long, embedding array<float>, node string")
    index = nn_descent.build(df, keep=6)
    found = {}
    for r in nn_descent.search(index, F.col("id") % 20 == 0, 5).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(found) == {*range(0, 200, 20), 300, 320}
    assert [x[1] for x in sorted(found[0])] == [1, 2, 3, 4, 5]
    assert [x[1] for x in sorted(found[180])] == [0, 1, 2, 3, 4]
    assert [x[1] for x in sorted(found[320])] == [0, 1, 2, 3, 4]
    assert sorted(found[300])[0] == (1, 0, 4.0)
    few = nn_descent.build(df.filter("vec_id IN (300, 320)"), keep=6)
    assert nn_descent.search(few, F.col("id") % 20 == 0, 5).count() == 2
    none = nn_descent.build(df.limit(0), keep=6)
    assert nn_descent.search(none, F.col("id") % 20 == 0, 5).count() == 0
