import math
import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillgrid.operators import impact, ordering, retrieval
from quillgrid.operators import nearest as nearest_module
from quillgrid.operators.nearest import nearest
from quillgrid.plans.retrieval import hybrid_queries

CORPUS = [(1, "order order total"), (2, "order status"), (3, "order customer name order")]


def okapi(corpus, query):
    """BM25 from its published formula, with the negative idf floor of 0.25 times the mean idf."""
    docs = {i: t.split() for i, t in corpus}
    n, average = len(docs), sum(map(len, docs.values())) / len(docs)
    df = {t: sum(t in d for d in docs.values()) for d in docs.values() for t in d}
    raw = {t: math.log(n - k + 0.5) - math.log(k + 0.5) for t, k in df.items()}
    mean = sum(raw.values()) / len(raw)
    idf = {t: 0.25 * mean if v < 0 else v for t, v in raw.items()}
    out = {}
    for i, d in docs.items():
        if set(d) & set(query):
            out[i] = sum(
                idf[t] * d.count(t) * 2.5 / (d.count(t) + 1.5 * (0.25 + 0.75 * len(d) / average)) for t in query if t in d
            )
    return {i: round(s, 6) for i, s in out.items()}


@pytest.mark.parametrize("question", ["customer orders", "order order order", "the status of names", "who is there", "unknown"])
def test_bm25_by_hand(spark, question):
    corpus = spark.createDataFrame(CORPUS, "item_id long, text string")
    queries = spark.createDataFrame([(7, question)], "query_id long, text string")
    found = {r.item_id: r.score for r in retrieval.bm25_score(retrieval.bm25_index(corpus), queries).collect()}
    tokens = {"customer orders": ["customer", "order"], "order order order": ["order"] * 3, "the status of names": ["status", "name"]}
    expected = okapi(CORPUS, tokens.get(question, []))
    assert found.keys() == expected.keys()
    assert all(abs(found[i] - expected[i]) < 2e-6 for i in found)


def test_bm25_of_empty_corpus_and_empty_texts(spark):
    queries = spark.createDataFrame([(1, "order")], "query_id long, text string")
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert retrieval.bm25_score(retrieval.bm25_index(nothing), queries).count() == 0
    blank = spark.createDataFrame([(1, ""), (2, None), (3, "the")], "item_id long, text string")
    assert retrieval.bm25_score(retrieval.bm25_index(blank), queries).count() == 0


@pytest.mark.parametrize("values, expected", [
    ([2.0, 4.0, 3.0], [0.0, 1.0, 0.5]), ([0.0, 0.0], [0.0, 0.0]), ([5.0, 5.0], [1.0, 1.0]), ([-2.0, -2.0], [1.0, 1.0]), ([-1.0, 1.0], [0.0, 1.0]),
])
def test_minmax(spark, values, expected):
    scores = spark.createDataFrame([(1, i, v) for i, v in enumerate(values)], "query_id long, item_id long, score double")
    rows = retrieval.minmax_normalize(scores).orderBy("item_id").collect()
    assert [r.normalized for r in rows] == expected


def brute_force(items, queries, n, exclude_self):
    out = set()
    for q, v in queries:
        pairs = sorted(
            (round(float(((np.array(v) - np.array(w)) ** 2).sum()), 6), i) for i, w in items if not (exclude_self and i == q)
        )
        out |= {(q, i, d, rank) for rank, (d, i) in enumerate(pairs[:n], 1)}
    return out


def clustered(count, seed, copies=0):
    """Vectors around a few centres; the first ``copies`` rows are one and the same vector."""
    draw = random.Random(seed)
    centres = [[draw.uniform(-5, 5) for _ in range(4)] for _ in range(6)]
    rows = []
    for i in range(count):
        centre = centres[0] if i < copies else draw.choice(centres)
        rows.append((i, [round(c if i < copies else c + draw.gauss(0, 0.3), 3) for c in centre]))
    return rows


@pytest.mark.parametrize("broadcast_values", [4_000_000, 0])
@pytest.mark.parametrize("exclude_self, n, copies", [(True, 3, 0), (False, 5, 0), (True, 7, 60), (False, 400, 0)])
def test_nearest_is_exact(spark, broadcast_values, exclude_self, n, copies):
    rows = clustered(180, 3, copies)
    items = spark.createDataFrame(rows, "item_id long, vector array<double>").repartition(5)
    queries = spark.createDataFrame(rows[:90:2], "query_id long, vector array<double>").repartition(3)
    hits = nearest(items, queries, n, exclude_self, broadcast_values=broadcast_values, block_rows=16, cells=8)
    found = {(r.query_id, r.item_id, r.distance, r.rank) for r in hits.collect()}
    assert found == brute_force(rows, rows[:90:2], n, exclude_self)


def test_nearest_far_from_the_origin(spark):
    rows = [(i, [30000.0 + i / 1000, 20000.0]) for i in range(50)]
    items = spark.createDataFrame(rows, "item_id long, vector array<double>")
    queries = items.withColumnRenamed("item_id", "query_id")
    found = {(r.query_id, r.item_id, r.distance, r.rank) for r in nearest(items, queries, 3, True).collect()}
    assert found == brute_force(rows, rows, 3, True)


def test_nearest_of_nothing(spark):
    items = spark.createDataFrame([], "item_id long, vector array<double>")
    queries = spark.createDataFrame([(1, [0.0])], "query_id long, vector array<double>")
    assert nearest(items, queries, 3).count() == 0
    assert nearest(items, queries, 3, broadcast_values=0).count() == 0
    assert nearest(queries.withColumnRenamed("query_id", "item_id"), queries.limit(0), 3).count() == 0


def structureless(count, width, seed):
    return [(i, v) for i, v in enumerate(np.random.default_rng(seed).normal(size=(count, width)).round(3).tolist())]


def test_rows_between_blocks_follow_the_queries(spark, monkeypatch):
    """On vectors that cells cannot keep apart, a query is not answered once per cell."""
    seen, top = [], nearest_module.top_per_group

    def counted(df, group, order, n):
        seen.append((group, df))
        return top(df, group, order, n)

    monkeypatch.setattr(nearest_module, "top_per_group", counted)
    rows = structureless(1500, 16, 5)
    items = spark.createDataFrame(rows, "item_id long, vector array<double>")
    hits = nearest(items, items.withColumnRenamed("item_id", "query_id"), 4, True, broadcast_values=0)
    found = {(r.query_id, r.item_id, r.distance, r.rank) for r in hits.where("query_id < 40").collect()}
    assert found == brute_force(rows, rows[:40], 4, True)
    assert [df.count() for group, df in seen if group == "query_id"] == [1500 * 4]


@pytest.mark.parametrize("copies", [0, 300])
def test_grid_is_exact(spark, copies):
    rows = clustered(400, 7, copies)
    items = spark.createDataFrame(rows, "item_id long, vector array<double>")
    asks = items.where("item_id % 4 = 0").withColumnRenamed("item_id", "query_id")
    hits = nearest_module._by_grid(items, asks, 6, True, rows=64)
    ranked = ordering.top_per_group(hits, "query_id", [F.asc("distance"), F.asc("item_id")], 6)
    assert {(r.query_id, r.item_id, r.distance, r.rank) for r in ranked.collect()} == brute_force(rows, rows[::4], 6, True)


@pytest.mark.parametrize("make", [
    lambda draw: np.repeat(draw.normal(size=(2, 6)), 1500, axis=0),  # copies
    lambda draw: 30000 + draw.normal(size=(3000, 3)),
    lambda draw: np.concatenate([draw.normal(size=(2999, 5)), [[1e12] * 5]]),
    lambda draw: draw.normal(size=(3000, 4)) * 1e20,  # beyond single precision
])
def test_block_search_is_exact_in_little_memory(make):
    vectors = make(np.random.default_rng(2))
    ids = np.random.default_rng(3).permutation(len(vectors)).astype(np.int64)
    search = nearest_module._kernel(5, True)[-1]
    tracemalloc.start()
    found = {q: [] for q in ids.tolist()}
    for part in search(ids, vectors, [(ids, vectors)]):
        for q, i, d in zip(*(p.tolist() for p in part)):
            found[q].append((d, i))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    for q, v in list(zip(ids.tolist(), vectors))[::60]:
        exact = np.floor(((vectors - v) ** 2).sum(1) * 1e6 + 0.5) / 1e6
        assert found[q] == sorted((d, i) for d, i in zip(exact.tolist(), ids.tolist()) if i != q)[:5]
    assert peak < 64 << 20  # a matrix of all pairs has 72 MB


def test_populated_first(spark):
    rows = spark.createDataFrame([(1, 1, 0.1, True), (1, 2, 0.5, False), (1, 3, 0.4, False), (1, 4, 0.4, False)], "query_id long, item_id long, distance double, empty boolean")
    ranked = ordering.populated_first(rows, "query_id", 3, F.asc("distance")).orderBy("rank").collect()
    assert [r.item_id for r in ranked] == [3, 4, 2]


def expected_hybrid(corpus, vectors, queries, empty, k):
    """The fused ranking over every item, one query at a time."""
    out = set()
    n = min(max(5 * k, 30), len(vectors))

    def scaled(scores):
        low, high = min(scores.values()), max(scores.values())
        if high == low:
            return {i: 0.0 if high == 0 else 1.0 for i in scores}
        return {i: round((s - low) / (high - low), 6) for i, s in scores.items()}

    for q, words, vector in queries:
        near = sorted((round(float(((np.array(vector) - np.array(v)) ** 2).sum()), 6), i) for i, v in vectors)[:n]
        vec = scaled({i: 1 - d for d, i in near})
        bm25 = scaled({i: 0.0 for i, _ in corpus} | okapi(corpus, words))
        fused = []
        for i in {i for i, _ in corpus} | set(vec):
            score = round(0.7 * vec.get(i, 0.0) + 0.3 * bm25.get(i, 0.0), 7)
            fused.append((i in empty, -score, i))
        out |= {(q, i, rank) for rank, (_, _, i) in enumerate(sorted(fused)[:k], 1)}
    return out


@pytest.mark.parametrize("empty", [set(), {1, 2, 3, 50}, set(range(0, 78))])
@pytest.mark.parametrize("k", [2, 9, 200])
def test_hybrid_over_every_item(spark, empty, k):
    draw = random.Random(5)
    words = ["order", "status", "customer", "name", "total", "zebra"]
    corpus = [(i, " ".join(draw.choices(words[:5], k=draw.randint(1, 6)))) for i in range(80)]
    vectors = [(i, [draw.random(), draw.random()]) for i in range(0, 80, 2)]
    queries = [(1, ["order", "zebra"], [0.1, 0.2]), (2, ["zebra"], [0.9, 0.9]), (3, [], [0.5, 0.5])]
    hits = retrieval.hybrid_hits(
        spark.createDataFrame(corpus, "item_id long, text string"),
        spark.createDataFrame(vectors, "item_id long, vector array<double>"),
        spark.createDataFrame([(q, " ".join(w) or "the", v) for q, w, v in queries], "query_id long, text string, vector array<double>"),
        spark.createDataFrame([(i,) for i in empty], "item_id long"), k,
    )
    found = {(r.query_id, r.item_id, r.rank) for r in hits.collect()}
    assert found == expected_hybrid(corpus, vectors, queries, empty, k)


def test_hybrid_on_a_tiny_corpus_with_negative_idf(spark):
    corpus = [(1, "order order total"), (2, "order status"), (3, "order total")]
    vectors = [(1, [0.0]), (2, [1.0]), (3, [2.0])]
    queries = [(1, ["order"], [0.0]), (2, ["status", "order"], [2.0])]
    hits = retrieval.hybrid_hits(
        spark.createDataFrame(corpus, "item_id long, text string"), spark.createDataFrame(vectors, "item_id long, vector array<double>"),
        spark.createDataFrame([(q, " ".join(w), v) for q, w, v in queries], "query_id long, text string, vector array<double>"),
        spark.createDataFrame([], "item_id long"), 8,
    )
    assert {(r.query_id, r.item_id, r.rank) for r in hits.collect()} == expected_hybrid(corpus, vectors, queries, set(), 8)


ABSTENTION = [  # five questions inside the domain, five outside, with distances on either side of 0.81
    (1, 0.633, False), (2, 0.70, False), (3, 0.75, False), (4, 0.797, False), (5, 0.81, False),
    (6, 0.828, True), (7, 0.85, True), (8, 0.88, True), (9, 0.91, True), (10, None, True),
]


def test_abstention(spark):
    hits = spark.createDataFrame([(q, 1, d, 1) for q, d, _ in ABSTENTION if d is not None], "query_id long, item_id long, distance double, rank long")
    queries = spark.createDataFrame([(q,) for q, _, _ in ABSTENTION], "query_id long")
    found = {r.query_id: r.abstain for r in retrieval.abstain_decision(queries, hits).collect()}
    assert found == {q: a for q, _, a in ABSTENTION}


def test_margin_without_second_hit(spark):
    hits = spark.createDataFrame([(1, 5, 0.5, 1), (1, 6, 0.75, 2), (2, 5, 0.4, 1)], "query_id long, item_id long, distance double, rank long")
    assert {r.query_id: r.margin for r in ordering.top2_margin(hits).collect()} == {1: 0.25, 2: 0.0}


def test_allowed_tables(spark):
    hits = spark.createDataFrame([(1, "a"), (2, "b")], "item_id long, table string")
    assert retrieval.allowed_only(hits, hits.select("table").limit(0), "table").count() == 2
    assert retrieval.allowed_only(hits, hits.where("table = 'b'"), "table").count() == 1


def test_every_question_with_a_vector_asks_with_it(spark):
    class Few:
        benchmark = spark.createDataFrame([(1, "one"), (2, "two"), (3, "three")], "item_id long, text string")
        embeddings = spark.createDataFrame([(1, [1.0], 0), (2, [2.0], 0)], "vec_id long, embedding array<double>, label int")

    rows = {r.query_id: r.vector for r in hybrid_queries(Few).collect()}
    assert rows == {1: [1.0], 2: [2.0], 3: None}


# ---- the index in blocks ---------------------------------------------------------------------

WORDS = [f"w{i}" for i in range(60)]


def texts_of(count, seed, copies=0):
    """Texts of uneven words and lengths; the first ``copies`` are equal."""
    draw = random.Random(seed)
    some = lambda: " ".join(draw.choices(WORDS, [1 / (i + 1) for i in range(60)], k=int(draw.expovariate(0.05)) + 1))
    same = some()
    return [(i, same if i < copies else some()) for i in range(count)]


def index_of(spark, rows, partitions=4, **kind):
    return retrieval.bm25_index(spark.createDataFrame(rows, "item_id long, text string").repartition(partitions), **kind)


def best_of_all(index, queries, k):
    scores = retrieval.bm25_score(index, queries)
    return {tuple(r) for r in ordering.top_per_group(scores, "query_id", [F.desc("score"), F.asc("item_id")], k).collect()}


@pytest.mark.parametrize("copies", [0, 150])
@pytest.mark.parametrize("k", [1, 7, 1000])
def test_best_matches_are_those_of_all_matches(spark, k, copies):
    index = retrieval.with_statistics(impact.index_blocks(spark.createDataFrame(texts_of(400, 5, copies), "item_id long, text string").repartition(3), block_items=32))
    queries = spark.createDataFrame([(i, t) for i, t in texts_of(12, 9)] + [(50, "w0 w0 w1 nowhere"), (51, "nowhere"), (52, None)], "query_id long, text string")
    assert {tuple(r) for r in retrieval.bm25_top(index, queries, k).collect()} == best_of_all(index, queries, k)


def test_bounds_and_near_pairs_of_matches(spark):
    index = index_of(spark, texts_of(300, 6))
    queries = spark.createDataFrame([(i, t) for i, t in texts_of(10, 8)], "query_id long, text string")
    empty = spark.createDataFrame([(i,) for i in range(0, 300, 3)], "item_id long")
    near = spark.createDataFrame([(q, i) for q in range(10) for i in range(q, 300, 40)], "query_id long, item_id long")
    scores = {}
    for r in retrieval.bm25_score(index, queries).collect():
        scores.setdefault(r.query_id, {})[r.item_id] = r.score
    found = retrieval.bm25_matches(index, queries, 5, empty, near)
    for r in found.bounds.collect():
        every = list(scores[r.query_id].values())
        every += [0.0] if len(every) < 300 else []
        assert (r.low, r.high) == (min(every), max(every)) and r.scored <= len(scores[r.query_id])
    hits = found.hits.collect()
    asked = {(r.query_id, r.item_id) for r in near.collect()}
    assert {(r.query_id, r.item_id) for r in hits if r.near} == {(q, i) for q, i in asked if i in scores.get(q, {})}
    assert all(r.score == scores[r.query_id][r.item_id] and r.empty == (r.item_id % 3 == 0) for r in hits)
    for q, own in scores.items():
        for flag in (True, False):
            others = sorted((-s, i) for i, s in own.items() if (q, i) not in asked and (i % 3 == 0) == flag)[:5]
            best = sorted((-r.score, r.item_id) for r in hits if r.query_id == q and not r.near and r.empty == flag)
            assert best[:5] == others


def test_few_matches_are_scored(spark):
    index = index_of(spark, texts_of(4000, 3), 2)
    queries = spark.createDataFrame([(i, t) for i, t in texts_of(30, 4)], "query_id long, text string")
    scored = retrieval.bm25_matches(index, queries, 5).bounds.agg(F.sum("scored")).first()[0]
    assert scored < retrieval.bm25_score(index, queries).count() / 3


def contents(index):
    return {tuple(r) for r in index.postings.collect()}, {tuple(r) for r in index.terms.select("term", "df", "cf", F.round("idf", 9)).collect()}


def test_appended_and_reduced_index_is_that_of_all_rows(spark):
    rows = texts_of(300, 7) + [(900, ""), (901, None)]
    whole = index_of(spark, rows)
    parts = index_of(spark, rows[:200])
    for segment, more in enumerate((rows[200:250], rows[250:]), 1):
        parts = retrieval.bm25_append(parts, spark.createDataFrame(more, "item_id long, text string"), segment)
    assert contents(parts) == contents(whole)
    gone = [i for i, _ in rows if i % 7 == 2] + [901]
    less = retrieval.bm25_remove(parts, spark.createDataFrame([(i,) for i in gone] + [(12345,)], "item_id long"))
    expected = index_of(spark, [r for r in rows if r[0] not in gone])
    assert contents(less) == contents(expected)
    queries = spark.createDataFrame(texts_of(8, 2), "query_id long, text string")
    assert {tuple(r) for r in retrieval.bm25_top(less, queries, 6).collect()} == best_of_all(expected, queries, 6)


def test_building_an_index_shuffles_no_posting(spark, capsys):
    corpus = spark.range(0, 100, 1, 8).select(F.col("id").alias("item_id"), F.lit("some words").alias("text"))
    retrieval.bm25_index(corpus).postings.explain()
    assert "Exchange" not in capsys.readouterr().out


def test_batches_of_queries(spark):
    index = index_of(spark, texts_of(150, 1))
    queries = spark.createDataFrame(texts_of(20, 2), "query_id long, text string")
    weights = retrieval.query_weights(index, queries)
    documents, average = retrieval.blocks_figures(index)
    part = lambda counts, lengths: counts * 2.5 / (counts + 1.5 * (0.25 + 0.75 * lengths / average))
    matches = impact.best_matches(index.blocks, weights, 4, documents, part, batch_terms=40)
    got = ordering.top_per_group(matches.hits.select("query_id", "item_id", "score"), "query_id", [F.desc("score"), F.asc("item_id")], 4)
    assert {tuple(r) for r in got.collect()} == best_of_all(index, queries, 4)
