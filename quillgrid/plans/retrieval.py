"""BM25, nearest neighbours, fusion, abstention and value lookup on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalize_question
from ..operators import evaluate, ordering, retrieval
from ..operators.nearest import nearest
from ..sources.tables import Tables, last_by
from .registry import query
from .sqltext import bm25, distances, folded_words

THRESHOLD = 1.2  # calibrated on the distances of the given vectors

CORPUS_SQL = "SELECT doc_id AS item_id, text FROM documents"
ASKED_SQL = "SELECT item_id AS query_id, text FROM benchmark"
VECTORS_SQL = "SELECT vec_id AS item_id, embedding AS vector FROM embeddings"
SELF_SQL = "SELECT vec_id AS query_id, embedding AS vector FROM embeddings"
EMPTY_SQL = "SELECT doc_id AS item_id FROM labels WHERE quality = 0"
OTHERS = "query_id <> item_id"


def corpus(t: Tables) -> DataFrame:
    return t.documents.select(F.col("doc_id").alias("item_id"), "text")


def asked(t: Tables) -> DataFrame:
    return t.benchmark.select(F.col("item_id").alias("query_id"), "text")


def vectors(t: Tables) -> DataFrame:
    return t.embeddings.select(F.col("vec_id").alias("item_id"), F.col("embedding").alias("vector"))


def vector_queries(t: Tables) -> DataFrame:
    """Every vector asks for its neighbours among the others."""
    return t.embeddings.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))


def empty_items(t: Tables) -> DataFrame:
    return t.labels.where("quality = 0").select(F.col("doc_id").alias("item_id"))


# ---- BM25 ------------------------------------------------------------------------------------

@query("bm25_index", f"""
WITH {bm25(CORPUS_SQL, ASKED_SQL)}
SELECT term, df, CAST(cf AS BIGINT) AS cf, round(idf, 6) AS idf, (SELECT n FROM stats) AS documents,
       round((SELECT avgdl FROM stats), 6) AS average_length FROM terms""")
def bm25_index(t: Tables) -> DataFrame:
    index = retrieval.bm25_index(corpus(t))
    return index.terms.select(
        "term", "df", "cf", F.round("idf", 6).alias("idf"), index.documents.alias("documents"),
        F.round(index.average_length, 6).alias("average_length"),
    )


@query("bm25_postings", f"""
WITH {bm25(CORPUS_SQL, ASKED_SQL)}
SELECT item_id, length, term, tf FROM postings""")
def bm25_postings(t: Tables) -> DataFrame:
    return retrieval.bm25_index(corpus(t)).postings


BM25_K = 40


@query("bm25_score", f"""
WITH {bm25(CORPUS_SQL, ASKED_SQL)},
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS rank FROM scores)
SELECT query_id, item_id, score, rank FROM r WHERE rank <= {BM25_K}""")
def bm25_score(t: Tables) -> DataFrame:
    """The best matches of every question; every match is what the function of this name returns."""
    return retrieval.bm25_top(retrieval.bm25_index(corpus(t)), asked(t), BM25_K)


# ---- vectors ---------------------------------------------------------------------------------

@query("knn_vector", f"""
WITH {distances(VECTORS_SQL, SELF_SQL, OTHERS)} SELECT query_id, item_id, distance, rank FROM dist WHERE rank <= 10""")
def knn_vector(t: Tables) -> DataFrame:
    return nearest(vectors(t), vector_queries(t), 10, exclude_self=True)


@query("knn_vector_cells", f"""
WITH {distances(VECTORS_SQL, SELF_SQL, OTHERS)} SELECT query_id, item_id, distance, rank FROM dist WHERE rank <= 10""")
def knn_vector_cells(t: Tables) -> DataFrame:
    """The same by the join of cells that a batch of queries beyond the broadcast bound takes."""
    return nearest(vectors(t), vector_queries(t), 10, exclude_self=True, broadcast_values=0)


def populated_sql(k: int, corpus_sql: str = VECTORS_SQL, query_sql: str = SELF_SQL, condition: str = OTHERS) -> str:
    """CTEs ending in ``hits``: over-fetch min(3k, 40), populated first, the first k."""
    return f"""{distances(corpus_sql, query_sql, condition)},
flagged AS (SELECT query_id, item_id, distance, item_id IN ({EMPTY_SQL}) AS empty FROM dist
            WHERE rank <= least({3 * k}, 40, (SELECT count(*) FROM vec))),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY empty, distance, item_id) AS rank FROM flagged),
hits AS (SELECT * FROM ranked WHERE rank <= {k})"""


@query("vector_topk_populated", f"WITH {populated_sql(8)} SELECT query_id, item_id, distance, empty, rank FROM hits")
def vector_topk_populated(t: Tables) -> DataFrame:
    return retrieval.vector_hits(vectors(t), vector_queries(t), empty_items(t), exclude_self=True)


@query("rank_populated_first", """
WITH d AS (SELECT lang, doc_id AS item_id, n_chars, coalesce(quality = 0, false) AS empty FROM documents LEFT JOIN labels USING (doc_id)),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY empty, n_chars DESC, item_id) AS rank FROM d)
SELECT lang, item_id, n_chars, empty, rank FROM r WHERE rank <= 8""")
def rank_populated_first(t: Tables) -> DataFrame:
    rows = t.documents.select("lang", F.col("doc_id").alias("item_id"), "n_chars")
    return ordering.populated_first(retrieval.with_empty_flag(rows, empty_items(t)), "lang", 8, F.desc("n_chars")).select(
        "lang", "item_id", "n_chars", "empty", "rank"
    )


@query("top2_margin", f"""
WITH {populated_sql(3)}
SELECT query_id, min(distance) FILTER (WHERE rank = 1) AS distance,
       coalesce(round(min(distance) FILTER (WHERE rank = 2) - min(distance) FILTER (WHERE rank = 1), 6), 0) AS margin
FROM hits GROUP BY query_id""")
def top2_margin(t: Tables) -> DataFrame:
    return ordering.top2_margin(retrieval.vector_hits(vectors(t), vector_queries(t), empty_items(t), 3, exclude_self=True))


def decisions(t: Tables) -> DataFrame:
    hits = retrieval.vector_hits(vectors(t), vector_queries(t), empty_items(t), 3, exclude_self=True)
    return retrieval.abstain_decision(vector_queries(t), hits, THRESHOLD)


@query("abstain_decision", f"""
WITH {populated_sql(3)}
SELECT q.query_id, item_id, distance, coalesce(distance > {THRESHOLD}, true) AS abstain
FROM qvec q LEFT JOIN (SELECT * FROM hits WHERE rank = 1) h ON h.query_id = q.query_id""")
def abstain_decision(t: Tables) -> DataFrame:
    return decisions(t)


def expected_classes(t: Tables) -> DataFrame:
    """Queries whose own row is marked as low quality should be refused."""
    own = empty_items(t).select(F.col("item_id").alias("query_id"), F.lit(True).alias("refuse"))
    return decisions(t).join(own, "query_id", "left").select(
        "query_id", "distance", "abstain", F.coalesce("refuse", F.lit(False)).alias("abstain_expected")
    )


CLASSES_SQL = f"""{populated_sql(3)},
classes AS (SELECT query_id, distance, query_id IN ({EMPTY_SQL}) AS abstain_expected FROM hits WHERE rank = 1)"""


@query("abstain_calibration", f"""
WITH {CLASSES_SQL},
grid AS (SELECT DISTINCT CAST(ceil(round(distance * 100, 6)) AS BIGINT) AS step FROM classes)
SELECT step / 100.0 AS threshold, count(*) FILTER (WHERE abstain_expected = (distance > step / 100.0)) AS "right", count(*) AS questions,
       count(*) FILTER (WHERE abstain_expected = (distance > step / 100.0)) / count(*) AS accuracy
FROM grid, classes GROUP BY step""")
def abstain_calibration(t: Tables) -> DataFrame:
    return evaluate.threshold_sweep(expected_classes(t))


@query("abstain_best_threshold", f"""
WITH {CLASSES_SQL},
grid AS (SELECT DISTINCT CAST(ceil(round(distance * 100, 6)) AS BIGINT) AS step FROM classes)
SELECT step / 100.0 AS threshold, count(*) FILTER (WHERE abstain_expected = (distance > step / 100.0)) AS "right", count(*) AS questions,
       count(*) FILTER (WHERE abstain_expected = (distance > step / 100.0)) / count(*) AS accuracy
FROM grid, classes GROUP BY step ORDER BY accuracy DESC, threshold LIMIT 1""")
def abstain_best_threshold(t: Tables) -> DataFrame:
    return evaluate.best_threshold(evaluate.threshold_sweep(expected_classes(t)))


@query("abstain_ranges", f"""
WITH {CLASSES_SQL}
SELECT CASE WHEN abstain_expected THEN 'ABSTAIN' ELSE 'ANSWER' END AS expected, count(*) AS questions,
       min(distance) AS nearest, max(distance) AS farthest FROM classes GROUP BY 1""")
def abstain_ranges(t: Tables) -> DataFrame:
    named = expected_classes(t).withColumn("expected", F.when(F.col("abstain_expected"), "ABSTAIN").otherwise("ANSWER"))
    return evaluate.distance_ranges(named)


# ---- ranks -----------------------------------------------------------------------------------

RANK_K = 8  # hits that count for the three queries: what lies behind them is not found


def expected_items(t: Tables) -> DataFrame:
    """Every vector should find the first vector of its label."""
    first = t.embeddings.groupBy("label").agg(F.min("vec_id").alias("item_id"))
    return t.embeddings.join(first, "label").where("vec_id <> item_id").select(F.col("vec_id").alias("query_id"), "item_id")


RANKS_SQL = f"""{distances(VECTORS_SQL, SELF_SQL, OTHERS)},
expected AS (SELECT vec_id AS query_id, item_id FROM embeddings JOIN (SELECT label, min(vec_id) AS item_id FROM embeddings GROUP BY label) USING (label)
             WHERE vec_id <> item_id),
ranks AS (SELECT e.query_id, e.item_id, d.rank, d.distance FROM expected e
          LEFT JOIN dist d ON d.query_id = e.query_id AND d.item_id = e.item_id AND d.rank <= {RANK_K})"""


def ranks(t: Tables) -> DataFrame:
    return ordering.rank_of_expected(expected_items(t), nearest(vectors(t), vector_queries(t), RANK_K, exclude_self=True))


@query("rank_of_expected", f"WITH {RANKS_SQL} SELECT query_id, item_id, rank FROM ranks")
def rank_of_expected(t: Tables) -> DataFrame:
    return ranks(t)


@query("recall_at_k", f"""
WITH {RANKS_SQL} SELECT count(*) AS expected, count(rank) AS found, count(*) FILTER (WHERE rank <= {RANK_K}) / count(*) AS recall FROM ranks""")
def recall_at_k(t: Tables) -> DataFrame:
    return evaluate.recall_and_rank(ranks(t), RANK_K).drop("mean_rank")


@query("mean_rank", f"WITH {RANKS_SQL} SELECT CAST(sum(rank) AS DOUBLE) / count(rank) AS mean_rank FROM ranks")
def mean_rank(t: Tables) -> DataFrame:
    return evaluate.recall_and_rank(ranks(t), RANK_K).select("mean_rank")


GRID_KS, GRID_CUTS = [1, 2, 3, 5, RANK_K], [i / 10 for i in range(1, 21)]


@query("recall_grid", f"""
WITH {RANKS_SQL}, settings AS (SELECT unnest({GRID_KS})::BIGINT AS k, cut FROM (SELECT unnest({GRID_CUTS})::DOUBLE AS cut)),
found AS (SELECT k, cut, count(r.rank) AS found, sum(r.rank) AS sum_rank
          FROM settings LEFT JOIN (SELECT * FROM ranks WHERE rank IS NOT NULL) r ON r.rank <= k AND r.distance <= cut GROUP BY k, cut)
SELECT k, cut, (SELECT count(*) FROM ranks) AS expected, found, found / (SELECT count(*) FROM ranks) AS recall,
       CAST(sum_rank AS DOUBLE) / nullif(found, 0) AS mean_rank FROM found""")
def recall_grid(t: Tables) -> DataFrame:
    """All settings of k and of the largest accepted distance, from one search."""
    hits = nearest(vectors(t), vector_queries(t), RANK_K, exclude_self=True)
    found = expected_items(t).join(hits.select("query_id", "item_id", "rank", "distance"), ["query_id", "item_id"], "left")
    return evaluate.settings_grid(found, GRID_KS, GRID_CUTS)


# ---- scores ----------------------------------------------------------------------------------

SCALE_SQL = "CASE WHEN high = low THEN CASE WHEN high = 0 THEN 0.0 ELSE 1.0 END ELSE ({v} - low) / (high - low) END"


@query("minmax_normalize", f"""
WITH b AS (SELECT o_custkey, min(o_totalprice) AS low, max(o_totalprice) AS high FROM orders GROUP BY o_custkey)
SELECT o_orderkey, o_custkey, o_totalprice, CAST(round({SCALE_SQL.format(v='o_totalprice')}, 6) AS DOUBLE) AS normalized
FROM orders JOIN b USING (o_custkey)""")
def minmax_normalize(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return retrieval.minmax_normalize(rows, "o_custkey", "o_totalprice")


@query("outer_score_merge", """
WITH a AS (SELECT user_id AS query_id, CAST(day(ts) AS BIGINT) AS item_id, max(value) AS click FROM events WHERE event_type = 'click' GROUP BY ALL),
b AS (SELECT user_id AS query_id, CAST(day(ts) AS BIGINT) AS item_id, max(value) AS purchase FROM events WHERE event_type = 'purchase' GROUP BY ALL)
SELECT query_id, item_id, coalesce(click, 0) AS click, coalesce(purchase, 0) AS purchase FROM a FULL OUTER JOIN b USING (query_id, item_id)""")
def outer_score_merge(t: Tables) -> DataFrame:
    best = lambda kind: (
        t.events.where(F.col("event_type") == kind)
        .groupBy(F.col("user_id").alias("query_id"), F.day("ts").cast("long").alias("item_id")).agg(F.max("value").alias(kind))
    )
    return retrieval.merge_scores(best("click"), best("purchase"), "click", "purchase")


# Text and vector of one item come from one row; a question takes the vector of its number, and
# one without such a vector is answered by its text alone.
QUESTIONS_SQL = "SELECT b.item_id AS query_id, embedding AS vector FROM benchmark b JOIN embeddings ON vec_id = b.item_id"
ITEMS_SQL = "SELECT doc_id AS item_id, embedding AS vector FROM documents JOIN embeddings ON vec_id = doc_id"


def hybrid_queries(t: Tables) -> DataFrame:
    """Every benchmark question, with the vector of its number if there is one."""
    return asked(t).join(vector_queries(t), "query_id", "left")


def item_vectors(t: Tables) -> DataFrame:
    return vectors(t).join(t.documents.select(F.col("doc_id").alias("item_id")), "item_id", "left_semi")


def hybrid_sql(k: int) -> str:
    """CTEs ending in ``fused``; the vector side over-fetches max(5k, 30)."""
    return f"""
{bm25(CORPUS_SQL, ASKED_SQL)},
{distances(ITEMS_SQL, QUESTIONS_SQL)},
near AS (SELECT query_id, item_id, 1 - distance AS score FROM dist WHERE rank <= least({max(5 * k, 30)}, (SELECT count(*) FROM vec))),
near_bounds AS (SELECT query_id, min(score) AS low, max(score) AS high FROM near GROUP BY query_id),
near_scaled AS (SELECT query_id, item_id, round({SCALE_SQL.format(v='score')}, 6) AS vector FROM near JOIN near_bounds USING (query_id)),
every AS (SELECT q.query_id, c.item_id, coalesce(s.score, 0) AS score FROM asked q CROSS JOIN corpus c
          LEFT JOIN scores s ON s.query_id = q.query_id AND s.item_id = c.item_id),
text_bounds AS (SELECT query_id, min(score) AS low, max(score) AS high FROM every GROUP BY query_id),
text_scaled AS (SELECT query_id, item_id, round({SCALE_SQL.format(v='score')}, 6) AS bm25 FROM every JOIN text_bounds USING (query_id)),
merged AS (SELECT query_id, item_id, coalesce(vector, 0) AS vector, coalesce(bm25, 0) AS bm25,
           round(0.7 * coalesce(vector, 0) + 0.3 * coalesce(bm25, 0), 7) AS score, item_id IN ({EMPTY_SQL}) AS empty
           FROM near_scaled FULL OUTER JOIN text_scaled USING (query_id, item_id)),
fused AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY empty, score DESC, item_id) AS rank FROM merged)"""


@query("hybrid_fusion", f"""
WITH {hybrid_sql(8)}
SELECT query_id, item_id, CAST(score AS DOUBLE) AS score, CAST(vector AS DOUBLE) AS vector, CAST(bm25 AS DOUBLE) AS bm25, empty, rank
FROM fused WHERE rank <= 8""")
def hybrid_fusion(t: Tables) -> DataFrame:
    return retrieval.hybrid_hits(corpus(t), item_vectors(t), hybrid_queries(t), empty_items(t))


@query("retriever_switch", f"""
WITH {hybrid_sql(5)} SELECT query_id, item_id, CAST(round(1 - score, 7) AS DOUBLE) AS distance, rank FROM fused WHERE rank <= 5""")
def retriever_switch(t: Tables) -> DataFrame:
    return retrieval.retrieve(corpus(t), item_vectors(t), hybrid_queries(t), empty_items(t), k=5, hybrid=True)


# ---- values and saved answers ----------------------------------------------------------------

def large_labels(t: Tables) -> DataFrame:
    """Labels with at least the average number of vectors, as allowed tables."""
    mean = t.embeddings.agg(F.count("*") / F.count_distinct("label")).scalar()
    sizes = t.embeddings.groupBy("label").agg(F.count("*").alias("n"))
    return sizes.where(F.col("n") >= mean).select(F.concat(F.lit("label_"), F.col("label").cast("string")).alias("table"))


@query("value_retrieve", f"""
WITH {distances(VECTORS_SQL, SELF_SQL, OTHERS)},
allowed AS (SELECT label FROM embeddings GROUP BY label HAVING count(*) >= (SELECT count(*) / count(DISTINCT label) FROM embeddings)),
kept AS (SELECT query_id, item_id, distance, 'label_' || label AS "table" FROM dist JOIN embeddings ON vec_id = item_id
         WHERE rank <= 20 AND label IN (SELECT label FROM allowed)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, item_id) AS rank FROM kept)
SELECT query_id, item_id, distance, "table", rank FROM ranked WHERE rank <= 5""")
def value_retrieve(t: Tables) -> DataFrame:
    values = t.embeddings.select(
        F.col("vec_id").alias("item_id"), F.col("embedding").alias("vector"),
        F.concat(F.lit("label_"), F.col("label").cast("string")).alias("table"),
    )
    return retrieval.retrieve_values(values, vector_queries(t), large_labels(t), exclude_self=True)


@query("semi_allowed_tables", """
SELECT c_custkey, c_nationkey, c_acctbal FROM customer
WHERE c_nationkey IN (SELECT n_nationkey FROM nation JOIN region ON r_regionkey = n_regionkey WHERE r_name = 'ASIA')""")
def semi_allowed_tables(t: Tables) -> DataFrame:
    asia = t.region.where("r_name = 'ASIA'").select(F.col("r_regionkey").alias("n_regionkey"))
    allowed = t.nation.join(asia, "n_regionkey", "left_semi").select(F.col("n_nationkey").alias("c_nationkey"))
    return retrieval.allowed_only(t.customer.select("c_custkey", "c_nationkey", "c_acctbal"), allowed, "c_nationkey")


@query("answer_cache_match", f"""
WITH n AS (SELECT conv_id, turn, role, array_to_string({folded_words('text')}, ' ') AS question FROM conversations),
saved AS (SELECT question, min((conv_id, turn)) AS first FROM n GROUP BY question)
SELECT conv_id, turn, first[1] AS saved_conversation, first[2] AS saved_turn FROM n JOIN saved USING (question) WHERE role = 'user'""")
def answer_cache_match(t: Tables) -> DataFrame:
    keyed = t.conversations.select(
        normalize_question(F.col("text")).alias("question_key"),
        (-F.col("conv_id")).alias("order_1"), (-F.col("turn")).alias("order_2"),
        F.col("conv_id").alias("saved_conversation"), F.col("turn").alias("saved_turn"),
    )
    saved = last_by(keyed, ["question_key"], ["order_1", "order_2"]).select("question_key", "saved_conversation", "saved_turn")
    questions = t.conversations.where("role = 'user'").select("conv_id", "turn", "text")
    return retrieval.match_saved_answers(questions, saved).select("conv_id", "turn", "saved_conversation", "saved_turn")
