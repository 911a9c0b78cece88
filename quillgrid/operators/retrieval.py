"""Batch retrieval: BM25, vector hits, score fusion, abstention, value lookup, answer cache."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vocab
from ..functions.text import normalize_question, token_rows
from ..session import broadcast_if_small, constant_frame, written_table
from .impact import Matches, best_matches, index_blocks, without_items
from .nearest import nearest
from .ordering import enumerate_rows, populated_first, top_per_group

PLACES = 6
FUSED_PLACES = 7  # weights of one decimal times scores of six: nothing is left to round
QUERY_TERMS_BROADCAST = 500_000
SUMMARY_BROADCAST = 1_000_000


# ---- BM25 ------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Bm25Index:
    """blocks of postings, terms(term, df, cf, raw_idf, idf) and two figures; see :mod:`.impact`."""

    blocks: DataFrame
    terms: DataFrame
    documents: Column
    average_length: Column

    @property
    def postings(self) -> DataFrame:
        """(item_id, length, term, tf)"""
        entries = F.explode(F.arrays_zip("items", "lengths", "counts")).alias("entry")
        rows = self.blocks.where(F.col("term").isNotNull()).select("term", entries)
        return rows.select(
            F.col("entry.items").alias("item_id"), F.col("entry.lengths").cast("long").alias("length"), "term",
            F.col("entry.counts").cast("long").alias("tf"),
        )


def bm25_index(corpus: DataFrame) -> Bm25Index:
    """Index corpus(item_id, text), where item_id is a key; rows without it take no part.

    Terms are counted inside the row, so neither text nor postings are shuffled.
    """
    return with_statistics(index_blocks(corpus))


def bm25_append(index: Bm25Index, corpus: DataFrame, segment: int) -> Bm25Index:
    """The index with new items as one more segment: only their texts are read.

    ``segment`` counts up from 1; the blocks that are there are taken as they are.
    """
    return with_statistics(index.blocks.unionByName(index_blocks(corpus, segment)))


def bm25_remove(index: Bm25Index, removed: DataFrame) -> Bm25Index:
    """The index without the items of removed(item_id); only blocks that hold one of them change."""
    return with_statistics(without_items(index.blocks, removed))


def with_statistics(blocks: DataFrame) -> Bm25Index:
    """Statistics of all terms from one row per block and term, of all items from one row per block."""
    totals = blocks.where(F.col("term").isNull()).agg(F.sum(F.size("items")).alias("items"), F.sum("words").alias("words")).first()
    documents = totals["items"] or 0
    lists = blocks.where(F.col("term").isNotNull())
    counts = lists.groupBy("term").agg(F.sum(F.size("items")).alias("df"), F.sum("words").alias("cf"))
    raw_idf = F.log(F.lit(documents) - F.col("df") + 0.5) - F.log(F.col("df") + 0.5)
    counted = written_table(counts.withColumn("raw_idf", raw_idf), "terms")
    floor = vocab.BM25_EPSILON * counted.agg(F.avg("raw_idf")).scalar()
    terms = counted.withColumn("idf", F.when(F.col("raw_idf") < 0, floor).otherwise(F.col("raw_idf")))
    average = F.lit(totals["words"] / documents if documents else None).cast("double")
    return Bm25Index(blocks, terms, F.lit(documents).cast("long"), average)


def query_weights(index: Bm25Index, queries: DataFrame) -> DataFrame:
    """(query_id, term, weight) of the query terms that the corpus knows, written once."""
    asked = (
        token_rows(queries.select("query_id", "text"), "text")
        .groupBy("query_id", "term").agg(F.count("*").alias("times"))
    )
    asked = broadcast_if_small(written_table(asked, "asked"), QUERY_TERMS_BROADCAST)
    weighted = index.terms.select("term", "idf").join(asked, "term")
    return written_table(weighted.select("query_id", "term", (F.col("times") * F.col("idf")).alias("weight")), "weights")


def bm25_score(index: Bm25Index, queries: DataFrame, weights: DataFrame | None = None) -> DataFrame:
    """Okapi BM25 of queries(query_id, text): (query_id, item_id, score) for every matching item.

    Items that share no term with a query score 0 and are left out. A repeated query term counts
    each time. Scores are rounded, so that equal texts have equal scores.

    Postings of query terms are dealt by item once; the pairs of one item are then added up where
    they are made, so what is shuffled follows the postings and not the pairs. The pairs are many:
    :func:`bm25_matches` gives the best of them and scores few others.
    """
    weighted = query_weights(index, queries) if weights is None else weights
    k1, b = vocab.BM25_K1, vocab.BM25_B
    norm = k1 * (1 - b + b * F.col("length") / index.average_length)
    asked = broadcast_if_small(written_table(weighted.select("term").distinct(), "asked-terms"), QUERY_TERMS_BROADCAST)
    of_terms = replace(index, blocks=index.blocks.join(asked, "term", "left_semi")).postings
    dealt = of_terms.withColumn("part", F.col("tf") * (k1 + 1) / (F.col("tf") + norm)).drop("tf", "length").repartition("item_id")
    score = F.round(F.sum(F.col("weight") * F.col("part")), PLACES).alias("score")
    return dealt.join(broadcast_if_small(weighted, QUERY_TERMS_BROADCAST), "term").groupBy("query_id", "item_id").agg(score)


def bm25_matches(
    index: Bm25Index, queries: DataFrame, k: int, empty_items: DataFrame | None = None, near: DataFrame | None = None, tolerance: float = 0.0
) -> Matches:
    """The best ``k`` matches of each query and the bounds of its scores, by the impacts of blocks."""
    k1, b = vocab.BM25_K1, vocab.BM25_B
    documents, average = blocks_figures(index)

    def part(counts, lengths):
        return counts * (k1 + 1) / (counts + k1 * (1 - b + b * lengths / average))

    return best_matches(index.blocks, query_weights(index, queries), k, documents, part, empty_items, near, tolerance)


def blocks_figures(index: Bm25Index) -> tuple[int, float]:
    row = index.blocks.sparkSession.range(1).select(index.documents.alias("n"), index.average_length.alias("mean")).first()
    return row["n"], row["mean"] or 1.0


def bm25_top(index: Bm25Index, queries: DataFrame, k: int) -> DataFrame:
    """The best ``k`` matching items per query: (query_id, item_id, score, rank); ties by item.

    Each task sends its best ``k`` per query.
    """
    hits = bm25_matches(index, queries, k).hits.select("query_id", "item_id", "score")
    return top_per_group(hits, "query_id", [F.desc("score"), F.asc("item_id")], k)


# ---- normalisation and fusion ----------------------------------------------------------------

def scale(value: Column, low: Column, high: Column) -> Column:
    """Min-max to 0..1; if all values are equal, 0 for zeros and 1 for anything else."""
    return F.when(high == low, F.when(high == 0, 0.0).otherwise(1.0)).otherwise(F.try_divide(value - low, high - low))


def minmax_normalize(scores: DataFrame, group: str = "query_id", value: str = "score", out: str = "normalized") -> DataFrame:
    """Scale the scores of each query. The extremes come from an aggregate, not from a window,
    so a query with very many scores is no single task."""
    extremes = scores.groupBy(F.col(group).alias("__group")).agg(F.min(value).alias("__low"), F.max(value).alias("__high"))
    return (
        scores.join(extremes, F.col(group).eqNullSafe(F.col("__group")))
        .withColumn(out, F.round(scale(F.col(value), F.col("__low"), F.col("__high")), PLACES))
        .drop("__group", "__low", "__high")
    )


def scaled_score(value: Column) -> Column:
    return F.round(scale(value, F.col("low"), F.col("high")), PLACES)


def merge_scores(left: DataFrame, right: DataFrame, left_value: str, right_value: str) -> DataFrame:
    """Union of the keys of two score tables, a missing score is 0."""
    return left.join(right, ["query_id", "item_id"], "full_outer").select(
        "query_id", "item_id",
        F.coalesce(left_value, F.lit(0.0)).alias(left_value),
        F.coalesce(right_value, F.lit(0.0)).alias(right_value),
    )


def hybrid_score(vector: Column, lexical: Column) -> Column:
    return F.round(vocab.VECTOR_WEIGHT * vector + vocab.LEXICAL_WEIGHT * lexical, FUSED_PLACES)


def hybrid_hits(
    corpus: DataFrame, vectors: DataFrame, queries: DataFrame, empty_items: DataFrame, k: int = vocab.TOP_K_TABLES
) -> DataFrame:
    """Top ``k`` per query of 0.7 vector + 0.3 BM25: (query_id, item_id, score, vector, bm25, empty, rank).

    corpus(item_id, text), vectors(item_id, vector), queries(query_id, text, vector),
    empty_items(item_id). The vector side is scaled over the over-fetched neighbours only, the
    BM25 side over the whole corpus. Items found by neither side follow with the score of an
    unmatched item, as far as they are needed to fill up ``k``.
    """
    total = vectors.count()
    with_vector = queries.select("query_id", "vector").where(F.col("vector").isNotNull())
    fetched = nearest(vectors, with_vector, min(max(5 * k, 30), max(total, 1)))
    similarity = fetched.select("query_id", "item_id", (1 - F.col("distance")).alias("score"))
    # a few dozen rows per query; the rest of the plan reads them more than once
    near = written_table(minmax_normalize(similarity, out="vector").drop("score"), "near")
    index = bm25_index(corpus)
    # scaling rounds to six places of the range, so what lies that close below the last may tie with it
    found = bm25_matches(index, queries, k, empty_items, near, tolerance=2 * 10.0**-PLACES)
    bounds = found.bounds.select("query_id", "low", "high")
    unmatched = bounds.select("query_id", scaled_score(F.lit(0.0)).alias("unmatched"))
    best = _fuse(near, found.hits, bounds, empty_items)
    top = written_table(populated_first(best, "query_id", k, F.desc("score")), "fused")
    short = written_table(_queries_to_fill(queries, top, unmatched, k), "short")
    if short.isEmpty():
        return top
    items = corpus.select("item_id").union(vectors.select("item_id")).distinct()
    few = bm25_score(index, queries.join(short.select("query_id"), "query_id", "left_semi"))
    scored = near.join(short, "query_id", "left_semi").select("query_id", "item_id").union(few.select("query_id", "item_id")).distinct()
    filled = _first_unscored(with_empty_flag(items, empty_items), scored, short, k)
    return populated_first(top.drop("rank").unionByName(filled), "query_id", k, F.desc("score"))


def _fuse(near: DataFrame, matches: DataFrame, bounds: DataFrame, empty_items: DataFrame) -> DataFrame:
    """All vector hits, and the best text matches that are no vector hit, with fused scores.

    A query has some dozen rows on either side.
    """
    keys = ["query_id", "item_id"]
    scaled = matches.join(broadcast_if_small(bounds, SUMMARY_BROADCAST), "query_id").select(
        *keys, scaled_score(F.col("score")).alias("bm25"), "empty", F.col("near").alias("hit")
    )
    unmatched = bounds.select("query_id", scaled_score(F.lit(0.0)).alias("unmatched"))
    hits = near.join(scaled.where("hit").select(*keys, "bm25"), keys, "left").join(unmatched, "query_id", "left").select(
        *keys, "vector", F.coalesce("bm25", "unmatched", F.lit(0.0)).alias("bm25")
    )
    flagged = with_empty_flag(hits.select(*keys, hybrid_score(F.col("vector"), F.col("bm25")).alias("score"), "vector", "bm25"), empty_items)
    others = scaled.where("NOT hit").select(*keys, hybrid_score(F.lit(0.0), F.col("bm25")).alias("score"), F.lit(0.0).alias("vector"), "bm25", "empty")
    return flagged.unionByName(others)


def with_empty_flag(rows: DataFrame, empty_items: DataFrame) -> DataFrame:
    """Add ``empty``: true for the listed items, false for all others.

    The list is written, so the join reads two plain tables and adaptive execution can split an
    item with very many rows.
    """
    flags = written_table(empty_items.select("item_id").distinct(), "empty-items").withColumn("empty", F.lit(True))
    return rows.join(flags, "item_id", "left").withColumn("empty", F.coalesce("empty", F.lit(False)))


def _queries_to_fill(queries: DataFrame, top: DataFrame, unmatched: DataFrame, k: int) -> DataFrame:
    """Queries with fewer than ``k`` populated hits that beat an unmatched item."""
    based = top.join(unmatched, "query_id", "left").withColumn("unmatched", F.coalesce("unmatched", F.lit(0.0)))
    ahead = based.where(~F.col("empty") & (F.col("score") > hybrid_score(F.lit(0.0), F.col("unmatched"))))
    counts = ahead.groupBy("query_id").agg(F.count("*").alias("ahead"))
    # a query that matches no text has only zero scores
    return (
        queries.select("query_id").join(counts, "query_id", "left").where(F.coalesce("ahead", F.lit(0)) < k)
        .join(unmatched, "query_id", "left")
        .select("query_id", F.coalesce("unmatched", F.lit(0.0)).alias("unmatched"))
    )


def _first_unscored(items: DataFrame, scored: DataFrame, short: DataFrame, k: int, block: int = 256) -> DataFrame:
    """The first ``k`` items per query, populated ones first, that have no score yet.

    The items are numbered once and their numbers cut into blocks. Per query the scored numbers
    are only counted by block, which tells the full blocks; the first ``k`` others hold the
    answer, so a query is compared with ``k`` blocks of items, however many it has scored.
    """
    numbered = enumerate_rows(items, "empty", "item_id", name="position")
    taken = written_table(
        scored.join(numbered.select("item_id", "position"), "item_id")
        .select("query_id", "position", F.floor(F.col("position") / block).cast("long").alias("block")), "taken",
    )
    total = numbered.agg(F.count("*")).first()[0]
    blocks = -(-total // block)
    size = F.least(F.lit(block), F.lit(total) - F.col("block") * block)
    full = taken.groupBy("query_id", "block").agg(F.count("*").alias("n")).where(F.col("n") == size).select("query_id", "block")
    # the first k numbers that are not full blocks, read off the gaps between those that are
    marks = full.unionByName(short.select("query_id", F.lit(blocks).cast("long").alias("block")))
    window = Window.partitionBy("query_id").orderBy("block")
    gaps = marks.select(
        "query_id", (F.coalesce(F.lag("block").over(window), F.lit(-1)) + 1).alias("start"), F.col("block").alias("stop"),
        (F.row_number().over(window) - 1).alias("before"),
    )
    length = F.least(F.col("stop") - F.col("start"), F.lit(k) - (F.col("start") - F.col("before")))
    open_blocks = gaps.where(length > 0).select("query_id", F.explode(F.sequence(F.col("start"), F.col("start") + length - 1)).alias("block"))
    places = open_blocks.select("query_id", F.explode(F.sequence(F.col("block") * block, F.least((F.col("block") + 1) * block, F.lit(total)) - 1)).alias("position"))
    free = places.join(taken.select("query_id", "position"), ["query_id", "position"], "left_anti")
    first = top_per_group(free, "query_id", [F.asc("position")], k).drop("rank")
    return (
        first.join(numbered, "position").join(short, "query_id")
        .select(
            "query_id", "item_id",
            hybrid_score(F.lit(0.0), F.col("unmatched")).alias("score"),
            F.lit(0.0).alias("vector"), F.col("unmatched").alias("bm25"), "empty",
        )
    )


# ---- vector hits, abstention, values, cache --------------------------------------------------

def vector_hits(
    vectors: DataFrame, queries: DataFrame, empty_items: DataFrame, k: int | None = None, exclude_self: bool = False
) -> DataFrame:
    """Nearest items with populated ones first: over-fetch min(3k, 40, all), re-rank, keep ``k``."""
    k = k or vocab.TOP_K_TABLES
    total = vectors.count()
    if total == 0:
        return constant_frame(vectors.sparkSession, [], "query_id long, item_id long, distance double, empty boolean, rank long")
    fetched = nearest(vectors, queries, min(3 * k, 40, total), exclude_self).drop("rank")
    return populated_first(with_empty_flag(fetched, empty_items), "query_id", k, F.asc("distance"))


def retrieve(
    corpus: DataFrame, vectors: DataFrame, queries: DataFrame, empty_items: DataFrame,
    k: int | None = None, hybrid: bool = False,
) -> DataFrame:
    """(query_id, item_id, distance, rank) from either retriever; a hybrid score counts as 1 - score."""
    if hybrid:
        hits = hybrid_hits(corpus, vectors, queries, empty_items, k or vocab.TOP_K_TABLES)
        return hits.select("query_id", "item_id", F.round(1 - F.col("score"), FUSED_PLACES).alias("distance"), "rank")
    return vector_hits(vectors, queries, empty_items, k).select("query_id", "item_id", "distance", "rank")


def abstain_decision(queries: DataFrame, hits: DataFrame, threshold: float = vocab.ABSTAIN_THRESHOLD) -> DataFrame:
    """Abstain without hits, or if the first hit is farther than the threshold.

    ``hits`` are :func:`vector_hits` with k = 3, so the first one is populated if any of the
    nine nearest is.
    """
    first = hits.where("rank = 1").select("query_id", "item_id", "distance")
    return queries.select("query_id").join(first, "query_id", "left").select(
        "query_id", "item_id", "distance",
        F.coalesce(F.col("distance") > threshold, F.lit(True)).alias("abstain"),
    )


def allowed_only(hits: DataFrame, allowed: DataFrame, column: str) -> DataFrame:
    """Hits whose table is in the allowed set; an empty set means no restriction."""
    if allowed.isEmpty():
        return hits
    return hits.join(allowed.select(column).distinct(), column, "left_semi")


def retrieve_values(values: DataFrame, queries: DataFrame, allowed: DataFrame, k: int = 5, exclude_self: bool = False) -> DataFrame:
    """Nearest value records of values(item_id, vector, table, ...), in allowed tables only.

    The table filter follows the over-fetch of max(4k, 10), so fewer than ``k`` may remain.
    """
    total = values.count()
    fetched = nearest(values.select("item_id", "vector"), queries, min(max(4 * k, 10), max(total, 1)), exclude_self).drop("rank")
    described = fetched.join(values.drop("vector"), "item_id")
    kept = allowed_only(described, allowed, "table")
    return top_per_group(kept, "query_id", [F.asc("distance"), F.asc("item_id")], k)


def match_saved_answers(questions: DataFrame, saved: DataFrame) -> DataFrame:
    """Look questions up among saved ones after normalising both: questions(.., text), saved(question_key, ..).

    The saved side is written, so the join reads two plain tables and adaptive execution can
    split a question that is asked very often.
    """
    keyed = questions.withColumn("question_key", normalize_question(F.col("text")))
    return keyed.join(written_table(saved, "saved-answers"), "question_key")
