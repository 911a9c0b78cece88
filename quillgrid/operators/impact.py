"""An inverted index in blocks of items, and the best matches of queries by impact bounds.

A block holds some hundred items: a head row (its items with their lengths) and one row per term with
the items that hold it, their counts, and the two figures that bound what the term can add to a score there:
the largest count and the shortest length. Tasks make whole blocks from the texts they read, so building an
index shuffles no posting; only one row per block and term is summed for the statistics.

A search takes the lists of its terms, block after block. Once a query has ``k`` matches, its
``k``-th score is a threshold: a block whose bounds stay below it is skipped, and inside a block the terms
are added from the strongest on, items being dropped as soon as their sum and the bounds of the terms
to come stay below (Turtle and Flood 1995; Ding and Suel 2011). What is dropped cannot be among the
best, so the result is that of scoring every match.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import tokenize
from ..session import broadcast_if_small, dealt_out, written_table

BLOCK_ITEMS = 1024
BATCH_TERMS = 500_000  # (query, term) rows of one batch of queries, which travel to all tasks
EMPTY_BROADCAST = 1_000_000
PLACES = 6
BLOCKS = "block long, term string, items array<bigint>, lengths array<int>, counts array<int>, words long, most int, shortest int"
HEAD, EMPTIES, LIST = 0, 1, 2
FOUND = "query_id long, item_id long, score double, empty boolean, near boolean, scored long, covered long, low double"


def index_blocks(corpus: DataFrame, segment: int = 0, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """Blocks of corpus(item_id, text), written. ``segment`` keeps the numbers of added blocks apart.

    A text without words is an item of length 0; rows without id take no part.
    """

    def build(batches):
        block = (segment << 52) + (TaskContext.get().partitionId() << 28)
        for batch in batches:
            for start in range(0, batch.num_rows, block_items):
                part = batch.slice(start, block_items)
                part = part.take(pa.array(np.argsort(part.column(0).to_numpy(), kind="stable")))
                ids, tokens = part.column(0).to_numpy(), part.column(1)
                lengths = tokens.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int32)
                coded = tokens.flatten().dictionary_encode()
                rows = np.repeat(np.arange(len(ids)), lengths)
                held, counts = np.unique(coded.indices.to_numpy().astype(np.int64) * len(ids) + rows, return_counts=True)
                code, slot = np.divmod(held, len(ids))
                starts = np.flatnonzero(np.r_[True, code[1:] != code[:-1]][: len(code)])
                offsets = pa.array(np.r_[starts, len(code)].astype(np.int32))
                lists = lambda values, kind: pa.ListArray.from_arrays(offsets, pa.array(values, kind))
                per_list = lambda ufunc, values: ufunc.reduceat(values, starts) if len(starts) else np.empty(0, np.int64)
                whole = lambda values, kind: pa.array([values], pa.list_(kind))
                columns = {
                    "block": (np.full(len(starts), block), [block], pa.int64()),
                    "term": (coded.dictionary.take(pa.array(code[starts])), [None], pa.string()),
                    "items": (lists(ids[slot], pa.int64()), whole(ids, pa.int64()), pa.list_(pa.int64())),
                    "lengths": (lists(lengths[slot], pa.int32()), whole(lengths, pa.int32()), pa.list_(pa.int32())),
                    "counts": (lists(counts, pa.int32()), whole([], pa.int32()), pa.list_(pa.int32())),
                    "words": (per_list(np.add, counts), [int(lengths.sum(dtype=np.int64))], pa.int64()),
                    "most": (per_list(np.maximum, counts), [0], pa.int32()),
                    "shortest": (per_list(np.minimum, lengths[slot]), [0], pa.int32()),
                }
                for side in (1, 0):
                    arrays = [values if isinstance(values, pa.Array) else pa.array(values, kind) for *sides, kind in columns.values() for values in [sides[side]]]
                    yield pa.RecordBatch.from_arrays(arrays, list(columns))
                block += 1

    texts = dealt_out(corpus.where(F.col("item_id").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), "text"))
    tokens = texts.select("item_id", tokenize(F.col("text")).alias("tokens"))
    return written_table(tokens.mapInArrow(build, BLOCKS), "blocks")


def without_items(blocks: DataFrame, removed: DataFrame) -> DataFrame:
    """The blocks without the items of removed(item_id); figures of the changed lists are made anew.

    Blocks that hold none of them are passed on as they are; the others are known by their heads.
    """
    heads = blocks.where(F.col("term").isNull()).select("block", F.explode("items").alias("item_id"))
    gone = heads.join(broadcast_if_small(written_table(removed.select("item_id").distinct(), "removed"), EMPTY_BROADCAST), "item_id", "left_semi")
    touched = broadcast_if_small(written_table(gone.groupBy("block").agg(F.collect_set("item_id").alias("gone")), "touched-blocks"), EMPTY_BROADCAST // 100)
    marked = blocks.join(touched, "block", "left")
    entries = F.filter(F.arrays_zip("items", "lengths", "counts"), lambda x: ~F.array_contains("gone", x["items"]))
    head = F.filter(F.arrays_zip("items", "lengths"), lambda x: ~F.array_contains("gone", x["items"]))
    kept = marked.withColumn("entries", F.when(F.col("term").isNotNull(), entries)).withColumn("heads", F.when(F.col("term").isNull(), head))
    of = lambda name: F.coalesce(F.col(f"entries.{name}"), F.col(f"heads.{name}") if name != "counts" else F.array().cast("array<int>"))
    total = lambda values: F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)
    changed = kept.where(F.col("gone").isNotNull()).select("block", "term", *[of(n).alias(n) for n in ("items", "lengths", "counts")])
    changed = changed.where(F.size("items") > 0).select(
        "*", F.when(F.col("term").isNull(), total("lengths")).otherwise(total("counts")).alias("words"),
        F.when(F.col("term").isNull(), 0).otherwise(F.array_max("counts")).cast("int").alias("most"),
        F.when(F.col("term").isNull(), 0).otherwise(F.array_min("lengths")).cast("int").alias("shortest"),
    )
    return written_table(marked.where(F.col("gone").isNull()).drop("gone").unionByName(changed), "blocks")


@dataclass(frozen=True)
class Matches:
    """``hits`` (query_id, item_id, score, empty, near) and one row per query that matches anything:
    ``bounds`` (query_id, low, high, scored), where low and high are the extremes over all items and
    ``scored`` counts the matches that were scored in full."""

    hits: DataFrame
    bounds: DataFrame


def best_matches(
    blocks: DataFrame, weights: DataFrame, k: int, documents: int, part: Callable[[np.ndarray, np.ndarray], np.ndarray],
    empty_items: DataFrame | None = None, near: DataFrame | None = None, tolerance: float = 0.0, batch_terms: int = BATCH_TERMS,
) -> Matches:
    """The ``k`` best matches of every query, of empty items apart from the others, ties by id.

    weights(query_id, term, weight), written; ``part(counts, lengths)`` is what a term of weight 1 adds, rising with the
    count and falling with the length. The pairs of near(query_id, item_id) are scored whatever
    their score, and are not among the ``k``. Matches that lie below the ``k``-th by no more than ``tolerance``
    times the largest sum a query can have are kept too, for a caller that rounds scores again.
    """
    batches = -(-weights.count() // batch_terms)
    found = [
        _batch_matches(blocks, of_batch(weights), k, part, empty_items, near and of_batch(near), tolerance)
        for number in range(batches)
        for of_batch in [lambda rows, n=number: rows.where(F.pmod(F.xxhash64(F.col("query_id").cast("long")), F.lit(batches)) == n) if batches > 1 else rows]
    ]
    if not found:
        found = [blocks.sparkSession.createDataFrame([], FOUND)]
    rows = reduce(DataFrame.unionByName, found)
    hits = rows.where(F.col("item_id").isNotNull()).select("query_id", "item_id", "score", "empty", "near")
    per_query = rows.groupBy("query_id").agg(
        F.max("score").alias("top"), F.sum("covered").alias("covered"), F.min("low").alias("least"), F.sum("scored").alias("scored")
    )
    every = F.col("covered") >= documents
    return Matches(hits, written_table(per_query.where(F.col("top").isNotNull()).select(
        "query_id",
        # an item that matches nothing has the score 0
        F.when(every, F.col("least")).otherwise(F.least(F.coalesce("least", F.lit(0.0)), F.lit(0.0))).alias("low"),
        F.when(every, F.col("top")).otherwise(F.greatest("top", F.lit(0.0))).alias("high"), "scored",
    ), "bounds"))


def _batch_matches(blocks, weights, k, part, empty_items, near, tolerance) -> DataFrame:
    spark = blocks.sparkSession
    asked = weights.select("query_id", "term", "weight").toArrow()  # bounded by the caller
    terms = asked.column("term").combine_chunks().dictionary_encode()
    codes = {term: code for code, term in enumerate(terms.dictionary.to_pylist())}
    by_term = np.argsort(terms.indices.to_numpy(), kind="stable")
    starts = np.searchsorted(terms.indices.to_numpy()[by_term], np.arange(len(codes) + 1))
    queries, of_row = np.unique(asked.column("query_id").to_numpy(), return_inverse=True)
    pairs = near.select("query_id", "item_id").toArrow() if near is not None else None  # some dozen per query
    near_of = {}
    if pairs is not None and pairs.num_rows:
        who, what = pairs.column(0).to_numpy(), pairs.column(1).to_numpy()
        order = np.argsort(who, kind="stable")
        cuts = np.flatnonzero(np.r_[True, np.diff(who[order]) != 0, True])
        near_of = {int(who[order[a]]): np.sort(what[order[a:b]]) for a, b in zip(cuts, cuts[1:])}
    weight = asked.column("weight").to_numpy()
    limits = tolerance * np.bincount(of_row, np.abs(weight) * part(np.array([1 << 30]), np.array([0]))[0], minlength=len(queries))
    shared = spark.sparkContext.broadcast((codes, starts, of_row[by_term], weight[by_term], queries, near_of, limits))

    lists = blocks.where(F.col("term").isNotNull())
    wanted = broadcast_if_small(written_table(weights.select("term").distinct(), "asked-terms"), BATCH_TERMS)
    heads = blocks.where(F.col("term").isNull())
    columns = ["block", "term", "items", "lengths", "counts", "most", "shortest"]
    stream = lists.join(wanted, "term", "left_semi").select(F.lit(LIST).alias("kind"), *columns).unionByName(heads.select(F.lit(HEAD).alias("kind"), *columns))
    if empty_items is not None:
        listed = broadcast_if_small(written_table(empty_items.select("item_id").distinct(), "empty-items"), EMPTY_BROADCAST)
        flags = heads.select("block", F.explode("items").alias("item_id")).join(listed, "item_id", "left_semi")
        none = F.array().cast("array<int>")
        stream = stream.unionByName(flags.groupBy("block").agg(F.collect_list("item_id").alias("items")).select(
            F.lit(EMPTIES).alias("kind"), "block", F.lit(None).cast("string").alias("term"), "items", none.alias("lengths"), none.alias("counts"),
            F.lit(0).alias("most"), F.lit(0).alias("shortest"),
        ))
    # a fixed number: the work is in the search, and few bytes are no reason to put all blocks into one task
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = stream.repartition(tasks, "block").sortWithinPartitions("block", "kind")

    def blocks_of(batches):
        """Rows of one block together: (items, empty flags, lists)."""
        current, items, empty, held = None, None, None, []
        for batch in batches:
            kinds, numbers = batch.column("kind").to_pylist(), batch.column("block").to_pylist()
            names, most, shortest = (batch.column(c).to_pylist() for c in ("term", "most", "shortest"))
            parts_of = {c: (batch.column(c).offsets.to_pylist(), batch.column(c).values.to_numpy(zero_copy_only=False)) for c in ("items", "lengths", "counts")}

            def values(c, i):
                offsets, flat = parts_of[c]
                return flat[offsets[i]:offsets[i + 1]]

            for i, (kind, number) in enumerate(zip(kinds, numbers)):
                if number != current:
                    if held:
                        yield items, empty, held
                    current, held = number, []
                if kind == HEAD:
                    items = values("items", i)
                    empty = np.zeros(len(items), bool)
                elif kind == EMPTIES:
                    empty[np.searchsorted(items, values("items", i))] = True
                else:
                    held.append((names[i], most[i], shortest[i], values("items", i), values("lengths", i), values("counts", i)))
        if held:
            yield items, empty, held

    def rounded(scores):
        return np.floor(scores * 10.0**PLACES + 0.5) / 10.0**PLACES

    def kept(best, ids, scores, limit):
        """The best ``k`` of what was there and what came, and those that differ from the last by ``limit`` at most."""
        ids, scores = np.concatenate([best[0], ids]), np.concatenate([best[1], scores])
        order = np.lexsort((ids, -scores))
        ids, scores = ids[order], scores[order]
        if len(ids) > k:
            among_equals = np.arange(len(ids)) - np.searchsorted(-scores, -scores)
            chosen = (scores >= scores[k - 1] - limit) & (among_equals < k) if limit else np.arange(len(ids)) < k
            ids, scores = ids[chosen], scores[chosen]
        return ids, scores

    def search(batches):
        codes, starts, query_of, weight_of, names, near_of, limits = shared.value
        nothing = (np.empty(0, np.int64), np.empty(0))
        best = {}  # per query: the best populated items, the best empty ones
        near_rows, scored, covered, low, uncovered = [], {}, {}, {}, set()
        for items, empty, held in blocks_of(batches):
            edges = np.cumsum([len(x[3]) for x in held])[:-1]
            slots = np.split(np.searchsorted(items, np.concatenate([x[3] for x in held])), edges)
            parts = np.split(part(np.concatenate([x[5] for x in held]), np.concatenate([x[4] for x in held])), edges)
            peak = part(np.array([x[1] for x in held]), np.array([x[2] for x in held]))
            spans = [range(starts[codes[x[0]]], starts[codes[x[0]] + 1]) for x in held]
            rows = np.concatenate([np.arange(s.start, s.stop) for s in spans])
            which = np.repeat(np.arange(len(held)), [len(s) for s in spans])
            weights_here, queries_here = weight_of[rows], query_of[rows]
            bound = weights_here * peak[which]
            # per query: lists that lower a score first, then from the strongest on
            order = np.lexsort((np.where(weights_here < 0, -np.inf, -bound), queries_here))
            cuts = np.flatnonzero(np.r_[True, np.diff(queries_here[order]) != 0, True])
            for a, b in zip(cuts, cuts[1:]):
                chosen = order[a:b]
                q = int(queries_here[chosen[0]])
                query, limit = int(names[q]), limits[q]
                tops = best.setdefault(q, [nothing, nothing])
                slack = limit + 4 * 10.0**-PLACES
                known = [top[1][k - 1] - slack if len(top[1]) >= k else -np.inf for top in tops]
                to_come = np.maximum(bound[chosen], 0.0)[::-1].cumsum()[::-1]
                mine = near_of.get(query)
                close = np.isin(items, mine) if mine is not None else None
                if close is not None and not close.any():
                    close = None
                negative = weights_here[chosen[0]] < 0
                touched = np.zeros(len(items), bool)
                cover = q not in uncovered
                if cover:
                    if sum(len(slots[which[i]]) for i in chosen) >= len(items):
                        for i in chosen:
                            touched[slots[which[i]]] = True
                    cover = bool(touched.all())
                    if cover:
                        covered[q] = covered.get(q, 0) + len(items)
                    else:
                        uncovered.add(q)
                        touched[:] = False
                everything = cover or negative
                reachable = known[0] if not empty.any() else min(known)
                if not everything and close is None and to_come[0] < reachable:
                    continue
                threshold = np.where(empty, known[1], known[0])
                sums, candidates = np.zeros(len(items)), None
                for n, i in enumerate(chosen):
                    at = which[i]
                    sums[slots[at]] += weights_here[i] * parts[at]
                    touched[slots[at]] = True
                    if everything or n + 1 == len(chosen):
                        continue
                    rest = to_come[n + 1]
                    if candidates is None and n % 3 == 2:
                        # sums of some terms are lower bounds of the scores, so the k-th of them is one of the k-th score
                        for flag in (False, True):
                            these = touched & (empty == flag)
                            if close is not None:
                                these &= ~close
                            if np.count_nonzero(these) >= k:
                                kth = np.partition(sums[these], -k)[-k] - slack
                                threshold[empty == flag] = np.maximum(threshold[empty == flag], kth)
                        if rest < threshold.min():
                            candidates = np.flatnonzero(touched)
                    if candidates is not None:
                        alive = sums[candidates] + rest >= threshold[candidates]
                        if close is not None:
                            alive |= close[candidates]
                        candidates = candidates[alive]
                        if not len(candidates) and close is None:
                            break
                if close is not None and candidates is not None:
                    candidates = np.union1d(candidates, np.flatnonzero(close & touched))
                if candidates is None:
                    candidates = np.flatnonzero(touched)
                scores = rounded(sums[candidates])
                scored[q] = scored.get(q, 0) + len(candidates)
                if everything and len(scores):
                    low[q] = min(low.get(q, np.inf), scores.min())
                others = np.ones(len(candidates), bool)
                if close is not None:
                    others = ~close[candidates]
                    for c, s in zip(candidates[~others], scores[~others]):
                        near_rows.append((query, int(items[c]), float(s), bool(empty[c])))
                for flag in (0, 1):
                    these = others & (empty[candidates] == flag)
                    if these.any():
                        tops[flag] = kept(tops[flag], items[candidates[these]], scores[these], limit)
        out = [(names[q], i, s, bool(flag), False) for q, tops in best.items() for flag, top in enumerate(tops) for i, s in zip(top[0].tolist(), top[1].tolist())]
        out += [(*row, True) for row in near_rows]
        stats = [(int(names[q]), scored.get(q, 0), covered.get(q, 0), low.get(q)) for q in best]
        columns = list(zip(*out)) or [()] * 5
        blank = [None] * len(stats)
        sums = list(zip(*stats)) or [()] * 4
        values = [list(columns[0]) + list(sums[0]), *(list(c) + blank for c in columns[1:]), *([None] * len(out) + list(c) for c in sums[1:])]
        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.float64()]
        names_out = [column.split()[0] for column in FOUND.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(v, kind) for v, kind in zip(values, kinds)], names_out)

    return written_table(dealt.mapInArrow(search, FOUND), "matches")
