"""Hard negatives by threshold joins of anchors with an inverted index of all vectors.

Components become ``floor(256 * x)``, and a score is the inner product of two such vectors. The vectors are stored
once in blocks, as lists per dimension (the dimensions with the largest values first). For a batch of anchors and
the scores they ask for, a task builds the lists of its block without the part that cannot matter: from
the place on where the norm of a vector's remaining components times the norm of the anchor's
remaining ones is below every anchor's threshold, its components are not indexed (Anastasiu and Karypis, ICDE
2014). Partial scores are accumulated list by list, and pairs whose partial score plus the product of the remaining norms
stays below the threshold are pruned; what survives is scored in full. The bounds only ever rule
out pairs that a threshold rules out, so the result is exact.

A window is a range of scores of which the first few rows are wanted: the positives of an anchor (same
label), or the negatives under one positive (other labels). Thresholds start near the top of a window
and are lowered for those windows only that are not full yet, down to the end of the window. A block
sends no more than the wanted rows of each window.

Rows without id, label or vector, or with a component that is null or not finite, take no part.
Vectors of different lengths are compared over their common components. Rows that share an id are
never positives or negatives of each other, and each is an anchor of its own. Scores are exact
also beyond 2**53; beyond the range of a long they are given as plus or minus its largest value. Few rows, equal
scores (ties go to the smaller id) and empty tables need no special care of the caller.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import constant_frame, written_table
from .common import in_tasks

SCALE = 256
BLOCK_ROWS = 4096
BATCH_VALUES = 2_000_000  # components of the anchors of one batch, which travels to all tasks
LISTS = 8  # dimensions that are accumulated between two rounds of pruning
FEW = 16  # survivors are scored one by one once fewer than one pair in so many is left
WANTED = 5
POSITIVE_STEPS = (0.5, 0.3, None)  # thresholds of positives as parts of the largest possible score
NEGATIVE_STEPS = (0.94, 0.87)  # parts of the positive's score; then the lower end
LOW_PERCENT, HIGH_PERCENT = 80, 100
HITS = "anchor long, window long, item_id long, score long"
LARGEST = np.iinfo(np.int64).max
NO_END = np.iinfo(np.int64).min  # a window without lower end

HARD_NEGATIVES_SQL = """
    WITH usable AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    scored AS (
        SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
               CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
        FROM usable a JOIN usable b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
    ),
    positives AS (
        SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
    )
    SELECT anchor_id, positive_id,
           CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
           other_id AS negative_id, positive_score, score AS negative_score
    FROM positives JOIN scored USING (anchor_id)
    WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
    QUALIFY rank <= 5
"""


def usable_rows(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(id, label, vector) of the rows that take part."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("long").alias("label"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("vector"),
    )
    return rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & F.forall("vector", finite))


def padded(column: pa.Array) -> np.ndarray:
    """Lists of numbers as the rows of a matrix, short ones filled up with zeros, scaled and floored."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    with np.errstate(over="ignore"):
        flat = np.clip(np.floor(SCALE * flat), -np.finfo(float).max, np.finfo(float).max)
    matrix = np.zeros((len(lengths), max(int(lengths.max(initial=0)), 1)))
    matrix[np.arange(matrix.shape[1])[None, :] < lengths[:, None]] = flat
    return matrix


@dataclass
class Anchors:
    """A batch of anchors and the windows they ask for; a window belongs to the anchor at ``of``."""

    keys: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    of: np.ndarray
    windows: np.ndarray
    low: np.ndarray
    high: np.ndarray
    same: bool


def suffix_norms(matrix: np.ndarray, bounds: list[int]) -> np.ndarray:
    """Norms of the components from every bound on, (rows, bounds)."""
    squares = np.cumsum((matrix * matrix)[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(np.column_stack([squares[:, b] if b < matrix.shape[1] else np.zeros(len(matrix)) for b in bounds]))


def exact_scores(left: np.ndarray, right: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Integer inner products of the chosen pairs; Python integers where doubles would round."""
    largest = np.abs(left).max(initial=0) * np.abs(right).max(initial=0) * left.shape[1]
    if largest < 2**53:
        out = np.empty(len(rows), np.int64)
        for start in range(0, len(rows), 65_536):
            part = slice(start, start + 65_536)
            out[part] = np.einsum("ij,ij->i", left[rows[part]], right[columns[part]])
        return out
    whole = lambda vector: [int(x) for x in vector]
    ints = (sum(a * b for a, b in zip(whole(left[i]), whole(right[j]))) for i, j in zip(rows, columns))
    return np.array([min(max(x, -LARGEST), LARGEST) for x in ints], np.int64)


def surviving_pairs(queries: np.ndarray, items: np.ndarray, threshold: np.ndarray, allowed) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, item) whose score may reach the query's threshold.

    ``allowed`` gives the pairs that may be asked for, for items in the given order.
    """
    width = items.shape[1]
    order = np.argsort(-(items * items).sum(0), kind="stable")
    queries, items = queries[:, order], items[:, order]
    bounds = [*range(0, width, LISTS), width]
    of_queries, of_items = suffix_norms(queries, bounds), suffix_norms(items, bounds)
    # doubles round: a bound is taken a little higher than it is
    slack = 1e-9 * (1 + of_queries[:, :1] * of_items[:, 0].max(initial=0))
    need = threshold[:, None] - slack
    # lists left out: from this bound on no query can gain enough from the rest of the item alone
    with np.errstate(divide="ignore", invalid="ignore"):
        free = np.where(of_queries > 0, need / of_queries, np.where(need > 0, np.inf, -np.inf)).min(axis=0)
    covered = of_items < free[None, :]
    indexed = np.where(covered.any(axis=1), covered.argmax(axis=1), len(bounds) - 1)
    by_length = np.argsort(-indexed, kind="stable")
    items, of_items, indexed = items[by_length], of_items[by_length], indexed[by_length]
    partial = np.zeros((len(queries), len(items)))
    alive = allowed(by_length)
    alive[:, indexed == 0] = False
    for k in range(len(bounds) - 1):
        listed = int(np.searchsorted(-indexed, -k, side="left"))  # items that have these lists
        if not listed:
            break
        part = slice(bounds[k], bounds[k + 1])
        partial[:, :listed] += queries[:, part] @ items[:listed, part].T
        rest = of_queries[:, k + 1][:, None] * of_items[:listed, k + 1][None, :]
        alive[:, :listed] &= partial[:, :listed] + rest >= need
        if np.count_nonzero(alive) * FEW <= alive.size:
            break
    rows, columns = np.nonzero(alive)
    return rows, by_length[columns]


def block_hits(ids: np.ndarray, labels: np.ndarray, items: np.ndarray, asked: Anchors, wanted: int) -> list[np.ndarray]:
    """The first ``wanted`` rows of every window in one block: anchor keys, windows, item ids, scores."""
    width = max(items.shape[1], asked.vectors.shape[1])
    widen = lambda m: np.pad(m, ((0, 0), (0, width - m.shape[1])))
    items, vectors = widen(items), widen(asked.vectors)
    lowest = np.full(len(asked.keys), np.inf)
    np.minimum.at(lowest, asked.of, np.where(asked.low == NO_END, -np.inf, asked.low.astype(np.float64)))
    asking = lowest < np.inf
    found = []
    # positives are searched label by label, negatives among all labels
    for label in np.intersect1d(labels, asked.labels) if asked.same else [None]:
        mine = np.flatnonzero(asking & (asked.labels == label) if asked.same else asking)
        theirs = np.flatnonzero(labels == label) if asked.same else np.arange(len(ids))
        if not len(mine) or not len(theirs):
            continue

        def allowed(order):
            other = asked.ids[mine][:, None] != ids[theirs][order][None, :]
            return other if asked.same else other & (asked.labels[mine][:, None] != labels[theirs][order][None, :])

        rows, columns = surviving_pairs(vectors[mine], items[theirs], lowest[mine], allowed)
        found.append((mine[rows], theirs[columns], exact_scores(vectors, items, mine[rows], theirs[columns])))
    if not found:
        return [np.empty(0, np.int64)] * 4
    anchor, item, score = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((ids[item], -score, anchor))
    anchor, item, score = anchor[order], item[order], score[order]
    starts, ends = np.searchsorted(anchor, np.arange(len(asked.keys))), np.searchsorted(anchor, np.arange(len(asked.keys)), side="right")
    out = [[], [], [], []]
    for window, (of, low, high) in enumerate(zip(asked.of, asked.low, asked.high)):
        mine = score[starts[of]:ends[of]]  # falling
        if not len(mine) or mine[0] < low:
            continue
        # the first row at or below the upper end, and the first below the lower one
        begin = int(np.searchsorted(-mine, -high, side="left"))
        end = len(mine) if low == NO_END else int(np.searchsorted(-mine, -low, side="right"))
        end = min(end, begin + wanted)
        if begin < end:
            chosen = slice(starts[of] + begin, starts[of] + end)
            out[0].append(np.full(end - begin, asked.keys[of]))
            out[1].append(np.full(end - begin, asked.windows[window]))
            out[2].append(ids[item[chosen]])
            out[3].append(score[chosen])
    return [np.concatenate(x) if x else np.empty(0, np.int64) for x in out]


def index_blocks(rows: DataFrame) -> DataFrame:
    """(ids, labels, width, kind, vectors): blocks of scaled vectors in the smallest exact number type."""

    def build(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS)
                matrix = padded(part.column(2))
                kind = next((k for k in ("<i2", "<i4") if np.abs(matrix).max(initial=0) <= np.iinfo(k).max), "<f8")
                numbers = [part.column(i).to_numpy(zero_copy_only=False).astype("<i8").tobytes() for i in (0, 1)]
                yield pa.RecordBatch.from_pydict({
                    "ids": pa.array([numbers[0]], pa.binary()), "labels": pa.array([numbers[1]], pa.binary()),
                    "width": pa.array([matrix.shape[1]], pa.int64()), "kind": pa.array([kind], pa.string()),
                    "vectors": pa.array([matrix.astype(kind).tobytes()], pa.binary()),
                })

    return written_table(in_tasks(rows, build, "ids binary, labels binary, width long, kind string, vectors binary"), "vector-lists")


def window_hits(blocks: DataFrame, asked: Anchors, wanted: int) -> DataFrame:
    """(anchor, window, item_id, score, rank): the first ``wanted`` rows of every window over all blocks, written."""
    shared = blocks.sparkSession.sparkContext.broadcast(asked)

    def scan(batches):
        for batch in batches:
            for ids, labels, width, kind, vectors in zip(*(column.to_pylist() for column in batch.columns)):
                items = np.frombuffer(vectors, kind).reshape(-1, width).astype(np.float64)
                hits = block_hits(np.frombuffer(ids, "<i8"), np.frombuffer(labels, "<i8"), items, shared.value, wanted)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in hits], ["anchor", "window", "item_id", "score"])

    first = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), F.asc("item_id"))
    best = in_tasks(blocks, scan, HITS).withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= wanted)
    return written_table(best, "window-hits")


def by_falling_thresholds(blocks: DataFrame, batch: pa.Table, windows: pa.Table, steps: list[np.ndarray], same: bool, wanted: int) -> DataFrame:
    """The first ``wanted`` rows of every window, asked for with each threshold in turn until it is full.

    ``batch`` are anchors (key, id, label, vector), ``windows`` (key, window, high); a step has the threshold of
    every window, the last one its lower end.
    """
    keys = batch.column("key").to_numpy()
    by_key = np.argsort(keys)
    of = by_key[np.searchsorted(keys[by_key], windows.column("key").to_numpy())]
    names, high = windows.column("window").to_numpy(), windows.column("high").to_numpy()
    vectors = padded(batch.column("vector").combine_chunks())
    open_windows, found = np.arange(len(of)), []
    for step, low in enumerate(steps):
        asked = Anchors(
            keys, batch.column("id").to_numpy(), batch.column("label").to_numpy(), vectors,
            of[open_windows], names[open_windows], low[open_windows], high[open_windows], same,
        )
        hits = window_hits(blocks, asked, wanted)
        if step == len(steps) - 1:
            found.append(hits)
            break
        full = hits.groupBy("anchor", "window").agg(F.count("*").alias("n")).where(F.col("n") >= wanted).select("anchor", "window")
        found.append(hits.join(full, ["anchor", "window"], "left_semi"))
        done = full.toArrow()  # at most the windows of the batch
        pairs = set(zip(done.column(0).to_pylist(), done.column(1).to_pylist()))
        open_windows = np.array([w for w in open_windows if (int(keys[of[w]]), int(names[w])) not in pairs], np.int64)
        if not len(open_windows):
            break
    return reduce(DataFrame.unionByName, found)


def mine_hard_negatives(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "vector", label_col: str = "label", every: int = 100,
    wanted: int = WANTED, batch_values: int = BATCH_VALUES,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose id is divisible by ``every``. They go to the blocks in batches of
    ``batch_values`` components, so that what travels is bounded however many anchors there are.
    """
    spark = vectors.sparkSession
    rows = usable_rows(vectors, id_col, vector_col, label_col)
    blocks = index_blocks(rows)
    anchors = written_table(rows.where(F.col("id") % every == 0).withColumn("key", F.monotonically_increasing_id()), "anchors")
    size = anchors.agg(F.count("*").alias("rows"), F.max(F.size("vector")).alias("width")).first()
    per_batch = max(1, batch_values // max(size["width"] or 1, 1))
    batches = -(-size["rows"] // per_batch)
    # hashing deals uneven batches: a margin keeps them under twice the size
    batches = batches if batches <= 1 else 2 * batches
    out = []
    for number in range(batches):
        batch = anchors.where(F.pmod(F.xxhash64("key"), F.lit(batches)) == number).toArrow()
        if not batch.num_rows:
            continue
        keys = batch.column("key").to_numpy()
        scaled = padded(batch.column("vector").combine_chunks())
        reach = (scaled * scaled).sum(1)  # an equal vector's score
        windows = pa.table({"key": keys, "window": np.zeros(len(keys), np.int64), "high": np.full(len(keys), LARGEST)})
        steps = [np.full(len(keys), NO_END) if part is None else np.minimum(part * reach, 2.0**62).astype(np.int64) for part in POSITIVE_STEPS]
        positives = by_falling_thresholds(blocks, batch, windows, steps, True, wanted)
        pairs = positives.select("anchor", F.col("rank").cast("long").alias("window"), "score").toArrow()  # a few rows per anchor of the batch
        score = pairs.column("score").to_numpy()
        # a window reaches down to 80 percent of its positive; below zero it would end above its start
        asking = score >= 0
        pairs, score = pairs.filter(pa.array(asking)), score[asking]
        if not len(score):
            continue
        windows = pa.table({"key": pairs.column("anchor").to_numpy(), "window": pairs.column("window").to_numpy(), "high": score})
        lowest = np.array([-(-LOW_PERCENT * int(s) // HIGH_PERCENT) for s in score], np.int64)
        steps = [np.maximum(lowest, (part * score).astype(np.int64)) for part in NEGATIVE_STEPS] + [lowest]
        negatives = by_falling_thresholds(blocks, batch, windows, steps, False, wanted)
        named = written_table(
            positives.select("anchor", F.col("rank").cast("long").alias("window"), F.col("item_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives"
        ).join(anchors.select(F.col("key").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
        out.append(negatives.join(named, ["anchor", "window"]).select(
            "anchor_id", "positive_id", "rank", F.col("item_id").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score"),
        ))
    if not out:
        return constant_frame(spark, [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    return reduce(DataFrame.unionByName, out)
