"""Exact nearest neighbours by squared Euclidean distance.

Distances are rounded to six places and ties go to the smaller id, so the result does not
depend on how the rows are partitioned.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import constant_frame, written_table
from .ordering import top_per_group

PLACES = 6
BROADCAST_VALUES = 4_000_000  # 32 MB of doubles
BLOCK_ROWS = 4096
LEAST_CELLS, MOST_CELLS = 64, 4096  # the pivots travel with every task
GRID_ROWS = 32_768  # of either side in a block that is compared as a whole
GROUPS_PER_CORE = 6
TILE = 1024  # queries, and items, whose products are in memory at a time
SAMPLE_ROWS = 1000  # queries that tell whether cells are worth while
HIT = "query_id long, item_id long, distance double"


def _kernel(n: int, exclude_self: bool):
    """Numpy helpers as closures, which travel to the tasks by value."""

    def matrix(column) -> np.ndarray:
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))

    def squared(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        inner = left @ right.T
        lengths = (left * left).sum(1)[:, None] + (right * right).sum(1)[None, :]
        return np.maximum(lengths - 2.0 * inner, 0.0)

    def keep(query, item, distance):
        """The first n rows per query of a flat candidate list."""
        order = np.lexsort((item, distance, query))
        query, item, distance = query[order], item[order], distance[order]
        if not len(query):
            return query, item, distance
        starts = np.flatnonzero(np.r_[True, query[1:] != query[:-1]])
        position = np.arange(len(query)) - np.repeat(starts, np.diff(np.r_[starts, len(query)]))
        chosen = position < n
        return query[chosen], item[chosen], distance[chosen]

    def between(left, rows, right, columns) -> np.ndarray:
        """Distance of the chosen pairs by their differences, rounded as SQL rounds."""
        exact = np.empty(len(rows))
        for start in range(0, len(rows), 100_000):
            part = slice(start, start + 100_000)
            exact[part] = ((left[rows[part]] - right[columns[part]]) ** 2).sum(1)
        return np.floor(exact * 10.0**PLACES + 0.5) / 10.0**PLACES

    def distinct(ids, vectors):
        """Items by id, of equal vectors the first n + 1: no query has use for more of them."""
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], np.ascontiguousarray(vectors[order])
        if len(ids) <= n + 1 or not vectors.shape[1]:
            return ids, vectors
        _, kind = np.unique(vectors.view(np.dtype((np.void, vectors.itemsize * vectors.shape[1]))).ravel(), return_inverse=True)
        order = np.argsort(kind, kind="stable")
        starts = np.flatnonzero(np.r_[True, np.diff(kind[order]) > 0])
        position = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
        chosen = np.sort(order[position <= n])
        return ids[chosen], vectors[chosen]

    def nth(rows, values, count) -> np.ndarray:
        """The n-th smallest value of each row, infinite if it has fewer; no value is negative."""
        out = np.full(count, np.inf)
        if len(rows):
            single = values.dtype == np.float32  # in order of their bits
            order = np.argsort((rows.astype(np.uint64) << np.uint64(32)) | values.view(np.uint32)) if single else np.lexsort((values, rows))
            starts = np.searchsorted(rows[order], np.arange(count + 1))
            full = np.flatnonzero(np.diff(starts) >= n)
            out[full] = values[order[starts[full] + n - 1]]
        return out

    def select(query_ids, queries, item_ids, items, limit):
        """(row, column) of the pairs that may be among the best n; ``limit`` bounds each query's n-th distance.

        A product in single precision decides on most pairs, with a margin above its error. If
        that lets many through, as with values far apart in size, the tile is taken in double precision.
        """
        middle = np.median(queries, axis=0)
        left, right = queries - middle, items - middle
        left_size, right_size = (left * left).sum(1), (right * right).sum(1)
        single = left_size.max() + right_size.max() < 1e30
        rounding = 2 * 10.0**-PLACES
        # pairs and the bounds of their distances
        rows, columns = np.empty(0, np.int64), np.empty(0, np.int64)
        least, most = np.empty(0), np.empty(0, np.float32 if single else np.float64)
        sides = {}

        def nearness(kind, start):
            """Half of what a pair's distance is at least below its query's size, at most."""
            if kind not in sides:
                error = (left.shape[1] + 16) * np.finfo(kind).eps
                item_side = np.c_[right, (error - 1) * right_size / 2].astype(kind)
                sides[kind] = error, np.c_[left, np.ones(len(left))].astype(kind), item_side
            error, query_side, item_side = sides[kind]
            inner = query_side @ item_side[start:start + TILE].T
            if exclude_self:
                ids = item_ids[start:start + TILE]
                first = np.searchsorted(ids, query_ids)
                times = np.searchsorted(ids, query_ids, side="right") - first
                own = np.repeat(np.arange(len(times)), times)
                inner[own, first[own] + np.arange(len(own)) - np.repeat(np.cumsum(times) - times, times)] = -np.inf
            return error, inner

        for start in range(0, len(items), TILE):
            sizes = right_size[start:start + TILE]
            for kind in (np.float32, np.float64) if single else (np.float64,):
                error, inner = nearness(kind, start)
                if inner.shape[1] > n and np.isinf(limit).any():
                    sure = np.partition(inner - (error * sizes).astype(kind), inner.shape[1] - n, axis=1)[:, inner.shape[1] - n]
                    limit = np.minimum(limit, (1 + error) * left_size - 2 * sure.astype(np.float64))
                chosen = inner > (((1 - error) * left_size - limit - rounding) / 2).astype(kind)[:, None]
                passed = np.flatnonzero(chosen)
                if kind is np.float64 or len(passed) <= 8 * n * len(queries):
                    break
            row, column = np.divmod(passed, inner.shape[1])
            low = np.maximum((1 - error) * left_size[row] - 2 * inner[row, column].astype(np.float64), 0.0)
            high = (low + 2 * error * (left_size[row] + sizes[column])).astype(most.dtype)
            rows, columns = np.concatenate([rows, row]), np.concatenate([columns, column + start])
            least, most = np.concatenate([least, low]), np.concatenate([most, np.nextafter(high, most.dtype.type(np.inf))])
            if len(rows) > 3 * n * len(queries) or start + TILE >= len(items):
                limit = np.minimum(limit, nth(rows, most, len(queries)))
                near = least <= (limit + rounding)[rows]
                rows, columns, least, most = rows[near], columns[near], least[near], most[near]
        return rows, columns

    def search(query_ids, queries, batches):
        """The best n of all batches (ids, vectors) per query, as flat lists by tiles of queries."""
        tiles = [slice(start, start + TILE) for start in range(0, len(query_ids), TILE)]
        best = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)) for _ in tiles]
        limits = np.full(len(query_ids), np.inf)
        for ids, vectors in batches:
            if not len(ids):
                continue
            ids, vectors = distinct(ids, vectors)
            for number, tile in enumerate(tiles):
                rows, columns = select(query_ids[tile], queries[tile], ids, vectors, limits[tile])
                found = rows, ids[columns], between(queries[tile], rows, vectors, columns)
                best[number] = keep(*(np.concatenate(pair) for pair in zip(best[number], found)))
                limits[tile] = np.minimum(limits[tile], nth(best[number][0], best[number][2], len(query_ids[tile])))
        for tile, (rows, items, distance) in zip(tiles, best):
            yield query_ids[tile][rows], items, distance

    return matrix, squared, search


def nearest(
    corpus: DataFrame,
    queries: DataFrame,
    n: int,
    exclude_self: bool = False,
    broadcast_values: int = BROADCAST_VALUES,
    block_rows: int = BLOCK_ROWS,
    cells: int | None = None,
) -> DataFrame:
    """The ``n`` nearest corpus items per query: (query_id, item_id, distance, rank).

    corpus(item_id, vector), queries(query_id, vector); rows without a vector take no part. A batch of
    queries below ``broadcast_values`` numbers travels to the corpus, which is then read once
    and not shuffled. A larger batch is joined cell by cell, see :func:`_by_cells`; the number of
    cells follows the number of items. Where cells exclude little, see :func:`_by_grid`.
    """
    corpus = corpus.select(F.col("item_id").cast("long").alias("item_id"), "vector").dropna()
    queries = queries.select(F.col("query_id").cast("long").alias("query_id"), "vector").dropna()
    size = queries.agg(F.count("*").alias("rows"), F.max(F.size("vector")).alias("width")).first()
    if size["rows"] == 0:
        return constant_frame(queries.sparkSession, [], HIT + ", rank long")
    if size["rows"] * size["width"] <= broadcast_values:
        hits = _by_broadcast(corpus, queries, n, exclude_self)
    else:
        # about a block of items per cell, so that a cell is rarely paired with itself in parts
        wanted = cells or max(LEAST_CELLS, min(MOST_CELLS, corpus.count() // block_rows))
        hits = _by_cells(corpus, queries, n, exclude_self, block_rows, wanted)
    return top_per_group(hits, "query_id", [F.asc("distance"), F.asc("item_id")], n)


def _by_broadcast(corpus: DataFrame, queries: DataFrame, n: int, exclude_self: bool) -> DataFrame:
    table = queries.toArrow()  # size checked by the caller
    matrix, _, search = _kernel(n, exclude_self)
    query_ids = table.column("query_id").to_numpy()
    shared = queries.sparkSession.sparkContext.broadcast((query_ids, matrix(table.column("vector"))))

    def scan(batches):
        parts = ((b.column(0).to_numpy(zero_copy_only=False), matrix(b.column(1))) for b in batches)
        for found in search(*shared.value, parts):
            yield pa.RecordBatch.from_arrays([pa.array(a) for a in found], ["query_id", "item_id", "distance"])

    return corpus.mapInArrow(scan, HIT)


def _matches(asks: DataFrame, items: DataFrame, block: list[str], n: int, exclude_self: bool) -> DataFrame:
    """The best ``n`` of each query in every block that both sides have."""
    matrix, _, search = _kernel(n, exclude_self)

    def match(left: pa.Table, right: pa.Table) -> pa.Table:
        found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
        if left.num_rows and right.num_rows:
            part = right.column("item_id").to_numpy(), matrix(right.column("vector"))
            found += search(left.column("query_id").to_numpy(), matrix(left.column("vector")), [part])
        return pa.table(dict(zip(("query_id", "item_id", "distance"), map(np.concatenate, zip(*found)))))

    return asks.groupBy(*block).cogroup(items.groupBy(*block)).applyInArrow(match, HIT)


def _every(blocks):
    return F.explode(F.sequence(F.lit(0), F.lit(blocks) - 1 if isinstance(blocks, int) else F.col(blocks) - 1))


def _by_grid(corpus: DataFrame, queries: DataFrame, n: int, exclude_self: bool, rows: int = GRID_ROWS) -> DataFrame:
    """Every block of queries with every block of items, for vectors that cells cannot keep apart.

    A block has about ``rows`` rows at most, so a task's memory does not grow with the tables. With few
    blocks the queries are cut finer, until all cores have work.
    """
    spark = corpus.sparkSession
    item_blocks = -(-corpus.count() // rows)
    if not item_blocks:
        return constant_frame(spark, [], HIT)
    wanted = -(-GROUPS_PER_CORE * spark.sparkContext.defaultParallelism // item_blocks)
    asked = queries.count()
    query_blocks = max(-(-asked // rows), min(wanted, -(-asked // TILE)))
    block_of = lambda key, blocks: F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")
    items = corpus.select("item_id", F.col("vector").alias("vector"), block_of("item_id", item_blocks).alias("item_block"), _every(query_blocks).alias("query_block"))
    # both sides may come from one table: a name of its own keeps their columns apart
    asks = queries.select("query_id", F.col("vector").alias("vector"), _every(item_blocks).alias("item_block"), block_of("query_id", query_blocks).alias("query_block"))
    return _matches(asks, items, ["item_block", "query_block"], n, exclude_self)


def _by_cells(corpus: DataFrame, queries: DataFrame, n: int, exclude_self: bool, block_rows: int, cells: int, most: float = 0.5) -> DataFrame:
    """Join both sides by cells around pivot vectors, skipping cells that cannot hold a neighbour.

    The triangle inequality bounds a query's n-th distance from above and its distance to a cell
    from below (Lu et al., VLDB 2012). A cell is cut into blocks of about ``block_rows`` rows on
    either side, so a cell with most of the rows, as with many copies of one vector, is
    many tasks. All figures that reach the driver have at most ``cells`` times ``n`` rows.

    Some queries are tried first: if they reach more than ``most`` of the items, cells would only
    copy the queries, and all blocks are compared as they are.
    """
    matrix, squared, _ = _kernel(n, exclude_self)
    spark = corpus.sparkSession
    pivots = matrix(corpus.orderBy(F.xxhash64("item_id"), "item_id").limit(cells).select("vector").toArrow().column(0))
    if not len(pivots):
        return constant_frame(spark, [], HIT)

    def slices(batches, width):
        """Slices whose distances to ``width`` places are some 16 MB."""
        step = max(1, 2_000_000 // width)
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                yield batch.slice(start, step)

    def assign(batches):
        for batch in slices(batches, len(pivots)):
            distance = np.sqrt(squared(matrix(batch.column(1)), pivots))
            cell = distance.argmin(1).astype(np.int32)
            radius = distance[np.arange(len(cell)), cell]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(cell), pa.array(radius)],
                ["item_id", "vector", "cell", "radius"],
            )

    vector = corpus.schema["vector"].dataType.simpleString()
    placed = written_table(corpus.mapInArrow(assign, f"item_id long, vector {vector}, cell int, radius double"), "cells")
    facts = placed.groupBy("cell").agg(
        F.count("*").alias("items"), F.min("radius").alias("inner"), F.max("radius").alias("outer")
    ).collect()
    wanted = n + 1 if exclude_self else n
    close = top_per_group(placed.select("cell", "radius", "item_id"), "cell", [F.asc("radius"), F.asc("item_id")], wanted).select("cell", "radius").toArrow()
    close_cell, close_radius = close.column(0).to_numpy(), close.column(1).to_numpy()
    numbers = np.array([row["cell"] for row in facts])
    inner = np.array([row["inner"] for row in facts])
    outer = np.array([row["outer"] for row in facts])
    slack = 1e-4  # far above the rounding of distances

    def reached(vectors):
        """Which cells may hold a neighbour of each vector."""
        to_pivot = np.sqrt(squared(vectors, pivots))
        reach = to_pivot[:, close_cell] + close_radius[None, :]
        bound = np.partition(reach, wanted - 1, axis=1)[:, wanted - 1] if reach.shape[1] >= wanted else np.full(len(vectors), np.inf)
        lowest = np.maximum(to_pivot[:, numbers] - outer, inner - to_pivot[:, numbers])
        return lowest <= bound[:, None] + slack

    def route(batches):
        for batch in slices(batches, len(close_cell) + len(pivots)):
            rows, columns = np.nonzero(reached(matrix(batch.column(1))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows)), batch.column(1).take(pa.array(rows)), pa.array(numbers[columns].astype(np.int32))],
                ["query_id", "vector", "cell"],
            )

    tried = queries.orderBy(F.xxhash64("query_id"), "query_id").limit(SAMPLE_ROWS).select("vector").toArrow().to_batches()
    items = np.array([row["items"] for row in facts])
    share = [(reached(matrix(part.column(0))) @ items / items.sum()).mean() for part in slices(tried, len(close_cell) + len(pivots))]
    if np.mean(share) > most:
        return _by_grid(corpus, queries, n, exclude_self)

    query_vector = queries.schema["vector"].dataType.simpleString()
    routed = written_table(queries.mapInArrow(route, f"query_id long, vector {query_vector}, cell int"), "routes")
    asked = {row["cell"]: row["count"] for row in routed.groupBy("cell").count().collect()}
    plan = constant_frame(
        spark,
        [
            (row["cell"], -(-row["items"] // block_rows), -(-asked[row["cell"]] // block_rows))
            for row in facts if row["cell"] in asked
        ],
        "cell int, item_blocks int, query_blocks int",
    )
    block_of = lambda key, blocks: F.pmod(F.xxhash64(key), F.col(blocks)).cast("int")
    # the plan has one row per cell
    items = placed.join(F.broadcast(plan), "cell").select(
        "item_id", "vector", "cell", block_of("item_id", "item_blocks").alias("item_block"), _every("query_blocks").alias("query_block")
    )
    asks = routed.join(F.broadcast(plan), "cell").select(
        "query_id", "vector", "cell", _every("item_blocks").alias("item_block"), block_of("query_id", "query_blocks").alias("query_block")
    )
    return _matches(asks, items, ["cell", "item_block", "query_block"], n, exclude_self)
