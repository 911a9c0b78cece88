"""Dense row numbers, per-group ranks and gaps between events, safe for very large groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vocab
from ..functions.dates import seconds_between, seconds_left
from ..session import written_table


def enumerate_rows(df: DataFrame, *order: str | Column, name: str = "row_index") -> DataFrame:
    """Number the rows 0, 1, 2 ... in the given order, which must be a total one.

    Range-partitioned sort, a position within each partition, plus the partition's offset: no
    task sees more than its own range. The positions are written before use, since a range
    partitioning that is computed again may cut elsewhere.
    """
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    position = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    stored = written_table(
        ordered.select("*", F.spark_partition_id().alias("__part"), position.alias("__position")), "rows"
    )
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored.groupBy("__part").agg(F.count("*").alias("__size")).select(
        "__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__offset")
    )
    # one row per shuffle partition, whatever the size of the table
    return stored.join(F.broadcast(offsets), "__part").select(
        *df.columns, (F.col("__position") + F.col("__offset")).alias(name)
    )


def top_per_group(df: DataFrame, group: str, order: list[Column], k: int, name: str = "rank") -> DataFrame:
    """The first ``k`` rows per group with their rank; Spark cuts each task's rows to k first."""
    window = Window.partitionBy(group).orderBy(*order)
    ranked = df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= k)
    return ranked.withColumn(name, F.col(name).cast("long"))


def populated_first(df: DataFrame, group: str, k: int, by: Column, key: str = "item_id") -> DataFrame:
    """Rank non-empty items before empty ones, then by ``by``, ties by key; keep ``k``."""
    return top_per_group(df, group, [F.col("empty").asc(), by, F.col(key).asc()], k)


def rank_of_expected(expected: DataFrame, hits: DataFrame, query: str = "query_id", item: str = "item_id") -> DataFrame:
    """1-based rank of each expected item, NULL if it is not among the hits."""
    return expected.join(hits.select(query, item, "rank"), [query, item], "left").select(query, item, "rank")


def top2_margin(hits: DataFrame, query: str = "query_id") -> DataFrame:
    """Distance of the best hit and the gap to the second one, 0 without a second."""
    first = F.min(F.when(F.col("rank") == 1, F.col("distance")))
    second = F.min(F.when(F.col("rank") == 2, F.col("distance")))
    return hits.where("rank <= 2").groupBy(query).agg(
        first.alias("distance"), F.coalesce(F.round(second - first, 6), F.lit(0.0)).alias("margin")
    )


def latest_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Newest row per key as an aggregate: a key with very many rows is reduced in every task."""
    rest = [c for c in df.columns if c != key and c not in order]
    row = F.max(F.struct(*order, *rest))
    return df.groupBy(key).agg(row.alias("__row")).select(key, "__row.*").select(*df.columns)


def cooldown(events: DataFrame, key: str, time: str, tie: str, wait: int = vocab.COOLDOWN_SECONDS) -> DataFrame:
    """Gap in seconds to the previous event of the same key, and the seconds still to wait.

    The events are cut into ranges of (key, time, id), so a key with very many events is spread
    over many tasks. Within a range ``lag`` gives the previous event; the first one of a range
    takes the last event of the range before, of which there is one row per range.
    """
    # an event without a key has no predecessor
    keyed = events.where(F.col(key).isNotNull())
    ranges = written_table(keyed.repartitionByRange(key, time, tie).withColumn("__range", F.spark_partition_id()), "ranges")
    lasts = ranges.groupBy("__range").agg(F.max(F.struct(key, time, tie)).alias("__last"))
    before = lasts.select("__range", F.lag("__last").over(Window.orderBy("__range")).alias("__before"))
    within = Window.partitionBy("__range").orderBy(key, time, tie)
    previous = F.coalesce(F.lag(F.struct(key, time, tie)).over(within), F.col("__before"))
    joined = ranges.join(F.broadcast(before), "__range").withColumn("__previous", previous)
    same = F.col(f"__previous.{key}") == F.col(key)
    gaps = joined.withColumn("__seconds", F.when(same, seconds_between(F.col(f"__previous.{time}"), F.col(time))))
    without = events.where(F.col(key).isNull()).withColumn("__seconds", F.lit(None).cast(gaps.schema["__seconds"].dataType))
    seconds = F.col("__seconds")
    return gaps.select(*events.columns, "__seconds").unionByName(without).select(
        *events.columns,
        seconds.alias("gap_seconds"),
        F.coalesce(seconds < wait, F.lit(False)).alias("blocked"),
        F.coalesce(seconds_left(seconds, wait), F.lit(0)).alias("seconds_left"),
    )


def open_requests(events: DataFrame, parents: DataFrame, key: str, time: str, tie: str, kind: Column, request: str, closing: str) -> DataFrame:
    """Newest request per parent that no later closing event has answered.

    The newest request of a key is open whenever any of its requests is, so one aggregate per
    key replaces a join of requests with closings.
    """
    newest = F.max(F.when(kind == request, F.struct(time, tie)))
    closed = F.max(F.when(kind == closing, F.struct(time, tie)))
    per_key = events.groupBy(key).agg(newest.alias("request"), closed.alias("closing"))
    return (
        per_key.where(F.col("request").isNotNull() & (F.col("closing").isNull() | (F.col("request") > F.col("closing"))))
        .join(parents, key)
        .select(key, *[c for c in parents.columns if c != key], F.col(f"request.{tie}").alias("request_id"))
    )
