"""Saved aggregates kept up to date from changes, without reading the facts again.

An answer of sums and counts per key is kept as its state: one row per key with the number of rows and
exact sums. Changes are signed rows, +1 for an inserted row and -1 for a deleted one; an update is
both. They are summed per key in the tasks that read them, and added to the state. Top-n reports are read off
the state. Sums are decimals, so the state is that of a full run to the last digit, in whatever
order changes come.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SUM = "decimal(38,6)"
ROWS, SIGN = "rows", "__sign"


def answer_state(facts: DataFrame, keys: list[str], sums: dict[str, Column]) -> DataFrame:
    """(keys, rows, sums) of all facts. Null values add nothing; null keys are a key; without keys it is one row."""
    return _summed(facts.withColumn(SIGN, F.lit(1)), keys, sums)


def signed_changes(inserted: DataFrame | None = None, deleted: DataFrame | None = None, updated: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Rows with their sign; ``updated`` holds the rows as they were and as they are."""
    signed = [(inserted, 1), (deleted, -1), *zip(updated or (), (-1, 1))]
    marked = [rows.withColumn(SIGN, F.lit(sign)) for rows, sign in signed if rows is not None]
    out = marked[0]
    for rows in marked[1:]:
        out = out.unionByName(rows)
    return out


def apply_changes(state: DataFrame, changes: DataFrame, keys: list[str], sums: dict[str, Column]) -> DataFrame:
    """The state after the changes; keys without rows go. Only the state and the changes are read.

    Changes of a hot key are summed where they are read, so one row per key and task is shuffled.
    """
    added = state.unionByName(_summed(changes, keys, sums))
    merged = added.groupBy(*keys).agg(F.sum(ROWS).alias(ROWS), *[F.sum(name).cast(SUM).alias(name) for name in sums])
    return merged.where(F.col(ROWS) > 0) if keys else merged


def top_of_state(state: DataFrame, by: str, keys: list[str], n: int) -> DataFrame:
    """The ``n`` keys with the largest sums, ties by key."""
    return state.orderBy(F.desc_nulls_last(by), *keys).limit(n)


def _summed(signed: DataFrame, keys: list[str], sums: dict[str, Column]) -> DataFrame:
    sign = F.col(SIGN)
    return signed.groupBy(*keys).agg(
        F.coalesce(F.sum(sign), F.lit(0)).cast("long").alias(ROWS),
        *[F.coalesce(F.sum(value.cast("decimal(27,6)") * sign), F.lit(0)).cast(SUM).alias(name) for name, value in sums.items()],
    )
