"""Set operations on tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.union(right).distinct()


def intersect_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.intersect(right)


def except_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.subtract(right)


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """All rows of several tables; duplicates stay."""
    return reduce(DataFrame.unionByName, frames)
