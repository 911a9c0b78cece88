"""Table maintenance: inserts, updates, guarded deletes, shrinking, key repair, constraint checks.

A parquet table has no row update. Each function returns the new content of a table, to be
written as a new version.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordering import enumerate_rows


def insert_rows(table: DataFrame, rows: DataFrame, key: str, order: str, first_key: int = 1) -> DataFrame:
    """Append rows without a key; they get the numbers after the highest key, in ``order``."""
    highest = table.agg(F.coalesce(F.max(key), F.lit(first_key - 1))).scalar()
    numbered = enumerate_rows(rows, order, name="__index")
    dtype = table.schema[key].dataType
    keyed = numbered.withColumn(key, (highest + 1 + F.col("__index")).cast(dtype))
    return table.unionByName(keyed.select(*table.columns))


def update_rows(table: DataFrame, changes: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """Overwrite the columns of ``changes`` where the key matches; a NULL there overwrites too.

    Of several changes to one key the last by ``order`` counts; without an order they are an
    error, as nothing tells which one is meant.
    """
    changed = [c for c in changes.columns if c not in (key, order)]
    row = F.struct(*[F.col(c).alias(f"__new_{c}") for c in changed])
    last = F.max_by(row, order) if order else F.any_value(row)
    single = F.lit(True) if order else F.when(F.count("*") > 1, F.raise_error(F.lit(f"several changes for one {key}")).cast("boolean")).otherwise(True)
    renamed = changes.groupBy(key).agg(last.alias("__row"), single.alias("__matched")).select(key, "__row.*", "__matched")
    joined = table.join(renamed, key, "left")
    return joined.select(*[
        F.when(F.col("__matched"), F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c) if c in changed else F.col(c)
        for c in table.columns
    ])


def count_dependents(keys: DataFrame, children: DataFrame, key: str, foreign_key: str) -> DataFrame:
    """Referencing rows per key of a delete set, 0 without any."""
    per_key = children.groupBy(F.col(foreign_key).alias(key)).agg(F.count("*").alias("dependents"))
    return keys.select(key).join(per_key, key, "left").select(key, F.coalesce("dependents", F.lit(0)).alias("dependents"))


def delete_guarded(table: DataFrame, doomed: DataFrame, children: DataFrame, key: str, foreign_key: str) -> tuple[DataFrame, DataFrame]:
    """Delete by key, but only rows that no child refers to: (remaining rows, blocked keys)."""
    used = children.select(F.col(foreign_key).alias(key)).dropna().distinct()
    doomed = doomed.select(key).distinct()
    blocked = doomed.join(used, key, "left_semi")
    free = doomed.join(used, key, "left_anti")
    return table.join(free, key, "left_anti"), blocked


def kept_keys(table: DataFrame, key: str, target: int) -> DataFrame:
    """The lowest ``target`` keys with their position, (kept_key, row_index).

    The keys are cut to the target in the tasks first, so only that many are numbered.
    """
    lowest = table.select(F.col(key).alias("kept_key")).orderBy("kept_key").limit(target)
    return enumerate_rows(lowest, "kept_key")


def shrink_to_target(table: DataFrame, kept: DataFrame, key: str) -> DataFrame:
    return table.join(kept.select(F.col("kept_key").alias(key)), key, "left_semi")


def repoint_foreign_key(children: DataFrame, kept: DataFrame, foreign_key: str, flag: str | None = None) -> DataFrame:
    """Point children of dropped parents at ``kept[(old - 1) mod n]``.

    NULL and non-numeric keys stay. The new key is looked up once per distinct old key; a parent
    with very many children is one row of that lookup.
    """
    dtype = children.schema[foreign_key].dataType
    size = kept.agg(F.count("*")).scalar()
    old = children.select(F.col(foreign_key).alias("__old")).dropna().distinct()
    numeric = old.withColumn("__number", F.expr("try_cast(__old AS BIGINT)")).dropna(subset=["__number"])
    dropped = numeric.join(kept.select(F.col("kept_key").cast("long").alias("__number")), "__number", "left_anti")
    moves = dropped.withColumn("row_index", F.pmod(F.col("__number") - 1, size)).join(kept, "row_index").select(
        "__old", F.col("kept_key").cast(dtype).alias("__new")
    )
    joined = children.join(moves, F.col(foreign_key) == F.col("__old"), "left")
    columns = [F.coalesce("__new", foreign_key).alias(c) if c == foreign_key else F.col(c) for c in children.columns]
    if flag:
        columns.append(F.col("__new").isNotNull().alias(flag))
    return joined.select(*columns)


def repoint_children(children: list[tuple[DataFrame, str]], kept: DataFrame) -> list[DataFrame]:
    """Every table that refers to a shrunk parent, given as (table, foreign key), in the same order."""
    return [repoint_foreign_key(table, kept, foreign_key) for table, foreign_key in children]


def recompute_amount(lines: DataFrame, products: DataFrame, changed: str, product_key: str, quantity: str, amount: str, price: str) -> DataFrame:
    """Amount = quantity x price for the lines whose product has changed; the others keep theirs."""
    prices = products.select(product_key, F.col(price).alias("__price"))
    joined = lines.join(prices, product_key, "left")
    new = F.when(F.col(changed), F.col(quantity) * F.col("__price")).otherwise(F.col(amount))
    return joined.select(*[new.alias(c) if c == amount else F.col(c) for c in lines.columns])


def duplicate_keys(table: DataFrame, keys: list[str]) -> DataFrame:
    """Rows beyond the first per key value."""
    return table.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violations")
    )


def missing_values(table: DataFrame, columns: list[str]) -> DataFrame:
    """NULLs in the columns that must not hold one; all columns in one pass."""
    return table.agg(reduce(lambda a, b: a + b, [F.count_if(F.col(c).isNull()) for c in columns]).alias("violations"))


def orphans(children: DataFrame, foreign_key: str, parents: DataFrame, key: str) -> DataFrame:
    """Rows whose foreign key has no parent, counted per key value before the anti join."""
    per_key = children.where(F.col(foreign_key).isNotNull()).groupBy(F.col(foreign_key).alias("__key")).agg(F.count("*").alias("n"))
    lost = per_key.join(parents.select(F.col(key).alias("__key")), "__key", "left_anti")
    return lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations"))


def constraint_check(checks: list[tuple[str, DataFrame]]) -> DataFrame:
    """One row per named check with its number of violations."""
    return reduce(DataFrame.unionByName, [df.select(F.lit(name).alias("check"), "violations") for name, df in checks])
