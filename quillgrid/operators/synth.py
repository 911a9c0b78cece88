"""Synthetic rows: deterministic patterns of the row number, generated where they are stored."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vocab
from ..functions.dates import spread_date
from ..functions.generate import city, generic_value, padded, person_name, pick, role_of
from ..session import constant_frame
from .ordering import enumerate_rows


def ids_for(table: DataFrame, column: str) -> DataFrame:
    """Key values of a parent table; empty if it has no such column."""
    if column in table.columns:
        return table.select(column)
    return constant_frame(table.sparkSession, [], f"{column} string")


def _rows(spark: SparkSession, missing: int) -> DataFrame:
    return spark.range(max(missing, 0)).withColumnRenamed("id", "i")


def fill_customers(spark: SparkSession, start: int, missing: int, end_date: str) -> DataFrame:
    i = F.col("i")
    return _rows(spark, missing).select(
        (start + i).alias("cust_id"),
        F.concat(person_name(i), F.lit(" "), (start + i).cast("string")).alias("cust_nm"),
        pick([s[0] for s in vocab.STATES], i).alias("st_cd"),
        city(i, len(vocab.STATES)).alias("city_nm"),
        spread_date(i, F.lit(missing), end_date).cast("string").alias("crtd_dt"),
    )


def fill_products(spark: SparkSession, start: int, missing: int) -> DataFrame:
    i = F.col("i")
    price = pick([p[2] for p in vocab.PRODUCTS], i)
    return _rows(spark, missing).select(
        (start + i).alias("prod_id"),
        F.concat(pick([p[0] for p in vocab.PRODUCTS], i), F.lit(" Model "), (start + i).cast("string")).alias("prod_nm"),
        pick([p[1] for p in vocab.PRODUCTS], i).alias("cat_cd"),
        F.round(price * (85 + F.pmod(i, F.lit(31))) / 100, 2).alias("unit_prc"),
    )


def fill_employees(spark: SparkSession, start: int, missing: int, end_date: str) -> DataFrame:
    i = F.col("i")
    return _rows(spark, missing).select(
        (start + i).alias("emp_id"),
        F.concat(person_name(i), F.lit(" "), (start + i).cast("string")).alias("emp_nm"),
        pick(vocab.DEPARTMENTS, i).alias("dept_cd"),
        (42_000 + F.pmod(i, F.lit(16)) * 6_500).cast("double").alias("sal"),
        spread_date(i, F.lit(missing), end_date).cast("string").alias("join_dt"),
    )


def fill_states(spark: SparkSession, start: int, missing: int) -> DataFrame:
    i = F.col("i")
    return _rows(spark, missing).select(
        F.concat(pick([s[0] for s in vocab.STATES], i), padded(start + i, 4)).alias("st_cd"),
        F.concat(pick([s[1] for s in vocab.STATES], i), F.lit(" Demo Zone "), (start + i + 1).cast("string")).alias("st_nm"),
        pick([s[2] for s in vocab.STATES], i).alias("regn_cd"),
    )


def _pointing(rows: DataFrame, parents: DataFrame, position: Column, columns: dict[str, str]) -> DataFrame:
    """Attach ``parents[position mod n]``: an equi-join on the dense row number of the parents.

    Positions cycle, so every parent gets the same share of the rows.
    """
    size = parents.agg(F.count("*")).scalar()
    chosen = parents.select(F.col("row_index").alias("__slot"), *[F.col(c).alias(out) for c, out in columns.items()])
    return rows.withColumn("__slot", F.pmod(position, size)).join(chosen, "__slot").drop("__slot")


def fill_orders(spark: SparkSession, customers: DataFrame, products: DataFrame, start: int, missing: int, end_date: str) -> DataFrame:
    """Orders over existing customers(cust_id) and products(prod_id, unit_prc)."""
    i = F.col("i")
    rows = _pointing(_rows(spark, missing), enumerate_rows(customers.select("cust_id"), "cust_id"), i, {"cust_id": "cust_id"})
    rows = _pointing(
        rows, enumerate_rows(products.select("prod_id", "unit_prc"), "prod_id"), i * 7,
        {"prod_id": "prod_id", "unit_prc": "unit_prc"},
    )
    quantity = 1 + F.pmod(i, F.lit(8))
    return rows.select(
        (start + i).alias("ord_id"), "cust_id", "prod_id", quantity.alias("qty"),
        F.round(F.col("unit_prc").cast("double") * quantity, 2).alias("amt"),
        spread_date(i, F.lit(missing), end_date).cast("string").alias("ord_dt"),
        pick(vocab.STATUS_CYCLE, i).alias("stat_cd"),
    )


def fill_generic(
    spark: SparkSession, table: str, columns: list[str], own_key: str, existing: int, missing: int,
    parents: dict[str, DataFrame], end_date: str,
) -> DataFrame:
    """Text rows for any table: own key, foreign keys into ``parents``, the rest by column role.

    ``parents`` maps a parent table to a one-column frame of its keys; an empty one is ignored.
    """
    i = F.col("i")
    rows = _rows(spark, missing).select((F.col("i") + existing).alias("i"))
    found = {}
    for column in columns:
        parent = vocab.PARENT_OF.get(column.lower())
        if column != own_key and parent in parents and not parents[parent].isEmpty():
            keys = parents[parent]
            numbered = enumerate_rows(keys, keys.columns[0])
            rows = _pointing(rows, numbered, i * 13, {keys.columns[0]: f"__fk_{column}"})
            found[column] = F.col(f"__fk_{column}").cast("string")
    value = lambda c: (i + 1).cast("string") if c == own_key else found.get(c, generic_value(table, c, i, end_date))
    return rows.select(*[value(c).alias(c) for c in columns])


def respread_dates(table: DataFrame, key: str, columns: list[str], end_date: str, floor: int | None = None) -> DataFrame:
    """Spread date columns evenly over the window in key order; keys below ``floor`` keep theirs."""
    generated = table if floor is None else table.where(F.col(key) >= floor)
    numbered = enumerate_rows(generated, key, name="__index")
    total = numbered.agg(F.count("*")).scalar()
    date = spread_date(F.col("__index"), total, end_date)
    spread = numbered.select(*[
        date.cast(table.schema[c].dataType).alias(c) if c in columns else F.col(c) for c in table.columns
    ])
    return spread if floor is None else table.where(F.coalesce(F.col(key) < floor, F.lit(True))).unionByName(spread)


def date_columns(columns: list[str]) -> list[str]:
    """Columns that :func:`respread_dates` rewrites, by their names."""
    return [c for c in columns if role_of(c) == "date"]


def respread_all_dates(tables: dict[str, DataFrame], keys: dict[str, str], end_date: str, floors: dict[str, int] | None = None) -> dict[str, DataFrame]:
    """Every table with its date columns, known by their names, spread over the window in key order.

    A table in ``floors`` keeps the dates of the rows below its floor, such as entered starter rows;
    tables without a date column are passed on as they are.
    """
    floors = floors or {}
    return {
        name: respread_dates(table, keys[name], dates, end_date, floors.get(name)) if (dates := date_columns(table.columns)) else table
        for name, table in tables.items()
    }


def all_parents(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Key frames of the parents present among ``tables``."""
    keys = {parent: column for column, parent in vocab.PARENT_OF.items()}
    return {parent: ids_for(tables[parent], column) for parent, column in keys.items() if parent in tables}


def top_up(table: DataFrame, filled: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, [table, filled])
