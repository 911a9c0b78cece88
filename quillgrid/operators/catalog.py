"""Catalog profiling: inventory, column facts, low-cardinality values and their descriptions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text, vocab
from ..session import constant_frame
from ..sources.tables import write_index
from .ordering import enumerate_rows

HASH_SLOTS = 32768  # size of Spark's bitmap aggregate: 4 KB per column and task


def declared_type(simple: str) -> str:
    """Spark type -> the three declared types of the source database."""
    if simple in ("tinyint", "smallint", "int", "bigint"):
        return "INTEGER"
    if simple in ("float", "double") or simple.startswith("decimal"):
        return "REAL"
    if simple == "string":
        return "TEXT"
    return simple.upper()


def catalog_tables(spark: SparkSession) -> DataFrame:
    """Names of the registered tables and views, sorted."""
    names = [(t.name,) for t in spark.catalog.listTables()]
    return constant_frame(spark, names, "table string").orderBy("table")


def catalog_columns(spark: SparkSession, tables: dict[str, DataFrame], keys: dict[str, list[str]]) -> DataFrame:
    """One row per column, from the schemas only: nothing is scanned."""
    rows = [
        (name, field.name, declared_type(field.dataType.simpleString()), position, field.name in keys.get(name, []))
        for name, df in tables.items()
        for position, field in enumerate(df.schema.fields)
    ]
    return constant_frame(spark, rows, "table string, column string, type string, position int, is_key boolean")


def is_indexable(table: Column, column: Column, kind: Column, aliases: dict) -> Column:
    """Is a column worth a value index? Ids and dates never; glossary columns always; else text."""
    name = F.lower(column)
    excluded = (name == "id") | name.endswith("_id") | name.rlike("_dt$|_tm$|date|time")
    known = F.lit(False)
    for alias_table, alias_column in sorted({key[:2] for key in aliases}):
        known = known | ((table == alias_table) & (column == alias_column))
    return ~excluded & (known | F.upper(F.coalesce(kind, F.lit(""))).contains("TEXT"))


def _row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def table_inventory(spark: SparkSession, tables: dict[str, DataFrame], keys: dict[str, list[str]]) -> DataFrame:
    """Per table: rows, columns and key columns ('rowid' without one)."""
    facts = constant_frame(
        spark, [(name, len(df.columns), ", ".join(keys.get(name, [])) or "rowid") for name, df in tables.items()],
        "table string, columns long, primary_key string",
    )
    # one row per table of the catalog on either side
    return _row_counts(tables).join(F.broadcast(facts), "table").select("table", "rows", "columns", "primary_key")


def total_records(tables: dict[str, DataFrame]) -> DataFrame:
    return _row_counts(tables).agg(F.count("*").alias("tables"), F.sum("rows").alias("records"))


def row_target_check(inventory: DataFrame, targets: dict[str, int], default: int) -> DataFrame:
    """Summary of the row counts and the tables that are below their target."""
    target = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in targets.items() for x in p]), F.col("table")), F.lit(default)) if targets else F.lit(default)
    checked = inventory.withColumn("under", F.col("rows") < target)
    return checked.agg(
        F.min("rows").alias("smallest"),
        F.max("rows").alias("largest"),
        F.sum("rows").alias("total"),
        F.count_if("under").alias("under_target"),
        F.array_join(F.sort_array(F.collect_list(F.when(F.col("under"), F.col("table")))), ",").alias("tables_under_target"),
    )


def _hash_slot(column: str) -> Column:
    return F.pmod(F.xxhash64(F.col(f"`{column}`").cast("string")), F.lit(HASH_SLOTS))


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct non-null values per column, as (column, distinct_values).

    Distinct per column and value first, so the shuffle carries each value once per task; a long
    text travels as its SHA-256 digest.
    """
    is_long = F.length("value") > 64
    identity = F.struct(is_long, F.when(is_long, F.sha2("value", 256)).otherwise(F.col("value"))).alias("value")
    values = _column_values(df, columns).select("column", identity).distinct()
    found = values.groupBy("column").agg(F.count("*").alias("distinct_values"))
    names = constant_frame(df.sparkSession, [(c,) for c in columns], "column string")
    return names.join(found, "column", "left").select("column", F.coalesce("distinct_values", F.lit(0)).alias("distinct_values"))


def _column_values(df: DataFrame, columns: list[str]) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns])
    return df.select(F.explode(cells).alias("cell")).select("cell.*").where("value IS NOT NULL")


def low_cardinality_candidates(tables: dict[str, DataFrame], columns: dict[str, list[str]], limit: int) -> dict[str, list[str]]:
    """Columns that may have at most ``limit`` distinct values; no such column is ever missed.

    One pass per table fills a fixed-size bitmap of value hashes per column. Its set bits are a
    lower bound of the distinct count, so a column above the limit is certain to be too wide and
    its values are never shuffled. One short row per table comes back: schema facts, not data.
    """
    screens = []
    for name, names in columns.items():
        if names:
            bits = [F.bitmap_count(F.bitmap_construct_agg(_hash_slot(c))) for c in names]
            screens.append(tables[name].agg(F.array(*bits).alias("bits")).select(F.lit(name).alias("table"), "bits"))
    if not screens:
        return {}
    rows = reduce(DataFrame.unionByName, screens).collect()
    # a NULL hashes to a fixed slot, hence the spare one
    return {
        row["table"]: [c for c, bits in zip(columns[row["table"]], row["bits"]) if bits <= limit + 1]
        for row in rows
    }


def extract_values(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    aliases: dict[tuple[str, str, str], list[str]] = vocab.VALUE_ALIASES,
    limit: int = vocab.VALUE_CARDINALITY_LIMIT,
) -> DataFrame:
    """Distinct values of the low-cardinality columns: (table, column, value, value_type, aliases)."""
    columns = catalog_columns(spark, tables, {})
    wanted = columns.where(is_indexable(F.col("table"), F.col("column"), F.col("type"), aliases))
    by_table: dict[str, list[str]] = {}
    kinds: dict[tuple[str, str], str] = {}
    for row in wanted.orderBy("table", "position").collect():  # schema facts only
        by_table.setdefault(row["table"], []).append(row["column"])
        kinds[row["table"], row["column"]] = row["type"]
    narrow = low_cardinality_candidates(tables, by_table, limit)
    values = [
        _column_values(tables[name], names).withColumn("table", F.lit(name))
        for name, names in narrow.items() if names
    ]
    schema = "table string, column string, value string, value_type string, aliases array<string>"
    if not values:
        return constant_frame(spark, [], schema)
    distinct = reduce(DataFrame.unionByName, values).distinct()
    # the bitmap bounds the screened columns, so this count is over few rows
    counts = distinct.groupBy("table", "column").agg(F.count("*").alias("n")).where(F.col("n") <= limit).drop("n")
    kind_rows = constant_frame(spark, [(t, c, k) for (t, c), k in kinds.items()], "table string, column string, value_type string")
    kept = distinct.join(counts, ["table", "column"], "left_semi").join(F.broadcast(kind_rows), ["table", "column"])
    return with_aliases(kept, aliases).select("table", "column", "value", "value_type", "aliases")


def alias_frame(spark: SparkSession, aliases: dict) -> DataFrame:
    rows = [(t, c, v, list(a)) for (t, c, v), a in aliases.items()]
    return constant_frame(spark, rows, "table string, column string, value string, aliases array<string>")


def with_aliases(values: DataFrame, aliases: dict) -> DataFrame:
    """Add the glossary meanings of (table, column, value), an empty list where there are none."""
    empty = F.array().cast("array<string>")
    if not aliases:
        return values.withColumn("aliases", empty)
    # the glossary is a hand-written constant of the program
    known = F.broadcast(alias_frame(values.sparkSession, aliases))
    joined = values.withColumn("value", F.col("value").cast("string")).join(known, ["table", "column", "value"], "left")
    return joined.withColumn("aliases", F.coalesce("aliases", empty))


def value_documents(values: DataFrame) -> DataFrame:
    """Value records with the sentence to index and the aliases as stored with it."""
    return values.select(
        "table", "column", "value", "value_type",
        F.array_join("aliases", " | ").alias("aliases"),
        text.value_document(F.col("table"), F.col("column"), F.col("value"), F.col("aliases")).alias("document"),
    )


def value_hints(hits: DataFrame, key: str, queries: DataFrame | None = None) -> DataFrame:
    """One prompt text per query: a line per hit in rank order. Hits are at most k per query.

    With ``queries`` every query has a text, which is "(none)" without hits.
    """
    literal = text.sql_literal(F.col("value"), F.col("value_type"))
    meaning = F.when(F.col("aliases") != "", F.concat(F.lit(" meaning: "), F.col("aliases"), F.lit(";"))).otherwise("")
    line = F.concat(
        F.lit("- "), F.col("table"), F.lit("."), F.col("column"), F.lit(" = "), literal, F.lit(";"), meaning,
        F.lit(" use this exact stored value when relevant."),
    )
    lines = hits.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("rank", line.alias("line")))).alias("lines"))
    hints = lines.select(key, F.array_join(F.col("lines.line"), "\n").alias("hints"))
    if queries is None:
        return hints
    return queries.select(key).distinct().join(hints, key, "left").select(key, F.coalesce("hints", F.lit("(none)")).alias("hints"))


def column_lists(columns: DataFrame) -> DataFrame:
    """Per table: compact schema text and human-readable column names, in table order."""
    parts = F.sort_array(F.collect_list(F.struct("position", "column", text.humanize_name(F.col("column")).alias("words"))))
    return columns.groupBy("table").agg(parts.alias("parts")).select(
        "table",
        F.concat("table", F.lit("("), F.array_join(F.col("parts.column"), ", "), F.lit(")")).alias("compact"),
        F.array_join(F.col("parts.words"), ", ").alias("column_words"),
    )


def describe_tables(columns: DataFrame, inventory: DataFrame) -> DataFrame:
    """The sentence that describes a table to a text index, and whether the table is empty."""
    name = text.humanize_name(F.col("table"))
    ending = F.when(F.col("rows") == 0, " (currently empty, no data).").otherwise(
        F.concat(F.lit(" ("), F.col("rows").cast("string"), F.lit(" rows of data)."))
    )
    return column_lists(columns).join(inventory.select("table", "rows"), "table").select(
        "table",
        F.concat(
            name, F.lit(". "), name, F.lit(" table. Stores "), name, F.lit(" records. Columns: "),
            F.col("column_words"), F.lit("."), ending,
        ).alias("description"),
        (F.col("rows") == 0).alias("empty"),
    )


def build_index(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    keys: dict[str, list[str]],
    path: str,
    aliases: dict[tuple[str, str, str], list[str]] = vocab.VALUE_ALIASES,
    limit: int = vocab.VALUE_CARDINALITY_LIMIT,
    reset: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Write the documents to embed: one per table under ``schema_index``, one per value under
    ``value_index``. Vectors are joined on ``id`` later. Returns both as read back."""
    inventory = table_inventory(spark, tables, keys)
    described = describe_tables(catalog_columns(spark, tables, keys), inventory).join(inventory, "table")
    write_index(described.select(F.col("table").alias("id"), F.col("description").alias("document"), "rows", "empty"), f"{path}/schema_index", reset)
    documents = value_documents(extract_values(spark, tables, aliases, limit))
    numbered = enumerate_rows(documents, "table", "column", "value", name="number")
    identified = numbered.select(F.concat(F.lit("value_"), F.col("number").cast("string")).alias("id"), *documents.columns)
    write_index(identified, f"{path}/value_index", reset)
    return spark.read.parquet(f"{path}/schema_index"), spark.read.parquet(f"{path}/value_index")
