"""Reading tables, writing new versions, logs and saved answers."""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import vocab
from ..functions.text import normalize_question
from ..operators.ordering import enumerate_rows

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# Declared keys; a plain parquet file carries none.
PRIMARY_KEYS = {
    "region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"],
    "supplier": ["s_suppkey"], "part": ["p_partkey"], "orders": ["o_orderkey"],
    "events": ["event_id"], "documents": ["doc_id"], "embeddings": ["vec_id"],
    "pages": ["page_id"], "benchmark": ["item_id"], "labels": ["doc_id"],
    "conversations": ["conv_id", "turn"],
}


class Tables:
    """The tables of one folder, opened on first use: ``Tables(spark, dir).orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        frame = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        self.__dict__[name] = frame
        return frame

    @cached_property
    def all(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in TABLES}

    def register(self) -> "Tables":
        """Make every table known to ``spark.sql`` under its own name."""
        for name, frame in self.all.items():
            frame.createOrReplaceTempView(name)
        return self


def create_table(spark: SparkSession, columns: dict[str, str]) -> DataFrame:
    """An empty table from column name -> declared type (INTEGER, REAL or TEXT)."""
    spark_types = {"INTEGER": T.LongType(), "REAL": T.DoubleType(), "TEXT": T.StringType()}
    fields = [T.StructField(name, spark_types[kind.split()[0].upper()]) for name, kind in columns.items()]
    return spark.createDataFrame([], T.StructType(fields))


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_version(df: DataFrame, base: str, version: int) -> str:
    """Write one version of a table. The path being read is never the path being written."""
    path = f"{base}/v={version}"
    df.write.mode("overwrite").parquet(path)
    return path


def write_index(df: DataFrame, path: str, reset: bool = True) -> None:
    """Store (id, document, embedding, metadata ...) rows; ``reset`` replaces the old index."""
    df.write.mode("overwrite" if reset else "append").parquet(path)


# Columns of the evaluation run log.
RUN_LOG_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("level", T.StringType()),
    T.StructField("correct", T.IntegerType()),
    T.StructField("question", T.StringType()),
    T.StructField("generated_sql", T.StringType()),
    T.StructField("gold_sql", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("tokens", T.LongType()),
    T.StructField("ms", T.LongType()),
])


def write_run_log(log: DataFrame, path: str) -> None:
    """CSV with a header; texts are quoted and may span lines."""
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in RUN_LOG_SCHEMA]
    (
        log.select(*columns).write.mode("overwrite")
        .option("header", True).option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.schema(RUN_LOG_SCHEMA)
        .option("header", True).option("escape", '"').option("multiLine", True)
        .csv(path)
    )


# Fields of a saved answer.
SAVED_ANSWER_SCHEMA = T.StructType([
    T.StructField("question", T.StringType()),
    T.StructField("sql", T.StringType()),
    T.StructField("columns", T.ArrayType(T.StringType())),
    T.StructField("rows", T.ArrayType(T.ArrayType(T.StringType()))),
])


def read_answers(spark: SparkSession, path: str) -> DataFrame:
    """Saved answers keyed by normalised question; of equal questions the last one counts."""
    entries = spark.read.schema(SAVED_ANSWER_SCHEMA).option("multiLine", True).json(path)
    entries = entries.withColumn("position", F.monotonically_increasing_id())
    return last_by(entries.withColumn("question_key", normalize_question(F.col("question"))), ["question_key"], ["position"])


def last_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the highest ``order`` per key, by partial aggregation rather than a sort."""
    rest = [c for c in df.columns if c not in keys]
    ranked = F.struct(*[F.col(c) for c in order], F.struct(*[F.col(c) for c in rest]).alias("row"))
    return df.groupBy(*keys).agg(F.max(ranked).alias("last")).select(*keys, "last.row.*")


def answer_rows(spark: SparkSession, sql: str, question: str, tables: dict[str, DataFrame]) -> DataFrame:
    """Result of one saved query as rows (question, columns, cells).

    A saved query names its tables as ``{orders}``; the frames are passed with it, so no view of
    the session is replaced.
    """
    used = {name: frame for name, frame in tables.items() if f"{{{name}}}" in sql}
    result = spark.sql(sql, **used)
    cells = F.array(*[F.col(f"`{c}`").cast("string") for c in result.columns])
    return result.select(
        F.lit(question).alias("question"),
        F.lit(",".join(result.columns)).alias("columns"),
        cells.alias("cells"),
    )


def refresh_answers(spark: SparkSession, saved: list[tuple[str, str]], tables: dict[str, DataFrame], base: str, version: int) -> DataFrame:
    """Run every saved (question, sql) again over ``tables`` and write the results as a new version.

    Readers move to the new folder only after it is complete. Rows stay rows: no answer is
    gathered into a single value.
    """
    path = f"{base}/v={version}"
    answers = [answer_rows(spark, sql, question, tables) for question, sql in saved]
    reduce(DataFrame.unionByName, answers).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def page(df: DataFrame, key: str, number: int, size: int, near_rows: int = 100_000) -> DataFrame:
    """The ``number``-th page (from 1) in key order; equal keys in any order.

    A page within the first ``near_rows`` rows is a top-n. For a deeper one the keys alone are
    numbered over all tasks, and only the rows between the page's keys are sorted.
    """
    skip = (number - 1) * size
    if skip + size <= near_rows:
        return df.orderBy(key).offset(skip).limit(size)
    keys = enumerate_rows(df.select(F.col(key).alias("__key")), "__key", name="__at")
    found = keys.where((F.col("__at") >= skip) & (F.col("__at") < skip + size)).agg(
        F.count("*").alias("rows"), F.min("__key").alias("low"), F.max("__key").alias("high"), F.count_if(F.col("__key").isNull()).alias("nulls")
    ).first()
    if not found.rows:
        return df.limit(0)
    upto = F.lit(False) if found.high is None else F.col(key) <= found.high
    if found.nulls:  # null keys come first, so no other key stands before the page
        return df.where(F.col(key).isNull() | upto).orderBy(key).offset(skip).limit(size)
    # rows with the page's first key may begin on the page before
    earlier = keys.where((F.col("__key") == F.lit(found.low)) & (F.col("__at") < skip)).count()
    return df.where((F.col(key) >= found.low) & upto).orderBy(key).offset(earlier).limit(size)


def page_after(df: DataFrame, key: str, last_key, size: int) -> DataFrame:
    """The page that follows ``last_key``: the cost does not grow with the depth."""
    return df.where(F.col(key) > last_key).orderBy(key).limit(size)


def page_count(df: DataFrame, size: int) -> DataFrame:
    return df.agg(F.greatest(F.lit(1), F.ceil(F.count("*") / size)).cast("long").alias("pages"))


def preview(df: DataFrame, key: str, n: int = vocab.PREVIEW_ROWS) -> DataFrame:
    """The first rows and the number of rows that follow them."""
    more = df.agg(F.greatest(F.count("*") - n, F.lit(0))).scalar()
    return df.orderBy(key).limit(n).withColumn("more", more)
