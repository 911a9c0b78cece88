"""Exact deduplication by a stream with disk-backed keyed state.

Every document is landed as (identifier, length, digest, locator). A Structured Streaming
aggregation keyed by the digest holds, in RocksDB and without expiry, the document that stays,
the file its text lies in and the number of rows seen. A digest that was hit more than once is
then checked on the full bytes: the smallest and the largest normalised text of a group must be
the same. Groups that fail the check are split by their bytes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_path, written_table
from .common import small_list

# The characters that the comparison ignores.
BLANKS = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def normalised(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    out = F.coalesce(text, F.lit(""))
    for blank in BLANKS:
        out = F.replace(out, F.lit(blank), F.lit(""))
    return out


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def best_row() -> Column:
    """Most code points first, then the smallest id; a row without id comes last."""
    return F.max(F.struct("n_chars", (-F.col("id")).alias("neg_id"), F.col("id"), F.col("locator")))


def landed(docs: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column]) -> DataFrame:
    """One narrow row per document: what the stream reads."""
    text = F.col(text_col)
    return docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.length(F.coalesce(text, F.lit(""))).cast("long").alias("n_chars"),
        digest(normalised(text)).alias("digest"),
        F.input_file_name().alias("locator"),
    )


def stream_state(spark: SparkSession, source: DataFrame, path: str, base: str, files_per_batch: int | None = None) -> DataFrame:
    """Run the keyed state over the landed files and return its last value for every digest.

    Each micro-batch writes the groups it changed to a folder of its own; a batch that runs
    again overwrites that folder, and a restarted stream goes on from its checkpoint.
    """
    reader = spark.readStream.schema(source.schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    groups = reader.parquet(path).groupBy("digest").agg(F.count("*").alias("size"), best_row().alias("best"))

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/state/batch={number}")

    # an instance is closed with its commit: an open one holds megabytes of disk whatever its state
    wanted = {"providerClass": ROCKSDB, "unloadOnCommit": "true"}
    settings = {f"spark.sql.streaming.stateStore.{key}": value for key, value in wanted.items()}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        query = (
            groups.writeStream.outputMode("update").foreachBatch(keep)
            .option("checkpointLocation", f"{base}/progress").trigger(availableNow=True).start()
        )
        query.awaitTermination()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    empty = source.groupBy("digest").agg(F.count("*").alias("size"), best_row().alias("best")).limit(0)
    try:
        changes = spark.read.schema(empty.schema).parquet(f"{base}/state")
    except Exception as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return empty  # no file, hence no batch
    return changes.groupBy("digest").agg(F.max(F.struct("size", "best")).alias("last")).select("digest", "last.*")


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    digest: Callable[[Column], Column] = sha256, files_per_batch: int | None = None,
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, digest.

    Texts are equal if they are the same without white space. Of equal texts the row with the
    most code points stays, then the one with the smallest id; a null id loses against any
    other. Null text counts as empty, and empty texts are equal to each other. Of rows repeated
    with the same id and text exactly one is kept. Other columns are not read. An empty table
    gives no rows.

    Tasks reduce a digest before they shuffle it, so a group may hold any share of the rows.
    """
    spark = docs.sparkSession
    base = new_path(spark, "exact")
    narrow = landed(docs, id_col, text_col, digest)
    narrow.write.parquet(f"{base}/landed")
    rows = spark.read.schema(narrow.schema).parquet(f"{base}/landed")
    state = stream_state(spark, rows, f"{base}/landed", base, files_per_batch)
    state = written_table(state, "digests")

    # the full bytes of every digest that was hit again
    hits = small_list(state.where("size > 1").select("digest"), "hits")
    texts = docs.select(digest(normalised(F.col(text_col))).alias("digest"), normalised(F.col(text_col)).alias("whole"))
    differ = written_table(
        texts.join(hits, "digest").groupBy("digest").agg(F.min("whole").alias("low"), F.max("whole").alias("high"))
        .where("low <> high").select("digest"),
        "collisions",
    )
    copies = rows.groupBy("digest", "id", "n_chars").agg(F.count("*").alias("copies"))
    agreed = copies.join(state.join(differ, "digest", "left_anti"), "digest")
    result = with_copies(agreed)
    if differ.isEmpty():
        return result
    # one digest for different texts: the group is what has the same bytes
    split = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("n_chars"),
        normalised(F.col(text_col)).alias("whole"),
        digest(normalised(F.col(text_col))).alias("digest"),
        F.input_file_name().alias("locator"),
    ).join(differ, "digest")
    whole = split.groupBy("digest", "whole").agg(F.count("*").alias("size"), best_row().alias("best"))
    parts = split.groupBy("digest", "whole", "id", "n_chars").agg(F.count("*").alias("copies"))
    return result.unionByName(with_copies(parts.join(whole, ["digest", "whole"])))


def with_copies(groups: DataFrame) -> DataFrame:
    """Repeated rows back as rows, of which the first can be kept."""
    first = (F.col("copy") == 1) & F.col("id").eqNullSafe(F.col("best.id")) & (F.col("n_chars") == F.col("best.n_chars"))
    return groups.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(
        "id", F.col("best.id").alias("keep_id"), F.col("size").alias("group_size"), first.alias("kept"), "digest", "n_chars"
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of repeated rows one.

    Rows are told by id and length: a row that shares both with a kept one stays, unless it has
    the same text.
    """
    per_row = exact_groups(docs, id_col, text_col).groupBy(F.col("id").alias("__id"), F.col("n_chars").alias("__chars")).agg(
        F.max("kept").alias("kept"), F.count("*").alias("copies")
    )
    per_row = written_table(per_row.where("NOT kept OR copies > 1"), "exact-dropped")
    length = F.length(F.coalesce(F.col(text_col), F.lit(""))).cast("long")
    same = F.col(id_col).cast("long").eqNullSafe(F.col("__id")) & (length == F.col("__chars"))
    rows = docs.join(small_list(per_row.where("NOT kept").select("__id", "__chars"), "dropped"), same, "left_anti")
    repeated = small_list(per_row.where("kept").select("__id", "__chars"), "repeated")
    if repeated.isEmpty():
        return rows
    return rows.join(repeated, same, "left_anti").unionByName(rows.join(repeated, same, "left_semi").dropDuplicates([id_col, text_col]))
