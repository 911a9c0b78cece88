"""Keep a table and its saved answers up to date from a stream of change files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ordering import latest_per_key
from ..session import constant_frame, new_path


BUCKETS = 64


@dataclass(frozen=True)
class StreamRefresh:
    """Where a refresh keeps its data.

    The state is dealt into ``buckets`` by a hash of the key. A batch writes only the buckets that hold one
    of its keys, under a new version, and then the version's file, which names the version of every bucket.
    """

    base: str
    buckets: int = BUCKETS

    def state(self, version: int) -> str:
        """Folder of the buckets that this version has written."""
        return f"{self.base}/state/v={version}"

    def partials(self, version: int) -> str:
        return f"{self.base}/partials/v={version}"

    def manifest(self, version: int) -> str:
        """(bucket, written): the version in which each bucket was written last."""
        return f"{self.base}/versions/v={version}"

    def answers(self, version: int) -> str:
        return f"{self.base}/answers/v={version}"

    @property
    def checkpoint(self) -> str:
        return f"{self.base}/checkpoint"

    def bucket_versions(self, spark: SparkSession, version: int) -> dict[int, int]:
        if version < 1:
            return {}
        # as many rows as there are buckets
        return {r["bucket"]: r["written"] for r in spark.read.schema("bucket int, written int").parquet(self.manifest(version)).collect()}

    def current(self, spark: SparkSession, schema: T.StructType, version: int, only: list[int] | None = None) -> DataFrame:
        """The state at a version, or some of its buckets: the others are not read."""
        return self._buckets(spark, schema, self.state, version, only)

    def current_partials(self, spark: SparkSession, schema: T.StructType, version: int) -> DataFrame:
        return self._buckets(spark, schema, self.partials, version, None)

    def _buckets(self, spark, schema, folder, version, only) -> DataFrame:
        written = self.bucket_versions(spark, version)
        paths = [f"{folder(v)}/bucket={b}" for b, v in written.items() if only is None or b in only]
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)

    def drop_unused(self, spark: SparkSession, version: int) -> None:
        """Remove the buckets that neither this version nor the one before it uses."""
        used = {*self.bucket_versions(spark, version).items(), *self.bucket_versions(spark, version - 1).items()}
        hadoop = spark._jvm.org.apache.hadoop.fs
        for parent in ("state", "partials"):
            root = hadoop.Path(f"{self.base}/{parent}")
            files = root.getFileSystem(spark._jsc.hadoopConfiguration())
            for folder in files.globStatus(hadoop.Path(root, "v=*/bucket=*")) or []:
                path = folder.getPath()
                key = int(path.getName().split("=")[1]), int(path.getParent().getName().split("=")[1])
                if key not in used and key[1] < version:
                    files.delete(path, True)


def change_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """Change files as a stream: a folder of files or one file. The schema is given, not inferred.

    The path is given as a pattern that only it fits, since a plain path has to be a folder.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    path = path.rstrip("/")
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def apply_batch(target: StreamRefresh, key: str, order: list[str], summarize, combine=None):
    """The ``foreachBatch`` step.

    A batch reads the buckets of its keys at version ``id`` and writes them, and the version's file, as version
    ``id + 1``. Running it again, as after a lost driver, reads the same version and
    overwrites the same folders, so nothing is applied twice.

    With ``combine``, ``summarize`` is applied per bucket (grouped by ``bucket`` beside its own columns), only to
    the buckets that were written, and ``combine`` makes the answer of these partial ones; the rest of the state
    is then not read. Without it, ``summarize`` is applied to the whole state.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        version = batch_id + 1
        bucket = F.pmod(F.xxhash64(key), F.lit(target.buckets)).cast("int")
        # a batch is read twice: its buckets first, then its rows
        touched = sorted(r["bucket"] for r in batch.select(bucket.alias("bucket")).distinct().collect())
        current = target.current(spark, batch.schema, batch_id, touched)
        latest = latest_per_key(current.unionByName(latest_per_key(batch, key, order)), key, order)
        tasks = max(1, min(len(touched), int(spark.conf.get("spark.sql.shuffle.partitions"))))
        dealt = latest.withColumn("bucket", bucket).repartition(tasks, "bucket")
        dealt.write.mode("overwrite").partitionBy("bucket").parquet(target.state(version))
        written = {**target.bucket_versions(spark, batch_id), **dict.fromkeys(touched, version)}
        rows = constant_frame(spark, sorted(written.items()), "bucket int, written int")
        if combine:
            changed = spark.read.schema(T.StructType([*batch.schema, T.StructField("bucket", T.IntegerType())])).parquet(target.state(version))
            partial = summarize(changed, ["bucket"])
            partial.repartition(tasks, "bucket").write.mode("overwrite").partitionBy("bucket").parquet(target.partials(version))
        rows.coalesce(1).write.mode("overwrite").parquet(target.manifest(version))
        if combine:
            schema = T.StructType([f for f in partial.schema if f.name != "bucket"])
            answer = combine(target.current_partials(spark, schema, version))
        else:
            answer = summarize(target.current(spark, batch.schema, version))
        answer.write.mode("overwrite").parquet(target.answers(version))
        target.drop_unused(spark, version)

    return step


def run_refresh(changes: DataFrame, target: StreamRefresh, key: str, order: list[str], summarize, combine=None) -> int | None:
    """Apply all available change files and stop.

    Returns the newest version, also if no file was new, and None as long as there was none at all.
    """
    query = (
        changes.writeStream.foreachBatch(apply_batch(target, key, order, summarize, combine))
        .option("checkpointLocation", target.checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    try:
        versions = changes.sparkSession.read.parquet(f"{target.base}/answers")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return versions.agg(F.max("v")).first()[0]


def refresh_events(spark: SparkSession, path: str, schema: T.StructType, base: str | None = None) -> DataFrame:
    """Latest event per user, kept from the change files, and its saved summary per event type.

    A later call with the same ``base`` goes on from the files that the first one has applied.
    """
    target = StreamRefresh(base or new_path(spark, "refresh"))
    partial = lambda state, by: state.groupBy(*by, "event_type").agg(F.count("*").alias("users"), F.sum("value").alias("value"))
    total = lambda parts: parts.groupBy("event_type").agg(F.sum("users").alias("users"), F.round(F.sum("value"), 2).alias("value"))
    version = run_refresh(change_stream(spark, path, schema), target, "user_id", ["ts", "event_id"], partial, total)
    if version is None:
        return total(partial(spark.createDataFrame([], schema), []))
    return spark.read.parquet(target.answers(version))
