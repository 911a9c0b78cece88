"""Session set-up and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def build_session(app_name: str = "quillgrid", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators were tuned with; a cluster's own settings win."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster the executors
    would each see their own disk, so there a missing setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    existing = context.getCheckpointDir()
    if existing:
        return existing.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="quillgrid-"))
    return context.getCheckpointDir().rstrip("/")


def run_dir(spark: SparkSession) -> str:
    """The folder in the shared one that holds all intermediate tables of this application."""
    return os.path.join(shared_dir(spark), f"quillgrid-{spark.sparkContext.applicationId}")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return os.path.join(run_dir(spark), f"{name}-{uuid.uuid4().hex}")


def drop_run_tables(spark: SparkSession) -> bool:
    """Remove the intermediate tables of this application, once their results are written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(run_dir(spark))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where a plan would otherwise be evaluated several times, or where row numbers must
    not change when a lost task is run again. Reading the files keeps column pruning.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dealt_out(df: DataFrame) -> DataFrame:
    """``df`` over all cores if it is read in fewer pieces than there are cores, as a small file with
    one row group is. A large table has more pieces than cores and is left as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Hint a broadcast only after checking that ``df`` has at most ``max_rows`` rows.

    Beyond the bound the frame is returned as it is, so that the join shuffles both sides and
    adaptive execution splits the skewed partitions.
    """
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df


ARROW_TYPES = {
    "string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(),
    "boolean": pa.bool_(), "array<string>": pa.list_(pa.string()),
}


def constant_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few constant rows as part of the plan; no Python worker is started for them."""
    fields = T.StructType.fromDDL(schema).fields
    columns = [
        pa.array([row[i] for row in rows], ARROW_TYPES[field.dataType.simpleString()])
        for i, field in enumerate(fields)
    ]
    return spark.createDataFrame(pa.table(columns, names=[field.name for field in fields]))
