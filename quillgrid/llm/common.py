"""Small helpers shared by the operators."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, GroupedData, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import broadcast_if_small, written_table

IDS_BROADCAST = 2_000_000
SLICE = 1 << 22
_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per application, as ``--py-files`` would."""
    application = spark.sparkContext.applicationId
    if application in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(), f"{os.path.basename(package)}.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, files in os.walk(package):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(application)


def release_memory() -> None:
    """Give what a task has freed back to the system: allocators keep it otherwise, task after task."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library only
    if trim:
        trim(0)


def in_tasks(df: DataFrame, function: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str, size: int = SLICE) -> DataFrame:
    """``mapInArrow`` with functions of this package.

    The function sees slices of about ``size`` bytes, so what it makes of one of them is bounded
    however long the texts of a batch are.
    """
    ship_package(df.sparkSession)

    def sliced(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, batch.num_rows * size // max(batch.nbytes, 1))
            for start in range(0, max(batch.num_rows, 1), step):
                yield batch.slice(start, step)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(sliced(batches))
        release_memory()  # the worker goes on to other tasks

    return df.mapInArrow(run, schema)


def in_groups(grouped: GroupedData, function: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """``applyInArrow`` whose workers give the memory of a group back before the next one."""

    def run(table: pa.Table) -> pa.Table:
        out = function(table)
        del table
        release_memory()
        return out

    return grouped.applyInArrow(run, schema)


def narrow(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only (id, text); null text becomes empty. Other columns, whatever their names, are left out."""
    return df.select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )


def small_list(ids: DataFrame, name: str) -> DataFrame:
    """A list of ids, written once; up to IDS_BROADCAST rows it travels to the texts, beyond that the
    join shuffles both sides."""
    return broadcast_if_small(written_table(ids.distinct(), name), IDS_BROADCAST)


def without_ids(docs: DataFrame, id_col: str, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id is not in ``ids`` (id), with all their columns; rows without id stay."""
    gone = small_list(ids.select(F.col("id").alias("__id")), "dropped")
    return docs.join(gone, F.col(f"`{id_col}`").cast("long") == F.col("__id"), "left_anti")


def arrow_schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(T.StructType.fromDDL(ddl))


def per_batch(df: DataFrame, schema: str, function: Callable[[dict[str, list]], dict[str, list]]) -> DataFrame:
    """Apply ``function`` (columns as lists in, columns as lists out) to every Arrow batch of ``df``."""
    arrow = arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = function({name: batch.column(i).to_pylist() for i, name in enumerate(batch.schema.names)})
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return in_tasks(df, run, schema)
