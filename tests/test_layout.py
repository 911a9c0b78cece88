"""Tables stored as folders of many files, as Spark writes them."""

import glob
import os

import pytest
from check_oracle import FAMILY, connect, rows_of
from pyspark.sql import functions as F

from quillgrid.plans import ORACLES, QUERIES
from quillgrid.sources.tables import TABLES, page
from quillgrid.streaming.refresh import refresh_events

SOURCE = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("folders"))
    for table in TABLES:
        spark.read.parquet(f"{SOURCE}/{table}.parquet").repartition(6).write.parquet(f"{folder}/{table}.parquet")
    assert len(glob.glob(f"{folder}/orders.parquet/part-*")) == 6
    return folder


@pytest.fixture(scope="module")
def duck():
    return connect(SOURCE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_as_sql(spark, folders, duck, name):
    frame = QUERIES[name](spark, folders)
    result = duck.execute(ORACLES[name])
    names, kinds = [d[0] for d in result.description], [str(d[1]) for d in result.description]
    assert rows_of(frame.columns, frame.collect()) == rows_of(names, result.fetchall())
    assert all(FAMILY.get(kind, kind.lower()) == dict(frame.dtypes)[name] for name, kind in zip(names, kinds))


def test_second_refresh_goes_on(spark, folders, tmp_path):
    path, base = f"{folders}/events.parquet", str(tmp_path / "refresh")
    schema = spark.read.parquet(path).schema
    first = sorted(refresh_events(spark, path, schema, base).collect())
    assert sorted(refresh_events(spark, path, schema, base).collect()) == first
    assert os.listdir(f"{base}/answers") == ["v=1"]


def test_refresh_without_files(spark, folders, tmp_path):
    schema = spark.read.parquet(f"{folders}/events.parquet").schema
    os.mkdir(tmp_path / "none")
    assert refresh_events(spark, str(tmp_path / "none"), schema).collect() == []


@pytest.mark.parametrize("near_rows", [0, 1000])
def test_deep_pages(spark, near_rows):
    rows = spark.range(500).select((F.col("id") * 7 % 500).alias("k"), F.lit("x").alias("v")).repartition(5)
    for number, size in [(1, 30), (7, 30), (17, 30), (18, 30), (50, 10)]:
        found = [r.k for r in page(rows, "k", number, size, near_rows).collect()]
        assert found == list(range(500))[(number - 1) * size:number * size]


def test_pages_with_equal_keys(spark):
    rows = spark.range(60).select(F.when(F.col("id") >= 6, F.floor(F.col("id") / 6)).alias("k"))
    keys = [None] * 6 + [i // 6 for i in range(6, 60)]
    for number in range(1, 9):
        assert [r.k for r in page(rows, "k", number, 8, 0).collect()] == keys[(number - 1) * 8:number * 8]
