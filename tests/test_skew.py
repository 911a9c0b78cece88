"""Queries on tables in which one key, text or vector holds a third of all rows."""

import pytest
from pyspark.sql import functions as F
from check_oracle import compare, connect
from skew_tables import write_skewed

from quillgrid.plans import QUERIES

SENSITIVE = [
    "agg_by_category", "agg_group_sum", "answer_cache_match", "anti_not_in", "bag_equal", "bm25_score", "cooldown_gap",
    "fk_dependents", "hybrid_fusion", "join_three_way_distinct", "knn_vector", "label_lookup", "latest_per_key",
    "minmax_normalize", "open_request_join", "recompute_amount", "repoint_fk", "rank_populated_first",
    "stream_refresh", "top10_products", "value_extract", "value_retrieve",
]


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    write_skewed("/root/testdata/sf0.001", folder)
    return folder, connect(folder)


@pytest.mark.parametrize("name", SENSITIVE)
def test_skewed_tables(spark, skewed, name):
    folder, duck = skewed
    assert name in QUERIES
    assert compare(spark, folder, name, duck) is None


def test_partitioning_does_not_matter(spark, tmp_path):
    """The same rows in other files and another order give the same rows."""
    source = "/root/testdata/sf0.001"
    for table in ("orders", "customer", "embeddings", "labels", "documents", "benchmark"):
        spark.read.parquet(f"{source}/{table}.parquet").repartition(7).write.parquet(f"{tmp_path}/{table}.parquet")
    for name in ("row_enumerate", "repoint_fk", "minmax_normalize", "vector_topk_populated", "bm25_score", "spread_date"):
        here, there = QUERIES[name](spark, source), QUERIES[name](spark, str(tmp_path))
        assert here.exceptAll(there).count() == 0 and there.exceptAll(here).count() == 0


@pytest.fixture(scope="module")
def skewed_folders(spark, skewed, tmp_path_factory):
    """The skewed tables as many files, so a hot partition has many parts that can be split."""
    from quillgrid.sources.tables import TABLES

    folder = str(tmp_path_factory.mktemp("skewed-folders"))
    for table in TABLES:
        spark.read.parquet(f"{skewed[0]}/{table}.parquet").repartition(12).write.parquet(f"{folder}/{table}.parquet")
    return folder


SPLIT = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


@pytest.mark.parametrize("name", ["answer_cache_match", "label_lookup"])
def test_hot_partitions_are_split(spark, skewed_folders, name):
    before = {key: spark.conf.get(key, None) for key in SPLIT}
    for key, value in SPLIT.items():
        spark.conf.set(key, value)
    try:
        frame = QUERIES[name](spark, skewed_folders)
        frame.collect()
        assert "skew=true" in frame._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_events_of_one_user_are_many_ranges(spark):
    """The ranges that ``cooldown`` works on are even although one user has nearly all events."""

    from quillgrid.operators.ordering import cooldown

    events = spark.range(20_000).select(
        "id", F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(-1).alias("user"), F.timestamp_seconds(F.col("id") * 3).alias("t")
    )
    rows = {r.id: r.gap_seconds for r in cooldown(events, "user", "t", "id").collect()}
    assert rows[1] is None and rows[0] is None and rows[2] == 3.0 and rows[11] == 6.0 and len(rows) == 20_000
    ranges = events.repartitionByRange(8, "user", "t", "id").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert ranges < 5000


def test_no_pairs_are_shuffled(spark, skewed):
    """Matched (query, item) pairs are reduced where they are made."""
    import re

    from quillgrid.operators import retrieval
    from quillgrid.plans.retrieval import asked, corpus
    from quillgrid.sources.tables import Tables

    t = Tables(spark, skewed[0])
    top = retrieval.bm25_top(retrieval.bm25_index(corpus(t)), asked(t), 5)
    top.collect()
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\(query_id#\d+L?, item_id", plan)
    assert "WindowGroupLimit" in plan


def test_first_unscored_skips_full_blocks(spark):
    from quillgrid.operators.retrieval import _first_unscored

    items = spark.range(100).select(F.col("id").alias("item_id"), (F.col("id") >= 90).alias("empty"))
    taken = {1: set(range(0, 60)) | {61, 63}, 2: set(), 3: set(range(0, 98)), 4: set(range(1, 100, 2))}
    scored = spark.createDataFrame([(q, i) for q, own in taken.items() for i in own], "query_id long, item_id long")
    short = spark.createDataFrame([(q, 0.0) for q in taken], "query_id long, unmatched double")
    found = {}
    for r in _first_unscored(items, scored, short, 7, block=8).collect():
        found.setdefault(r.query_id, set()).add(r.item_id)
    assert found == {q: set([i for i in range(100) if i not in own][:7]) for q, own in taken.items()}
