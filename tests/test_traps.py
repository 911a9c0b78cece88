"""Semantics that are easy to get wrong: NULLs, ties, text numbers, rounding, types."""

import datetime

import pytest
from pyspark.sql import functions as F

from quillgrid.functions import dates
from quillgrid.operators import catalog, mutate, ordering, star
from quillgrid.sources import tables


def keys(spark, values):
    return spark.createDataFrame([(v,) for v in values], "k long")


@pytest.mark.parametrize("right, expected", [
    ([1, None], []),          # a NULL on the right leaves nothing
    ([1], [2]),               # a NULL on the left is unknown
    ([], [1, 2, None]),       # nothing to compare with
])
def test_not_in(spark, right, expected):
    left = keys(spark, [1, 2, None])
    found = [r.k for r in star.not_in(left, "k", keys(spark, right), "k").collect()]
    assert sorted(found, key=str) == sorted(expected, key=str)
    left.createOrReplaceTempView("l")
    keys(spark, right).createOrReplaceTempView("r")
    plain = [r.k for r in spark.sql("SELECT k FROM l WHERE k NOT IN (SELECT k FROM r)").collect()]
    assert sorted(plain, key=str) == sorted(found, key=str)


def test_codes_that_share_a_label_stay_apart(spark):
    orders = spark.createDataFrame([(i, s) for i, s in enumerate([3, 8, 9, 9])], "order_id long, status int")
    only_orders = star.Star(customers=None, orders=orders, lines=None, products=None, employees=None)
    assert [tuple(r) for r in star.orders_by_status(only_orders).collect()] == [("Delivered", 1), ("Other", 1), ("Other", 2)]


def test_ties_go_to_the_key(spark):
    products = spark.createDataFrame([(3, "c", "X", 5.0), (1, "a", "Y", 5.0), (2, "b", "Y", 1.0)], "product_id long, product_name string, category string, price double")
    s = star.Star(customers=None, orders=None, lines=None, products=products, employees=None)
    assert star.dearest_product(s).first()[0] == "a"


def test_month_of_text_and_timestamp(spark):
    text = spark.createDataFrame([("2025-07-31",), ("2025-08-01",), ("2025-06-30",)], "d string")
    assert text.where(dates.in_month(F.col("d"), "string", "2025-07")).count() == 1
    stamp = text.select(F.col("d").cast("timestamp_ntz").alias("d"))
    assert stamp.where(dates.in_month(F.col("d"), "timestamp_ntz", "2025-07")).count() == 1
    december = spark.createDataFrame([("2025-12-31",), ("2026-01-01",)], "d string")
    assert december.where(dates.in_month(F.col("d"), "string", "2025-12")).count() == 1


@pytest.mark.parametrize("total, end, expected", [
    (3, "2020-01-02", ["2020-01-01", "2020-01-01", "2020-01-02"]),  # half a day goes to the even day 0
    (3, "2020-01-04", ["2020-01-01", "2020-01-03", "2020-01-04"]),  # 1.5 goes to 2
    (1, "2020-01-04", ["2020-01-01"]),
    (0, "2020-01-04", []),
])
def test_spread_date(spark, total, end, expected):
    rows = spark.range(total).select(dates.spread_date(F.col("id"), F.lit(total), end).cast("string").alias("d"))
    assert [r.d for r in rows.orderBy("d").collect()] == expected


def test_spread_date_on_a_large_table(spark):
    big = 10_000_000_000
    row = spark.range(1).select(dates.spread_date(F.lit(big - 1), F.lit(big), "2025-12-31").alias("d")).first()
    assert row.d == datetime.date(2025, 12, 31)


def test_search_any_column(spark):
    rows = spark.createDataFrame([(1, "Alpha.x", None), (2, None, "beta"), (3, "alphaXx", "none")], "id long, a string, b string")
    assert [r.id for r in star.search_any_column(rows, "ALPHA.X").collect()] == [1, 3]
    assert [r.id for r in star.search_any_column(rows, "alpha.x", literal=True).collect()] == [1]
    assert [r.id for r in star.search_any_column(rows, "None").collect()] == [3]


def test_label_of_unknown_and_missing_id(spark):
    rows = spark.createDataFrame([(1,), (9,), (None,)], "c long")
    names = spark.createDataFrame([(1, "Ann")], "id long, name string")
    labels = {r.c: r.label for r in star.with_label(rows, "c", names, "id", "name").collect()}
    assert labels == {1: "Ann (ID 1)", 9: "9", None: None}


def test_text_numbers_with_a_bad_value(spark):
    children = spark.createDataFrame([("1",), ("7",), ("x",), (None,)], "fk string")
    kept = spark.createDataFrame([(1, 0), (2, 1)], "kept_key long, row_index long")
    moved = [r.fk for r in mutate.repoint_foreign_key(children, kept, "fk").collect()]
    assert sorted(moved, key=str) == sorted(["1", "1", "x", None], key=str)  # (7 - 1) mod 2 = 0


def test_enumeration_does_not_depend_on_partitions(spark):
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    for parts in (1, 3, 16):
        numbered = ordering.enumerate_rows(rows.repartition(parts), "k")
        assert numbered.where("k <> row_index").count() == 0 and numbered.count() == 1000
    assert ordering.enumerate_rows(rows.limit(0), "k").count() == 0


def test_cooldown_across_slices(spark):
    stamps = ["2024-01-01 00:59:50", "2024-01-01 01:00:10", "2024-01-01 05:00:00", "2024-01-01 05:00:59.5"]
    events = spark.createDataFrame([(i, 1, t) for i, t in enumerate(stamps)], "id long, user long, t string")
    events = events.withColumn("t", F.col("t").cast("timestamp_ntz"))
    rows = ordering.cooldown(events, "user", "t", "id").orderBy("id").collect()
    assert [(r.gap_seconds, r.blocked, r.seconds_left) for r in rows] == [
        (None, False, 0), (20.0, True, 40), (14390.0, False, 0), (59.5, True, 0),
    ]


def test_cooldown_keeps_rows_without_key_or_time(spark):
    events = spark.createDataFrame([(1, None, "2024-01-01 00:00:00"), (2, None, "2024-01-01 00:00:01"), (3, 1, None)], "id long, user long, t string")
    rows = ordering.cooldown(events.withColumn("t", F.col("t").cast("timestamp")), "user", "t", "id").collect()
    assert sorted((r.id, r.gap_seconds, r.blocked) for r in rows) == [(1, None, False), (2, None, False), (3, None, False)]


def test_open_requests(spark):
    rows = [(1, 1, "ask"), (2, 1, "ask"), (3, 1, "done"), (4, 1, "ask"), (5, 2, "ask"), (6, 2, "done"), (7, 3, "ask")]
    events = spark.createDataFrame([(i, u, f"2024-01-01 00:00:{i:02d}", k) for i, u, k in rows], "id long, user long, t string, kind string")
    users = spark.createDataFrame([(1, "a"), (2, "b")], "user long, name string")
    found = ordering.open_requests(events, users, "user", "t", "id", F.col("kind"), "ask", "done").collect()
    assert [(r.user, r.request_id) for r in found] == [(1, 4)]


def test_page_count_of_empty_table(spark):
    assert tables.page_count(spark.range(0), 100).first()[0] == 1
    assert tables.page_count(spark.range(101), 100).first()[0] == 2


def test_saved_answers_last_one_wins(spark, tmp_path):
    path = tmp_path / "answers.json"
    path.write_text(
        '[{"question": "How many?", "sql": "a", "columns": ["n"], "rows": [[1]]},'
        ' {"question": "how MANY", "sql": "b", "columns": ["n"], "rows": [[2]]}]'
    )
    rows = tables.read_answers(spark, str(path)).collect()
    assert [(r.question_key, r.sql, r.rows) for r in rows] == [("how many", "b", [["2"]])]


def test_values_of_narrow_columns(spark):
    t = {
        "cust_mst": spark.createDataFrame([(i, "MH" if i % 2 else "KA", f"n{i}", "2020-01-01") for i in range(30)], "cust_id long, st_cd string, cust_nm string, crtd_dt string"),
        "ord_txn": spark.createDataFrame([(i, i % 3 if i % 5 else None) for i in range(30)], "ord_id long, stat_cd int"),
        "empty": spark.createDataFrame([], "note string"),
    }
    found = catalog.extract_values(spark, t, limit=10)
    rows = {(r.table, r.column, r.value): (r.value_type, r.aliases) for r in found.collect()}
    assert rows == {
        ("cust_mst", "st_cd", "MH"): ("TEXT", ["Maharashtra", "Maharashtra state"]),
        ("cust_mst", "st_cd", "KA"): ("TEXT", ["Karnataka", "Karnataka state"]),
        ("ord_txn", "stat_cd", "0"): ("INTEGER", []),
        ("ord_txn", "stat_cd", "1"): ("INTEGER", ["pending", "pending order"]),
        ("ord_txn", "stat_cd", "2"): ("INTEGER", ["processing", "in progress", "processing order"]),
    }
    hints = catalog.value_hints(
        catalog.value_documents(found).where("table = 'ord_txn'").withColumn("rank", F.col("value").cast("int")).withColumn("q", F.lit(1)), "q"
    ).first().hints
    assert hints.split("\n")[1] == "- ord_txn.stat_cd = 1; meaning: pending | pending order; use this exact stored value when relevant."


def test_hints_of_a_query_without_hits(spark):
    hits = spark.createDataFrame([(1, 1, "t", "c", "v", "TEXT", "")], "q long, rank int, `table` string, column string, value string, value_type string, aliases string")
    asked = spark.createDataFrame([(1,), (2,), (2,)], "q long")
    assert {r.q: r.hints for r in catalog.value_hints(hits, "q", asked).collect()} == {
        1: "- t.c = 'v'; use this exact stored value when relevant.", 2: "(none)",
    }


def test_catalog_of_registered_tables(spark):
    from quillgrid.sources.tables import TABLES, Tables

    tables = Tables(spark, "/root/testdata/sf0.001").register()
    try:
        names = [r.table for r in catalog.catalog_tables(spark).collect()]
        assert set(TABLES) <= set(names) and names == sorted(names)
        assert [tuple(r) for r in catalog.catalog_columns(spark, {"region": tables.region}, {"region": ["r_regionkey"]}).orderBy("position").collect()] == [
            ("region", "r_regionkey", "INTEGER", 0, True), ("region", "r_name", "TEXT", 1, False),
        ]
    finally:
        for name in TABLES:
            spark.catalog.dropTempView(name)


def test_a_column_at_the_limit_is_kept(spark):
    at = spark.range(500).select(F.concat(F.lit("v"), F.col("id").cast("string")).alias("code"), F.lit(None).cast("string").alias("gone"))
    above = spark.range(501).select(F.concat(F.lit("v"), F.col("id").cast("string")).alias("code"))
    counts = catalog.extract_values(spark, {"a": at, "b": above}, {}).groupBy("table").count().collect()
    assert [tuple(r) for r in counts] == [("a", 500)]


def test_descriptions(spark):
    t = {"cust_mst": spark.createDataFrame([(1, "a")], "cust_id long, cust_nm string"), "inv_hdr": spark.createDataFrame([], "inv_id string")}
    columns = catalog.catalog_columns(spark, t, {"cust_mst": ["cust_id"]})
    inventory = catalog.table_inventory(spark, t, {"cust_mst": ["cust_id"]})
    found = {r.table: (r.description, r.empty) for r in catalog.describe_tables(columns, inventory).collect()}
    assert found == {
        "cust_mst": ("customer master. customer master table. Stores customer master records. Columns: customer id, customer name. (1 rows of data).", False),
        "inv_hdr": ("invoice header. invoice header table. Stores invoice header records. Columns: invoice id. (currently empty, no data).", True),
    }
    assert {r.table: r.compact for r in catalog.column_lists(columns).collect()}["cust_mst"] == "cust_mst(cust_id, cust_nm)"
    assert {r.table: r.primary_key for r in inventory.collect()} == {"cust_mst": "cust_id", "inv_hdr": "rowid"}


def test_indexable_columns(spark):
    names = ["id", "cust_id", "ord_dt", "update_time", "in_tm", "cust_nm", "sal", "stat_cd"]
    rows = spark.createDataFrame([("ord_txn", n, "INTEGER" if n in ("sal", "stat_cd") else "TEXT") for n in names], "t string, c string, k string")
    from quillgrid.functions.vocab import VALUE_ALIASES

    kept = rows.where(catalog.is_indexable(F.col("t"), F.col("c"), F.col("k"), VALUE_ALIASES))
    assert sorted(r.c for r in kept.collect()) == ["cust_nm", "stat_cd"]


def test_index_build(spark, tmp_path):
    t = {
        "cust_mst": spark.createDataFrame([(1, "MH"), (2, "KA"), (3, "KA")], "cust_id long, st_cd string"),
        "inv_hdr": spark.createDataFrame([], "inv_id string, note string"),
    }
    for _ in range(2):  # a reset replaces the old index
        schema_index, value_index = catalog.build_index(spark, t, {"cust_mst": ["cust_id"]}, str(tmp_path / "index"))
    assert {r.id: (r.rows, r.empty) for r in schema_index.collect()} == {"cust_mst": (3, False), "inv_hdr": (0, True)}
    assert sorted((r.id, r.value, r.aliases) for r in value_index.collect()) == [
        ("value_0", "KA", "Karnataka | Karnataka state"), ("value_1", "MH", "Maharashtra | Maharashtra state"),
    ]
