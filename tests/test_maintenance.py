import datetime
import os

import pytest
from pyspark.sql import functions as F

from quillgrid.functions import vocab
from quillgrid.operators import mutate, synth
from quillgrid.sources import tables
from quillgrid.streaming.refresh import StreamRefresh, apply_batch, change_stream, run_refresh
from tests.starter import frames

END = "2025-12-31"


def test_insert_numbers_from_the_highest_key(spark):
    table = spark.createDataFrame([(7, "a")], "id long, name string")
    rows = spark.createDataFrame([("z", 2), ("y", 1)], "name string, position long")
    assert sorted(tuple(r) for r in mutate.insert_rows(table, rows, "id", "position").collect()) == [(7, "a"), (8, "y"), (9, "z")]
    assert sorted(tuple(r) for r in mutate.insert_rows(table.limit(0), rows, "id", "position").collect()) == [(1, "y"), (2, "z")]


def test_update_with_null(spark):
    table = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "id long, name string, x double")
    changes = spark.createDataFrame([(2, None), (3, "c")], "id long, name string")
    assert sorted(tuple(r) for r in mutate.update_rows(table, changes, "id").collect()) == [(1, "a", 1.0), (2, None, 2.0)]


def test_guarded_delete(spark):
    t = frames(spark)
    doomed = spark.createDataFrame([(101,), (999,)], "cust_id long")
    orders = t["ord_txn"].where("cust_id <> 102")
    remaining, blocked = mutate.delete_guarded(t["cust_mst"], doomed.union(spark.createDataFrame([(102,)], "cust_id long")), orders, "cust_id", "cust_id")
    assert sorted(r.cust_id for r in remaining.collect()) == [101, 103, 104, 105, 106, 107]
    assert [r.cust_id for r in blocked.collect()] == [101]
    counts = mutate.count_dependents(doomed, orders, "cust_id", "cust_id")
    assert {r.cust_id: r.dependents for r in counts.collect()} == {101: 3, 999: 0}


def test_shrinking_leaves_no_orphans(spark):
    t = frames(spark)
    kept = mutate.kept_keys(t["prod_mst"], "prod_id", 3)
    products = mutate.shrink_to_target(t["prod_mst"], kept, "prod_id")
    moved = mutate.repoint_foreign_key(t["ord_txn"], kept, "prod_id", flag="moved")
    orders = mutate.recompute_amount(moved, products, "moved", "prod_id", "qty", "amt", "unit_prc").drop("moved")
    assert orders.columns == t["ord_txn"].columns
    checks = mutate.constraint_check([
        ("key", mutate.duplicate_keys(orders, ["ord_id"])),
        ("required", mutate.missing_values(products, ["prod_nm"])),
        ("product", mutate.orphans(orders, "prod_id", products, "prod_id")),
    ])
    assert {r.check: r.violations for r in checks.collect()} == {"key": 0, "required": 0, "product": 0}
    by_id = {r.ord_id: (r.prod_id, r.amt) for r in orders.collect()}
    assert by_id[5003] == (1, 124000.0)  # product 4 -> kept[(4 - 1) mod 3]
    assert by_id[5006] == (2, 1598.0)  # product 5 -> kept[(5 - 1) mod 3]
    assert by_id[5001] == (1, 62000.0)


def test_constraint_check_finds_faults(spark):
    rows = spark.createDataFrame([(1, "a", 1), (1, None, 9), (1, "c", None), (2, "d", 9)], "id long, name string, fk long")
    parents = spark.createDataFrame([(1,)], "id long")
    found = mutate.constraint_check([
        ("key", mutate.duplicate_keys(rows, ["id"])), ("name", mutate.missing_values(rows, ["name", "fk"])),
        ("fk", mutate.orphans(rows, "fk", parents, "id")),
    ])
    assert {r.check: r.violations for r in found.collect()} == {"key": 2, "name": 2, "fk": 2}


def day(index, total):
    span = (datetime.date.fromisoformat(END) - datetime.date(2020, 1, 1)).days
    return (datetime.date(2020, 1, 1) + datetime.timedelta(days=round(index % max(total, 1) * span / max(total - 1, 1)))).isoformat()


def test_filled_orders(spark):
    t = frames(spark)
    filled = synth.fill_orders(spark, t["cust_mst"], t["prod_mst"], 5011, 40, END).orderBy("ord_id").collect()
    customers, products = [101, 102, 103, 104, 105, 106, 107], [(1, 62000.0), (2, 799.0), (3, 8500.0), (4, 11500.0), (5, 4200.0)]
    assert len(filled) == 40
    for i, row in enumerate(filled):
        product, price = products[i * 7 % 5]
        quantity = 1 + i % 8
        assert tuple(row) == (5011 + i, customers[i % 7], product, quantity, price * quantity, day(i, 40), [1, 2, 3, 3, 3, 4][i % 6])


def test_filled_customers_products_employees_states(spark):
    customer = synth.fill_customers(spark, 108, 30, END).where("cust_id = 125").first()
    assert tuple(customer) == (125, "Anaya Iyer 125", "UP", "Noida", day(17, 30))
    product = synth.fill_products(spark, 6, 40).where("prod_id = 39").first()
    assert tuple(product) == (39, "Wireless Mouse Model 39", "ACCS", 695.13)
    employee = synth.fill_employees(spark, 5, 40, END).where("emp_id = 25").first()
    assert tuple(employee) == (25, "Kabir Iyer 25", "OPS", 68000.0, day(20, 40))
    state = synth.fill_states(spark, 6, 12).where("st_nm like '% 12'").first()
    assert tuple(state) == ("UP0011", "Uttar Pradesh Demo Zone 12", "NORTH")
    assert synth.fill_customers(spark, 1, 0, END).count() == 0 and synth.fill_customers(spark, 1, -5, END).count() == 0


def test_generic_rows(spark):
    parents = synth.all_parents({"cust_mst": frames(spark)["cust_mst"], "wh_mst": spark.createDataFrame([], "wh_nm string")})
    columns = ["ship_id", "cust_id", "wh_id", "ord_dt", "qty", "disc_pct", "tot_amt", "hod_nm", "wh_nm", "cron_exp", "ab_cd", "mob_no", "note"]
    rows = synth.fill_generic(spark, "ship_hdr", columns, "ship_id", 20, 5, parents, END).orderBy("ship_id").collect()
    i = 20
    assert tuple(rows[0]) == (
        "21", str([101, 102, 103, 104, 105, 106, 107][i * 13 % 7]), "21", day(i + len("ship_hdr"), 5000), "21", "25", "534.6",
        "Kabir Iyer", "Ship Hdr 00021", "20 20 * * *", "AB00", "9" + "0" + "00158380", "ship_hdr_note_00021",
    )
    assert len(rows) == 5


def test_respread_keeps_starter_rows(spark):
    orders = frames(spark)["ord_txn"]
    spread = {r.ord_id: r.ord_dt for r in synth.respread_dates(orders, "ord_id", ["ord_dt"], END, floor=5008).collect()}
    assert spread[5007] == "2025-06-15"
    assert [spread[5008], spread[5009], spread[5010]] == [day(0, 3), day(1, 3), day(2, 3)]
    everything = synth.respread_dates(orders, "ord_id", ["ord_dt"], END)
    assert everything.agg(F.max("ord_dt")).first()[0] == END


def test_fill_then_check(spark):
    t = frames(spark)
    grown = synth.top_up(t["ord_txn"], synth.fill_orders(spark, t["cust_mst"], t["prod_mst"], 5011, 90, END).withColumn("qty", F.col("qty").cast("long")))
    assert grown.count() == 100
    assert mutate.duplicate_keys(grown, ["ord_id"]).first()[0] == 0
    assert mutate.orphans(grown, "cust_id", t["cust_mst"], "cust_id").first()[0] == 0
    assert vocab.CORE_TARGETS["ord_txn"] == 12000


def test_versions_and_empty_tables(spark, tmp_path):
    table = tables.create_table(spark, {"id": "INTEGER PRIMARY KEY", "name": "TEXT", "x": "REAL"})
    assert table.dtypes == [("id", "bigint"), ("name", "string"), ("x", "double")]
    path = tables.write_version(table, str(tmp_path / "t"), 1)
    tables.append_rows(spark.createDataFrame([(1, "a", 2.0)], table.schema), path)
    assert spark.read.parquet(path).count() == 1


SCHEMA = "user long, id long, t string, kind string, value double"


def summarize(state):
    return state.groupBy("kind").agg(F.count("*").alias("n"), F.sum("value").alias("value"))


def batch_answer(spark, folder):
    latest = spark.read.schema(SCHEMA).parquet(folder).groupBy("user").agg(F.max(F.struct("t", "id", "kind", "value")).alias("r")).select("r.*")
    return sorted(tuple(r) for r in summarize(latest).collect())


def test_stream_in_several_batches(spark, tmp_path):
    folder, target = str(tmp_path / "in"), StreamRefresh(str(tmp_path / "out"))

    def changes(start, stop):
        rows = [(i % 5, i, f"2024-01-01T00:{(i * 37) % 60:02d}", "ab"[i % 2], float(i)) for i in range(start, stop)]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)

    run = lambda: run_refresh(
        change_stream(spark, folder, spark.createDataFrame([], SCHEMA).schema, files_per_batch=1), target, "user", ["t", "id"], summarize
    )
    changes(0, 10), changes(10, 20), changes(20, 25)
    version = run()
    assert version == 3
    assert sorted(tuple(r) for r in spark.read.parquet(target.answers(version)).collect()) == batch_answer(spark, folder)
    assert run() == 3  # nothing new changes nothing
    changes(25, 40)
    version = run()
    assert version == 4
    assert sorted(tuple(r) for r in spark.read.parquet(target.answers(version)).collect()) == batch_answer(spark, folder)


def test_replayed_batch_changes_nothing(spark, tmp_path):
    from quillgrid.streaming.refresh import apply_batch

    target = StreamRefresh(str(tmp_path / "out"))
    step = apply_batch(target, "user", ["t", "id"], summarize)
    first = spark.createDataFrame([(1, 1, "a", "x", 1.0), (1, 2, "b", "y", 2.0)], SCHEMA)
    second = spark.createDataFrame([(1, 3, "c", "x", 5.0), (2, 4, "a", "x", 1.0)], SCHEMA)
    step(first, 0), step(second, 1)
    once = sorted(tuple(r) for r in spark.read.parquet(target.answers(2)).collect())
    step(second, 1)
    assert sorted(tuple(r) for r in spark.read.parquet(target.answers(2)).collect()) == once == [("x", 2, 6.0)]


def test_several_changes_of_one_key(spark):
    import pytest

    table = spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string")
    changes = spark.createDataFrame([(1, "first", 1), (1, "last", 2)], "id long, name string, at long")
    assert sorted(tuple(r) for r in mutate.update_rows(table, changes, "id", order="at").collect()) == [(1, "last"), (2, "b")]
    with pytest.raises(Exception, match="several changes"):
        mutate.update_rows(table, changes.drop("at"), "id").collect()


def test_first_keys_of_empty_tables(spark, tmp_path):
    from quillgrid.plans import QUERIES
    from quillgrid.plans.maintenance import FIRST_ORDER, next_key

    source = "/root/testdata/sf0.001"
    for table in ("orders", "customer", "part", "supplier"):
        rows = spark.read.parquet(f"{source}/{table}.parquet")
        (rows.limit(0) if table != "part" else rows).write.parquet(f"{tmp_path}/{table}.parquet")
    assert next_key(spark.read.parquet(f"{tmp_path}/orders.parquet"), "o_orderkey", FIRST_ORDER) == (5001, 0)
    for name in ("fill_core_rows", "fill_core_customers", "fill_core_employees"):
        assert QUERIES[name](spark, str(tmp_path)).collect() == []


def test_all_children_follow_a_shrunk_parent(spark):
    kept = mutate.kept_keys(spark.createDataFrame([(k,) for k in (9, 3, 5, 7)], "k long"), "k", 2)
    one = spark.createDataFrame([(1, 3), (2, 7), (3, None)], "id long, fk long")
    two = spark.createDataFrame([("x", "9"), ("y", "none")], "id string, parent string")
    first, second = mutate.repoint_children([(one, "fk"), (two, "parent")], kept)
    assert sorted((r.id, r.fk) for r in first.collect()) == [(1, 3), (2, 3), (3, None)]
    assert sorted((r.id, r.parent) for r in second.collect()) == [("x", "3"), ("y", "none")]


def files_under(folder):
    return sorted(os.path.relpath(os.path.join(d, f), folder) for d, _, names in os.walk(folder) for f in names if f.startswith("part-"))


def by_bucket(state, by):
    return state.groupBy(*by, "kind").agg(F.count("*").alias("n"), F.sum("value").alias("x"))


def of_buckets(parts):
    return parts.groupBy("kind").agg(F.sum("n").alias("n"), F.sum("x").alias("x"))


@pytest.mark.parametrize("combine", [None, of_buckets])
def test_a_batch_writes_the_buckets_of_its_keys_only(spark, tmp_path, combine):
    target = StreamRefresh(str(tmp_path / "out"), buckets=16)
    step = apply_batch(target, "user", ["t", "id"], by_bucket if combine else lambda s: by_bucket(s, []), combine)
    rows = [(u, u, "a", "xy"[u % 2], 1.0) for u in range(200)]
    step(spark.createDataFrame(rows, SCHEMA), 0)
    first = target.bucket_versions(spark, 1)
    assert len(first) == 16
    step(spark.createDataFrame([(7, 900, "b", "x", 50.0)], SCHEMA), 1)
    second = target.bucket_versions(spark, 2)
    assert sum(v == 2 for v in second.values()) == 1 and {b: v for b, v in second.items() if v == 1}.items() <= first.items()
    assert len({f.split("/")[0] for f in files_under(target.state(2))}) == 1
    assert {tuple(r) for r in spark.read.parquet(target.answers(2)).collect()} == {("x", 101, 150.0), ("y", 99, 99.0)}
    state = target.current(spark, spark.createDataFrame([], SCHEMA).schema, 2)
    assert state.count() == 200 and state.where("user = 7").first().value == 50.0
    once = files_under(target.base)
    step(spark.createDataFrame([(7, 900, "b", "x", 50.0)], SCHEMA), 1)  # replayed
    assert {tuple(r) for r in spark.read.parquet(target.answers(2)).collect()} == {("x", 101, 150.0), ("y", 99, 99.0)}
    assert len(files_under(target.base)) == len(once) and target.bucket_versions(spark, 2) == second
    # what no version in use needs goes
    step(spark.createDataFrame([(7, 901, "c", "y", 1.0)], SCHEMA), 2)
    step(spark.createDataFrame([(7, 902, "d", "y", 2.0)], SCHEMA), 3)
    kept = {f.split("/")[0] for f in files_under(f"{target.base}/state") if f"bucket={[b for b, v in second.items() if v == 2][0]}/" in f}
    assert kept == {"v=3", "v=4"}


def test_an_empty_batch(spark, tmp_path):
    target = StreamRefresh(str(tmp_path / "out"))
    step = apply_batch(target, "user", ["t", "id"], summarize)
    step(spark.createDataFrame([], SCHEMA), 0)
    assert spark.read.parquet(target.answers(1)).collect() == []
    step(spark.createDataFrame([(None, 1, "a", "x", 1.0)], SCHEMA), 1)
    assert target.current(spark, spark.createDataFrame([], SCHEMA).schema, 2).count() == 1


def test_all_date_columns_by_name(spark):
    assert synth.date_columns(["ord_id", "ord_dt", "strt_ts", "valid_to", "last_run", "ord_nm", "dt_cd"]) == ["ord_dt", "strt_ts", "valid_to", "last_run"]
    tables = {
        "ord_txn": spark.createDataFrame([(1, "x", "a"), (5, "y", "b"), (6, "z", "c"), (7, "w", "d")], "ord_id long, ord_dt string, note string"),
        "att_log": spark.createDataFrame([(k, None, "1999-01-01") for k in range(3)], "att_id long, att_dt string, last_run string"),
        "cd_mst": spark.createDataFrame([(1, "k")], "cd long, nm string"),
    }
    spread = synth.respread_all_dates(tables, {"ord_txn": "ord_id", "att_log": "att_id", "cd_mst": "cd"}, END, {"ord_txn": 5})
    assert [tuple(r) for r in spread["ord_txn"].orderBy("ord_id").collect()][0] == (1, "x", "a")
    dates = [r.ord_dt for r in spread["ord_txn"].where("ord_id >= 5").orderBy("ord_id").collect()]
    assert dates[0] == "2020-01-01" and dates[-1] == END and dates == sorted(dates)
    log = [tuple(r) for r in spread["att_log"].orderBy("att_id").collect()]
    assert all(r[1] == r[2] for r in log) and (log[0][1], log[2][1]) == ("2020-01-01", END)
    assert spread["cd_mst"] is tables["cd_mst"]
