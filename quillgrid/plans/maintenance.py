"""Table maintenance, synthetic rows and the streaming refresh on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vocab
from ..operators import mutate, synth
from ..sources.tables import Tables
from ..streaming.refresh import refresh_events
from .registry import query

END_DATE = "2025-12-31"
TARGET_CUSTOMERS = 1000
TARGET_PARTS = 1500
TARGET_SUPPLIERS = 50

# The first keys of empty tables.
FIRST_CUSTOMER, FIRST_PRODUCT, FIRST_EMPLOYEE, FIRST_ORDER = 101, 1, 1, 5001


def next_key(table: DataFrame, key: str, first: int) -> tuple[int, int]:
    """The key after the highest one, or ``first`` in an empty table; and the number of rows."""
    facts = table.agg(F.max(key).alias("last"), F.count("*").alias("rows")).first()
    return (first if facts["last"] is None else facts["last"] + 1), facts["rows"]

# ---- maintenance -----------------------------------------------------------------------------


@query("upsert_insert", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
UNION ALL SELECT (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY s_suppkey), s_name, s_nationkey, s_acctbal, 'SUPPLIER' FROM supplier""")
def upsert_insert(t: Tables) -> DataFrame:
    """All suppliers become customers under new keys."""
    rows = t.supplier.select(
        F.col("s_suppkey"), F.col("s_name").alias("c_name"), F.col("s_nationkey").alias("c_nationkey"),
        F.col("s_acctbal").alias("c_acctbal"), F.lit("SUPPLIER").alias("c_mktsegment"),
    )
    return mutate.insert_rows(t.customer, rows, "c_custkey", "s_suppkey")


@query("upsert_update", """
SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS c_acctbal,
       CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment FROM customer""")
def upsert_update(t: Tables) -> DataFrame:
    """Overdrawn customers are set to zero and lose their segment."""
    changes = t.customer.where("c_acctbal < 0").select(
        "c_custkey", F.lit(0.0).alias("c_acctbal"), F.lit(None).cast("string").alias("c_mktsegment")
    )
    return mutate.update_rows(t.customer, changes, "c_custkey")


URGENT = "(SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')"


@query("delete_guarded", f"""
SELECT c_custkey, c_name, c_acctbal < 0 AS blocked FROM customer WHERE NOT (c_acctbal < 0 AND c_custkey NOT IN {URGENT})""")
def delete_guarded(t: Tables) -> DataFrame:
    """Overdrawn customers go, unless an urgent order refers to them."""
    urgent = t.orders.where("o_orderpriority = '1-URGENT'")
    remaining, blocked = mutate.delete_guarded(t.customer, t.customer.where("c_acctbal < 0"), urgent, "c_custkey", "o_custkey")
    return remaining.join(blocked.withColumn("blocked", F.lit(True)), "c_custkey", "left").select(
        "c_custkey", "c_name", F.coalesce("blocked", F.lit(False)).alias("blocked")
    )


@query("shrink_to_target", f"""
SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT c_custkey FROM customer ORDER BY c_custkey LIMIT {TARGET_CUSTOMERS})""")
def shrink_to_target(t: Tables) -> DataFrame:
    rows = t.customer.select("c_custkey", "c_name")
    return mutate.shrink_to_target(rows, mutate.kept_keys(rows, "c_custkey", TARGET_CUSTOMERS), "c_custkey")


def kept_sql(table: str, key: str, target: int) -> str:
    return f"kept AS (SELECT {key} AS k, row_number() OVER (ORDER BY {key}) - 1 AS i FROM {table} QUALIFY i < {target})"


@query("repoint_fk", f"""
WITH {kept_sql('customer', 'c_custkey', TARGET_CUSTOMERS)}
SELECT o_orderkey, CASE WHEN o_custkey IN (SELECT k FROM kept) THEN o_custkey
  ELSE (SELECT k FROM kept WHERE i = (o_custkey - 1) % (SELECT count(*) FROM kept)) END AS o_custkey FROM orders""")
def repoint_fk(t: Tables) -> DataFrame:
    kept = mutate.kept_keys(t.customer, "c_custkey", TARGET_CUSTOMERS)
    return mutate.repoint_foreign_key(t.orders.select("o_orderkey", "o_custkey"), kept, "o_custkey")


@query("repoint_suppliers", f"""
WITH {kept_sql('supplier', 's_suppkey', TARGET_SUPPLIERS)}
SELECT l_orderkey, l_linenumber, CASE WHEN l_suppkey IN (SELECT k FROM kept) THEN l_suppkey
  ELSE (SELECT k FROM kept WHERE i = (l_suppkey - 1) % (SELECT count(*) FROM kept)) END AS l_suppkey FROM lineitem""")
def repoint_suppliers(t: Tables) -> DataFrame:
    """The children of shrunk suppliers."""
    kept = mutate.kept_keys(t.supplier, "s_suppkey", TARGET_SUPPLIERS)
    (lines,) = mutate.repoint_children([(t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey"), "l_suppkey")], kept)
    return lines


@query("repoint_children", f"""
WITH {kept_sql('customer', 'c_custkey', TARGET_CUSTOMERS)},
c AS (SELECT 'orders' AS child, o_orderkey AS row_key, o_custkey AS old FROM orders
      UNION ALL SELECT 'labels', doc_id, doc_id + 1 FROM labels)
SELECT child, row_key, CASE WHEN old IN (SELECT k FROM kept) THEN old
  ELSE (SELECT k FROM kept WHERE i = (old - 1) % (SELECT count(*) FROM kept)) END AS customer FROM c""")
def repoint_children(t: Tables) -> DataFrame:
    """Two tables that refer to the customers: the orders, and the labels as if they named a customer."""
    kept = mutate.kept_keys(t.customer, "c_custkey", TARGET_CUSTOMERS)
    orders = t.orders.select(F.lit("orders").alias("child"), F.col("o_orderkey").alias("row_key"), F.col("o_custkey").alias("customer"))
    labels = t.labels.select(F.lit("labels").alias("child"), F.col("doc_id").alias("row_key"), (F.col("doc_id") + 1).alias("customer"))
    first, second = mutate.repoint_children([(orders, "customer"), (labels, "customer")], kept)
    return first.unionByName(second)


@query("recompute_amount", f"""
WITH {kept_sql('part', 'p_partkey', TARGET_PARTS)},
moved AS (SELECT l.*, CASE WHEN l_partkey IN (SELECT k FROM kept) THEN l_partkey
  ELSE (SELECT k FROM kept WHERE i = (l_partkey - 1) % (SELECT count(*) FROM kept)) END AS part FROM lineitem l)
SELECT l_orderkey, l_linenumber, part AS l_partkey, l_quantity,
       CASE WHEN part <> l_partkey THEN l_quantity * p_retailprice ELSE l_extendedprice END AS l_extendedprice
FROM moved LEFT JOIN part ON p_partkey = part""")
def recompute_amount(t: Tables) -> DataFrame:
    kept = mutate.kept_keys(t.part, "p_partkey", TARGET_PARTS)
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    moved = mutate.repoint_foreign_key(lines, kept, "l_partkey", flag="moved")
    prices = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_retailprice")
    return mutate.recompute_amount(moved, prices, "moved", "l_partkey", "l_quantity", "l_extendedprice", "p_retailprice").drop("moved")


@query("constraint_check", """
SELECT 'customer key' AS "check", count(*) - count(DISTINCT c_custkey) AS violations FROM customer
UNION ALL SELECT 'line key', count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) FROM lineitem
UNION ALL SELECT 'names', count(*) FILTER (WHERE c_name IS NULL) + count(*) FILTER (WHERE c_mktsegment IS NULL) FROM customer
UNION ALL SELECT 'order customer', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
UNION ALL SELECT 'line order', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)""")
def constraint_check(t: Tables) -> DataFrame:
    """Keys, required values and references; overdrawn customers count as closed."""
    return mutate.constraint_check([
        ("customer key", mutate.duplicate_keys(t.customer, ["c_custkey"])),
        ("line key", mutate.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])),
        ("names", mutate.missing_values(t.customer, ["c_name", "c_mktsegment"])),
        ("order customer", mutate.orphans(t.orders, "o_custkey", t.customer.where("c_acctbal >= 0"), "c_custkey")),
        ("line order", mutate.orphans(t.lineitem, "l_orderkey", t.orders, "o_orderkey")),
    ])


# ---- synthetic rows: as many again as the given table holds -----------------------------------


def sql_list(values) -> str:
    return "[" + ", ".join(repr(v) for v in values) + "]"


STATE_CODES = sql_list([s[0] for s in vocab.STATES])
PERSON = f"{sql_list(vocab.FIRST_NAMES)}[i % 8 + 1] || ' ' || {sql_list(vocab.LAST_NAMES)}[(i // 8) % 8 + 1]"
CITIES = "[" + ", ".join(sql_list(s[3]) for s in vocab.STATES) + "]"


def city_sql(step: int) -> str:
    own = f"{CITIES}[i % 6 + 1]"
    return f"{own}[(i // {step}) % len({own}) + 1]"


def date_sql(index: str, total: str) -> str:
    days = f"CAST(({index}) % {total} AS DOUBLE) * date_diff('day', DATE '2020-01-01', DATE '{END_DATE}') / greatest({total} - 1, 1)"
    return f"strftime(DATE '2020-01-01' + CAST(round_even({days}, 0) AS INTEGER), '%Y-%m-%d')"


def range_sql(table: str) -> str:
    return f"r AS (SELECT i, (SELECT count(*) FROM {table}) AS n FROM range((SELECT count(*) FROM {table})) g(i))"


@query("fill_core_rows", f"""
WITH {range_sql('orders')}, c AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS ci, count(*) OVER () AS cn FROM customer),
p AS (SELECT p_partkey, p_retailprice, row_number() OVER (ORDER BY p_partkey) - 1 AS pi, count(*) OVER () AS pn FROM part)
SELECT (SELECT max(o_orderkey) FROM orders) + 1 + i AS ord_id, c_custkey AS cust_id, p_partkey AS prod_id, 1 + i % 8 AS qty,
       round(p_retailprice * (1 + i % 8), 2) AS amt, {date_sql('i', 'n')} AS ord_dt,
       CAST({sql_list(vocab.STATUS_CYCLE)}[i % 6 + 1] AS INTEGER) AS stat_cd
FROM r JOIN c ON ci = i % cn JOIN p ON pi = (i * 7) % pn""")
def fill_core_rows(t: Tables) -> DataFrame:
    first, rows = next_key(t.orders, "o_orderkey", FIRST_ORDER)
    customers = t.customer.select(F.col("c_custkey").alias("cust_id"))
    products = t.part.select(F.col("p_partkey").alias("prod_id"), F.col("p_retailprice").alias("unit_prc"))
    return synth.fill_orders(t.spark, customers, products, first, rows, END_DATE)


@query("fill_core_customers", f"""
WITH {range_sql('customer')}, s AS (SELECT *, (SELECT max(c_custkey) FROM customer) + 1 + i AS id FROM r)
SELECT id AS cust_id, {PERSON} || ' ' || id AS cust_nm, {STATE_CODES}[i % 6 + 1] AS st_cd, {city_sql(6)} AS city_nm, {date_sql('i', 'n')} AS crtd_dt FROM s""")
def fill_core_customers(t: Tables) -> DataFrame:
    first, rows = next_key(t.customer, "c_custkey", FIRST_CUSTOMER)
    return synth.fill_customers(t.spark, first, rows, END_DATE)


@query("fill_core_products", f"""
WITH {range_sql('part')}, s AS (SELECT *, (SELECT max(p_partkey) FROM part) + 1 + i AS id FROM r)
SELECT id AS prod_id, {sql_list([p[0] for p in vocab.PRODUCTS])}[i % 8 + 1] || ' Model ' || id AS prod_nm,
       {sql_list([p[1] for p in vocab.PRODUCTS])}[i % 8 + 1] AS cat_cd,
       round({sql_list([p[2] for p in vocab.PRODUCTS])}[i % 8 + 1] * CAST(0.85 + (i % 31) / 100 AS DOUBLE), 2) AS unit_prc FROM s""")
def fill_core_products(t: Tables) -> DataFrame:
    first, rows = next_key(t.part, "p_partkey", FIRST_PRODUCT)
    return synth.fill_products(t.spark, first, rows)


@query("fill_core_employees", f"""
WITH {range_sql('supplier')}, s AS (SELECT *, (SELECT max(s_suppkey) FROM supplier) + 1 + i AS id FROM r)
SELECT id AS emp_id, {PERSON} || ' ' || id AS emp_nm, {sql_list(vocab.DEPARTMENTS)}[i % 6 + 1] AS dept_cd,
       CAST(42000 + (i % 16) * 6500 AS DOUBLE) AS sal, {date_sql('i', 'n')} AS join_dt FROM s""")
def fill_core_employees(t: Tables) -> DataFrame:
    first, rows = next_key(t.supplier, "s_suppkey", FIRST_EMPLOYEE)
    return synth.fill_employees(t.spark, first, rows, END_DATE)


@query("fill_core_states", f"""
WITH {range_sql('customer')}
SELECT {STATE_CODES}[i % 6 + 1] || printf('%04d', n + i) AS st_cd, {sql_list([s[1] for s in vocab.STATES])}[i % 6 + 1] || ' Demo Zone ' || (n + i + 1) AS st_nm,
       {sql_list([s[2] for s in vocab.STATES])}[i % 6 + 1] AS regn_cd FROM r""")
def fill_core_states(t: Tables) -> DataFrame:
    rows = t.customer.count()
    return synth.fill_states(t.spark, rows, rows)


INVOICE = ["inv_id", "cust_id", "inv_dt", "tot_amt", "st_cd", "city_nm", "stat_cd", "cust_nm", "in_tm", "mode_cd", "raw_json", "rsn_cd", "rating", "upd_ts"]
MEASURE = "CAST(round(500 + (i * 173 % 250000) / 100, 2) AS DOUBLE)::VARCHAR"


@query("fill_generic_rows", f"""
WITH {range_sql('orders')}, c AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS ci, count(*) OVER () AS cn FROM customer)
SELECT CAST(i + 1 AS VARCHAR) AS inv_id, CAST(c_custkey AS VARCHAR) AS cust_id, {date_sql("i + length('inv_hdr')", '5000')} AS inv_dt,
  {MEASURE} AS tot_amt, {STATE_CODES}[i % 6 + 1] AS st_cd, {city_sql(3)} AS city_nm, ['1', '2', '3', '1', '1', '0'][i % 6 + 1] AS stat_cd,
  'Inv Hdr ' || printf('%05d', i + 1) AS cust_nm, printf('%02d:%02d:00', 8 + i % 10, (i * 7) % 60) AS in_tm,
  'Mode Cd ' || printf('%05d', i + 1) AS mode_cd, '{{"source": "demo_seed", "table": "inv_hdr", "row": ' || (i + 1) || '}}' AS raw_json,
  'Rsn Cd ' || printf('%05d', i + 1) AS rsn_cd, CAST(1 + i % 5 AS VARCHAR) AS rating, {date_sql("i + length('inv_hdr')", '5000')} AS upd_ts
FROM r JOIN c ON ci = (i * 13) % cn""")
def fill_generic_rows(t: Tables) -> DataFrame:
    """Invoice headers for as many rows as there are orders, pointing at the customers."""
    parents = {"cust_mst": t.customer.select(F.col("c_custkey").alias("cust_id"))}
    return synth.fill_generic(t.spark, "inv_hdr", INVOICE, "inv_id", 0, t.orders.count(), parents, END_DATE)


@query("respread_dates", f"""
WITH g AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS i, count(*) OVER () AS n FROM orders WHERE o_orderkey >= 10)
SELECT o_orderkey, {date_sql('i', 'n')} AS o_orderdate FROM g
UNION ALL SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') FROM orders WHERE o_orderkey < 10""")
def respread_dates(t: Tables) -> DataFrame:
    """All orders but the ten starter rows get evenly spread dates."""
    rows = synth.respread_dates(t.orders.select("o_orderkey", "o_orderdate"), "o_orderkey", ["o_orderdate"], END_DATE, floor=10)
    return rows.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


# ---- streaming -------------------------------------------------------------------------------


@query("stream_refresh", """
WITH latest AS (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
SELECT event_type, count(*) AS users, round(sum(value), 2) AS value FROM latest GROUP BY event_type""")
def stream_refresh(t: Tables) -> DataFrame:
    """The events table arrives as a stream of changes; the answer is the saved summary."""
    return refresh_events(t.spark, f"{t.folder}/events.parquet", t.events.schema)
