"""Scans, filters, joins, aggregates, top-n and set operations on the sales tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import mutate, ordering, sets, star
from ..operators.star import Star, star_of_order_lines
from ..session import constant_frame
from ..sources import tables as source
from ..sources.tables import Tables
from .registry import query

STATE = 7
DEPARTMENT = 3
MONTH = "1996-07"
PRICE = 950.0
STATUS = "P"
AMOUNT = 400000.0
CUSTOMER = "Customer#000000042"
LABELS = {"F": "Fulfilled", "O": "Open"}
MEANINGS = [("F", "fulfilled"), ("F", "delivered"), ("O", "open"), ("P", "pending"), ("P", "in progress")]


def sales(t: Tables) -> Star:
    return star_of_order_lines(t.customer, t.orders, t.lineitem, t.part, t.supplier)


# ---- scans -----------------------------------------------------------------------------------

@query("scan_table", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority
FROM orders""")
def scan_table(t: Tables) -> DataFrame:
    return t.orders.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


@query("page_scan", """
SELECT o_orderkey, o_custkey, o_totalprice, (SELECT CAST(greatest(1, ceil(count(*) / 100.0)) AS BIGINT) FROM orders) AS pages
FROM orders ORDER BY o_orderkey LIMIT 100 OFFSET 200""")
def page_scan(t: Tables) -> DataFrame:
    rows = source.page(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), "o_orderkey", 3, 100)
    return rows.withColumn("pages", source.page_count(t.orders, 100).scalar())


@query("page_after_key", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey > 299 ORDER BY o_orderkey LIMIT 100""")
def page_after_key(t: Tables) -> DataFrame:
    return source.page_after(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), "o_orderkey", 299, 100)


@query("preview_rows", """
SELECT o_orderkey, o_totalprice, (SELECT greatest(count(*) - 20, 0) FROM orders) AS more
FROM orders ORDER BY o_orderkey LIMIT 20""")
def preview_rows(t: Tables) -> DataFrame:
    return source.preview(t.orders.select("o_orderkey", "o_totalprice"), "o_orderkey")


# ---- filters and projections -----------------------------------------------------------------

@query("filter_eq_text", f"SELECT c_name AS customer_name FROM customer WHERE c_nationkey = {STATE}")
def filter_eq_text(t: Tables) -> DataFrame:
    return star.customers_in_state(sales(t), STATE)


@query("filter_department", f"SELECT s_name AS employee_name FROM supplier WHERE s_nationkey = {DEPARTMENT}")
def filter_department(t: Tables) -> DataFrame:
    return star.employees_in_department(sales(t), DEPARTMENT)


@query("filter_month_prefix", f"SELECT count(*) AS orders FROM orders WHERE strftime(o_orderdate, '%Y-%m') = '{MONTH}'")
def filter_month_prefix(t: Tables) -> DataFrame:
    return star.orders_in_month(sales(t), MONTH)


@query("filter_gt_count", f"SELECT count(*) AS products FROM part WHERE p_retailprice > {PRICE}")
def filter_gt_count(t: Tables) -> DataFrame:
    return star.products_above_price(sales(t), PRICE)


@query("filter_conj", f"SELECT o_orderkey AS order_id FROM orders WHERE o_orderstatus = '{STATUS}' AND o_totalprice > {AMOUNT}")
def filter_conj(t: Tables) -> DataFrame:
    return star.orders_with_status_above(sales(t), STATUS, AMOUNT)


@query("filter_coded_count", "SELECT count(*) AS orders FROM orders WHERE o_orderstatus = 'F'")
def filter_coded_count(t: Tables) -> DataFrame:
    meanings = constant_frame(t.spark, MEANINGS, "status string, meaning string")
    return star.count_by_meaning(sales(t), meanings, "Delivered")


@query("filter_not_null_options", """
SELECT DISTINCT p_type AS category FROM part WHERE p_type IS NOT NULL ORDER BY category""")
def filter_not_null_options(t: Tables) -> DataFrame:
    return star.options(sales(t).products, "category")


@query("key_options_by_name", "SELECT c_custkey AS customer_id FROM customer ORDER BY c_name, c_custkey")
def key_options_by_name(t: Tables) -> DataFrame:
    return star.key_options(sales(t).customers, "customer_id", "customer_name")


@query("row_search_any_column", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
WHERE regexp_matches(CAST(c_custkey AS VARCHAR), 'build.*|7{3}', 'i') OR regexp_matches(c_name, 'build.*|7{3}', 'i')
   OR regexp_matches(CAST(c_nationkey AS VARCHAR), 'build.*|7{3}', 'i') OR regexp_matches(c_mktsegment, 'build.*|7{3}', 'i')
   OR regexp_matches(CAST(c_acctbal AS VARCHAR), 'build.*|7{3}', 'i')""")
def row_search_any_column(t: Tables) -> DataFrame:
    return star.search_any_column(t.customer, "BUILD.*|7{3}")


@query("row_search_literal", """
SELECT p_partkey, p_name, p_brand FROM part
WHERE contains(CAST(p_partkey AS VARCHAR), 'brand#1') OR contains(lower(p_name), 'brand#1') OR contains(lower(p_brand), 'brand#1')""")
def row_search_literal(t: Tables) -> DataFrame:
    return star.search_any_column(t.part.select("p_partkey", "p_name", "p_brand"), "Brand#1", literal=True)


CASE_STATUS = "CASE o_orderstatus WHEN 'F' THEN 'Fulfilled' WHEN 'O' THEN 'Open' ELSE 'Other' END"


@query("case_label", f"SELECT o_orderkey AS order_id, {CASE_STATUS} AS status FROM orders")
def case_label(t: Tables) -> DataFrame:
    return sales(t).orders.select("order_id", star.label_by_code(F.col("status"), LABELS).alias("status"))


@query("label_lookup", """
SELECT o_orderkey AS order_id, coalesce(c_name || ' (ID ' || o_custkey || ')', CAST(o_custkey AS VARCHAR)) AS label
FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal >= 0) c ON c_custkey = o_custkey""")
def label_lookup(t: Tables) -> DataFrame:
    names = t.customer.where("c_acctbal >= 0")
    rows = sales(t).orders.select("order_id", "customer_id")
    return star.with_label(rows, "customer_id", names, "c_custkey", "c_name").select("order_id", "label")


# ---- joins -----------------------------------------------------------------------------------

@query("join_inner_group", """
SELECT c_custkey AS customer_id, c_name AS customer_name, round(sum(o_totalprice), 2) AS spend, count(o_orderkey) AS orders
FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_name""")
def join_inner_group(t: Tables) -> DataFrame:
    return star.customer_totals(sales(t))


@query("join_three_way_distinct", f"""
SELECT DISTINCT p_name AS product_name FROM customer JOIN orders ON c_custkey = o_custkey
JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey WHERE c_name = '{CUSTOMER}'""")
def join_three_way_distinct(t: Tables) -> DataFrame:
    return star.products_of_customer(sales(t), CUSTOMER)


@query("join_left_unknown", """
SELECT coalesce(CAST(c_nationkey AS VARCHAR), 'Unknown') AS state, count(*) AS orders
FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal >= 0) c ON c_custkey = o_custkey
GROUP BY 1 ORDER BY orders DESC, state LIMIT 10""")
def join_left_unknown(t: Tables) -> DataFrame:
    s = sales(t)
    return star.orders_by_state(s, star_of_order_lines(t.customer.where("c_acctbal >= 0"), t.orders, t.lineitem, t.part, t.supplier).customers)


@query("join_left_two_dims", """
SELECT l_orderkey AS order_id, strftime(l_shipdate, '%Y-%m-%d') AS date, c_name AS customer, p_name AS product,
       l_quantity AS quantity, l_extendedprice AS amount, o_orderstatus AS status_code
FROM (SELECT * FROM lineitem ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_extendedprice DESC LIMIT 8)
LEFT JOIN orders ON o_orderkey = l_orderkey LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN part ON p_partkey = l_partkey""")
def join_left_two_dims(t: Tables) -> DataFrame:
    return star.recent_orders(sales(t), 8)


@query("recent_n", """
SELECT o_orderkey AS order_id, strftime(o_orderdate, '%Y-%m-%d') AS date, o_totalprice AS amount
FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 8""")
def recent_n(t: Tables) -> DataFrame:
    return star.latest_orders(sales(t), 8)


@query("project_rename", """
SELECT o_orderkey AS order_id, strftime(o_orderdate, '%Y-%m-%d') AS date, c_name AS customer, o_totalprice AS amount, o_orderstatus AS status_code
FROM orders LEFT JOIN customer ON c_custkey = o_custkey""")
def project_rename(t: Tables) -> DataFrame:
    return star.order_report(sales(t))


@query("anti_not_in", """
SELECT c_name AS customer_name FROM customer
WHERE c_custkey NOT IN (SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""")
def anti_not_in(t: Tables) -> DataFrame:
    urgent = t.orders.where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("customer_id"))
    return star.customers_without_orders(sales(t), urgent)


@query("anti_not_exists", """
SELECT c_name AS customer_name FROM customer
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')""")
def anti_not_exists(t: Tables) -> DataFrame:
    urgent = t.orders.where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey")).distinct()
    return t.customer.join(urgent, "c_custkey", "left_anti").select(F.col("c_name").alias("customer_name"))


@query("semi_ordered_products", "SELECT DISTINCT p_name AS product_name FROM part JOIN lineitem ON p_partkey = l_partkey")
def semi_ordered_products(t: Tables) -> DataFrame:
    return star.ordered_products(sales(t))


USERS_SQL = "SELECT c_custkey AS user_id, c_name AS user_name, 'contact' || (c_custkey + 1) || '@example.test' AS email FROM customer"


@query("identity_lookup_ci", f"""
WITH users AS ({USERS_SQL}),
probes AS (SELECT upper(c_name) AS probe FROM customer UNION SELECT upper(s_name) FROM supplier UNION SELECT upper(email) FROM users)
SELECT DISTINCT probe, user_id FROM probes
LEFT JOIN (SELECT user_id, lower(user_name) AS k FROM users UNION SELECT user_id, lower(email) FROM users) u ON lower(probe) = k""")
def identity_lookup_ci(t: Tables) -> DataFrame:
    users = t.customer.select(
        F.col("c_custkey").alias("user_id"), F.col("c_name").alias("user_name"),
        F.concat(F.lit("contact"), (F.col("c_custkey") + 1).cast("string"), F.lit("@example.test")).alias("email"),
    )
    probes = sets.union_distinct(
        t.customer.select(F.upper("c_name").alias("probe")).union(t.supplier.select(F.upper("s_name"))),
        users.select(F.upper("email").alias("probe")),
    )
    return star.identity_lookup(probes, users)


@query("open_request_join", """
WITH r AS (SELECT user_id, ts, event_id FROM events WHERE event_type = 'signup'),
open AS (SELECT * FROM r WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = r.user_id AND e.event_type = 'purchase'
         AND (e.ts, e.event_id) > (r.ts, r.event_id))),
newest AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM open)
SELECT user_id, c_name, event_id AS request_id FROM newest JOIN customer ON c_custkey = user_id WHERE n = 1""")
def open_request_join(t: Tables) -> DataFrame:
    parents = t.customer.select(F.col("c_custkey").alias("user_id"), "c_name")
    return ordering.open_requests(t.events, parents, "user_id", "ts", "event_id", F.col("event_type"), "signup", "purchase")


@query("fk_dependents", """
SELECT c_custkey, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS dependents FROM customer WHERE c_acctbal < 0""")
def fk_dependents(t: Tables) -> DataFrame:
    return mutate.count_dependents(t.customer.where("c_acctbal < 0"), t.orders, "c_custkey", "o_custkey")


# ---- aggregates ------------------------------------------------------------------------------

@query("agg_count_all", "SELECT count(*) AS customers FROM customer")
def agg_count_all(t: Tables) -> DataFrame:
    return t.customer.agg(F.count("*").alias("customers"))


@query("agg_sum_all", "SELECT round(sum(o_totalprice), 2) AS total FROM orders")
def agg_sum_all(t: Tables) -> DataFrame:
    return star.total_amount(sales(t))


@query("agg_max_all", "SELECT max(o_totalprice) AS largest FROM orders")
def agg_max_all(t: Tables) -> DataFrame:
    return star.largest_amount(sales(t))


@query("agg_sum_filtered_join", f"""
SELECT round(sum(o_totalprice), 2) AS total FROM customer JOIN orders ON c_custkey = o_custkey WHERE c_nationkey = {STATE}""")
def agg_sum_filtered_join(t: Tables) -> DataFrame:
    return star.spend_of_state(sales(t), STATE)


@query("agg_group_sum", """
SELECT c_custkey AS customer_id, c_name AS customer_name, round(sum(o_totalprice), 2) AS total
FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_name ORDER BY total DESC, customer_id""")
def agg_group_sum(t: Tables) -> DataFrame:
    return star.spend_by_customer(sales(t))


@query("agg_group_count", """
SELECT c_custkey AS customer_id, c_name AS customer_name, count(o_orderkey) AS orders
FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_name""")
def agg_group_count(t: Tables) -> DataFrame:
    return star.orders_by_customer(sales(t))


@query("agg_group_avg", """
SELECT s_nationkey AS department, round(sum(s_acctbal), 2) / count(s_acctbal) AS average_salary FROM supplier GROUP BY s_nationkey""")
def agg_group_avg(t: Tables) -> DataFrame:
    return star.average_by(sales(t).employees, "department", "salary", "average_salary")


@query("agg_kpi_row", """
SELECT (SELECT count(*) FROM customer) AS customers, (SELECT count(*) FROM part) AS products, count(*) AS orders,
       (SELECT count(*) FROM supplier) AS employees, coalesce(round(sum(o_totalprice), 2), 0) AS revenue,
       coalesce(round(sum(o_totalprice), 2) / count(o_totalprice), 0) AS average_order,
       count(*) FILTER (WHERE o_orderstatus = 'F') AS delivered
FROM orders""")
def agg_kpi_row(t: Tables) -> DataFrame:
    return star.kpi_row(sales(t), "F")


@query("agg_by_status", f"""
SELECT {CASE_STATUS} AS status, count(*) AS orders FROM orders GROUP BY o_orderstatus ORDER BY o_orderstatus""")
def agg_by_status(t: Tables) -> DataFrame:
    return star.orders_by_status(sales(t), LABELS)


@query("agg_by_month", """
SELECT strftime(o_orderdate, '%Y-%m') AS month, round(sum(o_totalprice), 2) AS revenue FROM orders GROUP BY 1 ORDER BY 1""")
def agg_by_month(t: Tables) -> DataFrame:
    return star.revenue_by_month(sales(t))


@query("agg_by_category", """
SELECT coalesce(CASE WHEN p_size > 25 THEN NULL ELSE p_type END, 'Uncategorized') AS category, round(sum(l_extendedprice), 2) AS revenue
FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1 ORDER BY revenue DESC, category""")
def agg_by_category(t: Tables) -> DataFrame:
    # large parts count as not yet categorised, which gives the NULL group
    part = t.part.withColumn("p_type", F.when(F.col("p_size") > 25, F.lit(None)).otherwise(F.col("p_type")))
    return star.revenue_by_category(star_of_order_lines(t.customer, t.orders, t.lineitem, part, t.supplier))


@query("agg_by_department", """
SELECT coalesce(CAST(CASE WHEN s_acctbal < 0 THEN NULL ELSE s_nationkey END AS VARCHAR), 'Unassigned') AS department, count(*) AS employees
FROM supplier GROUP BY 1 ORDER BY employees DESC, department LIMIT 10""")
def agg_by_department(t: Tables) -> DataFrame:
    supplier = t.supplier.withColumn("s_nationkey", F.when(F.col("s_acctbal") < 0, F.lit(None)).otherwise(F.col("s_nationkey")))
    return star.headcount_by_department(star_of_order_lines(t.customer, t.orders, t.lineitem, t.part, supplier).employees)


# ---- windows on events -----------------------------------------------------------------------

@query("latest_per_key", """
SELECT user_id, event_id, event_type, value, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1""")
def latest_per_key(t: Tables) -> DataFrame:
    rows = t.events.select("user_id", "ts", "event_id", "event_type", "value")
    latest = ordering.latest_per_key(rows, "user_id", ["ts", "event_id"])
    return latest.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))


@query("cooldown_gap", """
WITH g AS (SELECT event_id, user_id,
  date_diff('microsecond', lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id), ts) / 1000000.0 AS gap_seconds FROM events)
SELECT event_id, user_id, gap_seconds, coalesce(gap_seconds < 60, false) AS blocked,
  CAST(CASE WHEN gap_seconds < 60 THEN floor(60 - gap_seconds) ELSE 0 END AS BIGINT) AS seconds_left FROM g""")
def cooldown_gap(t: Tables) -> DataFrame:
    return ordering.cooldown(t.events.select("event_id", "user_id", "ts"), "user_id", "ts", "event_id").drop("ts")


@query("row_enumerate", """
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS row_index FROM orders""")
def row_enumerate(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderdate", "o_orderkey")
    return ordering.enumerate_rows(rows, "o_orderdate", "o_orderkey").drop("o_orderdate")


# ---- top-n -----------------------------------------------------------------------------------

@query("top1_by_column", "SELECT p_name AS product_name FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 1")
def top1_by_column(t: Tables) -> DataFrame:
    return star.dearest_product(sales(t))


@query("top1_by_agg_sum", """
SELECT c_name AS customer_name FROM customer JOIN orders ON c_custkey = o_custkey
GROUP BY c_custkey, c_name ORDER BY round(sum(o_totalprice), 2) DESC, c_custkey LIMIT 1""")
def top1_by_agg_sum(t: Tables) -> DataFrame:
    return star.biggest_spender(sales(t))


@query("top1_by_agg_count", "SELECT p_type AS category FROM part GROUP BY p_type ORDER BY count(*) DESC, p_type LIMIT 1")
def top1_by_agg_count(t: Tables) -> DataFrame:
    return star.largest_category(sales(t))


@query("top5_customers", """
SELECT c_name AS customer, round(sum(o_totalprice), 2) AS spend FROM customer JOIN orders ON c_custkey = o_custkey
GROUP BY c_custkey, c_name ORDER BY spend DESC, c_custkey LIMIT 5""")
def top5_customers(t: Tables) -> DataFrame:
    return star.top_customers(sales(t), 5)


@query("top10_products", """
SELECT p_partkey AS product_id, p_name AS product, round(sum(l_extendedprice), 2) AS revenue
FROM part JOIN lineitem ON p_partkey = l_partkey GROUP BY p_partkey, p_name ORDER BY revenue DESC, product_id LIMIT 10""")
def top10_products(t: Tables) -> DataFrame:
    return star.top_products(sales(t), 10)


@query("top_category_revenue", """
SELECT p_type AS category, round(sum(l_extendedprice), 2) AS revenue FROM part JOIN lineitem ON p_partkey = l_partkey
GROUP BY p_type ORDER BY revenue DESC, category LIMIT 1""")
def top_category_revenue(t: Tables) -> DataFrame:
    return star.best_selling_category(sales(t))


# ---- set operations --------------------------------------------------------------------------

def _nations(t: Tables) -> tuple[DataFrame, DataFrame]:
    return (
        t.customer.where("c_acctbal < 0").select(F.col("c_nationkey").alias("nationkey")),
        t.supplier.where("s_acctbal < 0").select(F.col("s_nationkey").alias("nationkey")),
    )


SET_SIDES = ("SELECT c_nationkey AS nationkey FROM customer WHERE c_acctbal < 0", "SELECT s_nationkey FROM supplier WHERE s_acctbal < 0")


@query("union_query", f"{SET_SIDES[0]} UNION {SET_SIDES[1]}")
def union_query(t: Tables) -> DataFrame:
    return sets.union_distinct(*_nations(t))


@query("intersect_query", f"{SET_SIDES[0]} INTERSECT {SET_SIDES[1]}")
def intersect_query(t: Tables) -> DataFrame:
    return sets.intersect_distinct(*_nations(t))


@query("except_query", f"{SET_SIDES[0]} EXCEPT {SET_SIDES[1]}")
def except_query(t: Tables) -> DataFrame:
    return sets.except_distinct(*_nations(t))


@query("cte_query", "WITH x AS (SELECT c_custkey FROM customer) SELECT count(*) AS customers FROM x")
def cte_query(t: Tables) -> DataFrame:
    return t.spark.sql(
        "WITH x AS (SELECT c_custkey FROM {customer}) SELECT count(*) AS customers FROM x", customer=t.customer
    )
