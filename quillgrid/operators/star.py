"""Queries over a sales star: filters, joins, grouped and top-n aggregates, dashboard summaries.

Every query takes a :class:`Star`. Facts are aggregated on the foreign key before they meet a
dimension, so a customer or product that holds a large share of all rows is reduced inside the
scan tasks and never reaches one shuffle partition as raw rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vocab
from ..functions.dates import in_month, month_text
from ..session import broadcast_if_small, written_table

KEYS_BROADCAST = 1_000_000


@dataclass(frozen=True)
class Star:
    """Frames with agreed column names.

    customers(customer_id, customer_name, state), orders(order_id, customer_id, amount,
    order_date, status), lines(order_id, line_no, product_id, qty, line_amount, line_date),
    products(product_id, product_name, category, price),
    employees(employee_id, employee_name, department, salary).
    """

    customers: DataFrame
    orders: DataFrame
    lines: DataFrame
    products: DataFrame
    employees: DataFrame


def star_of_single_line_orders(cust_mst: DataFrame, prod_mst: DataFrame, ord_txn: DataFrame, emp_rec: DataFrame) -> Star:
    """The layout where an order holds exactly one product."""
    return Star(
        customers=cust_mst.select(F.col("cust_id").alias("customer_id"), F.col("cust_nm").alias("customer_name"), F.col("st_cd").alias("state")),
        orders=ord_txn.select(F.col("ord_id").alias("order_id"), F.col("cust_id").alias("customer_id"), F.col("amt").alias("amount"), F.col("ord_dt").alias("order_date"), F.col("stat_cd").alias("status")),
        lines=ord_txn.select(F.col("ord_id").alias("order_id"), F.lit(1).alias("line_no"), F.col("prod_id").alias("product_id"), F.col("qty"), F.col("amt").alias("line_amount"), F.col("ord_dt").alias("line_date")),
        products=prod_mst.select(F.col("prod_id").alias("product_id"), F.col("prod_nm").alias("product_name"), F.col("cat_cd").alias("category"), F.col("unit_prc").alias("price")),
        employees=emp_rec.select(F.col("emp_id").alias("employee_id"), F.col("emp_nm").alias("employee_name"), F.col("dept_cd").alias("department"), F.col("sal").alias("salary")),
    )


def star_of_order_lines(customer: DataFrame, orders: DataFrame, lineitem: DataFrame, part: DataFrame, supplier: DataFrame) -> Star:
    """The layout where an order has several lines; suppliers stand for employees."""
    return Star(
        customers=customer.select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"), F.col("c_nationkey").alias("state")),
        orders=orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"), F.col("o_totalprice").alias("amount"), F.col("o_orderdate").alias("order_date"), F.col("o_orderstatus").alias("status")),
        lines=lineitem.select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"), F.col("l_partkey").alias("product_id"), F.col("l_quantity").alias("qty"), F.col("l_extendedprice").alias("line_amount"), F.col("l_shipdate").alias("line_date")),
        products=part.select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"), F.col("p_type").alias("category"), F.col("p_retailprice").alias("price")),
        employees=supplier.select(F.col("s_suppkey").alias("employee_id"), F.col("s_name").alias("employee_name"), F.col("s_nationkey").alias("department"), F.col("s_acctbal").alias("salary")),
    )


# ---- filters ---------------------------------------------------------------------------------

def customers_in_state(star: Star, state) -> DataFrame:
    return star.customers.where(F.col("state") == F.lit(state)).select("customer_name")


def employees_in_department(star: Star, department) -> DataFrame:
    return star.employees.where(F.col("department") == F.lit(department)).select("employee_name")


def orders_in_month(star: Star, month: str) -> DataFrame:
    dtype = star.orders.schema["order_date"].dataType.simpleString()
    return star.orders.where(in_month(F.col("order_date"), dtype, month)).agg(F.count("*").alias("orders"))


def products_above_price(star: Star, price: float) -> DataFrame:
    return star.products.where(F.col("price") > price).agg(F.count("*").alias("products"))


def orders_with_status_above(star: Star, status, amount: float) -> DataFrame:
    return star.orders.where((F.col("status") == F.lit(status)) & (F.col("amount") > amount)).select("order_id")


def count_by_meaning(star: Star, meanings: DataFrame, meaning: str) -> DataFrame:
    """Count the orders whose status code has the given meaning in the glossary."""
    codes = meanings.where(F.lower("meaning") == meaning.lower()).select("status").distinct()
    return star.orders.join(codes, "status", "left_semi").agg(F.count("*").alias("orders"))


def options(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct non-null values."""
    return df.select(column).dropna().distinct().orderBy(column)


def key_options(df: DataFrame, key: str, name: str) -> DataFrame:
    """Keys in the order of their names."""
    return df.orderBy(name, key).select(key)


def search_any_column(df: DataFrame, pattern: str, literal: bool = False) -> DataFrame:
    """Rows where any column, as text, matches without regard to case. NULL never matches."""
    hit = F.lit(False)
    for column in df.columns:
        text = F.col(column).cast("string")
        match = F.contains(F.lower(text), F.lit(pattern.lower())) if literal else text.rlike("(?i)" + pattern)
        hit = hit | F.coalesce(match, F.lit(False))
    return df.where(hit)


def label_by_code(code: Column, labels: dict) -> Column:
    """Code -> label, any other code -> 'Other'."""
    label = F
    for value, text in labels.items():
        label = label.when(code == F.lit(value), text)
    return label.otherwise("Other")


def with_label(df: DataFrame, key: str, dimension: DataFrame, dim_key: str, dim_name: str, out: str = "label") -> DataFrame:
    """``name (ID n)`` for a known id, else the id as text."""
    names = dimension.select(F.col(dim_key).alias(key), F.col(dim_name).alias("__name"))
    known = F.concat(F.col("__name"), F.lit(" (ID "), F.col(key).cast("string"), F.lit(")"))
    return df.join(names, key, "left").withColumn(out, F.coalesce(known, F.col(key).cast("string"))).drop("__name")


# ---- joins and grouped aggregates ------------------------------------------------------------

def _per_customer(star: Star) -> DataFrame:
    return star.orders.groupBy("customer_id").agg(
        F.sum("amount").alias("spend"), F.count("order_id").alias("orders")
    )


def customer_totals(star: Star) -> DataFrame:
    """Spend and number of orders of every customer with orders."""
    return star.customers.join(_per_customer(star), "customer_id").select(
        "customer_id", "customer_name", F.round("spend", 2).alias("spend"), "orders"
    )


def spend_by_customer(star: Star) -> DataFrame:
    """Every customer with orders, by total spend descending."""
    return (
        star.customers.join(_per_customer(star).drop("orders"), "customer_id")
        .select("customer_id", "customer_name", F.round("spend", 2).alias("total"))
        .orderBy(F.desc("total"), "customer_id")
    )


def orders_by_customer(star: Star) -> DataFrame:
    return star.customers.join(_per_customer(star).drop("spend"), "customer_id").select("customer_id", "customer_name", "orders")


def products_of_customer(star: Star, name: str) -> DataFrame:
    """Distinct names of the products that one customer ordered.

    The keys of one step go into the scan of the next by a checked broadcast, so no fact is
    shuffled to find a few of them; keys beyond the bound are joined by a shuffle.
    """
    into = lambda keys, name: broadcast_if_small(written_table(keys.distinct(), name), KEYS_BROADCAST)
    chosen = into(star.customers.where(F.col("customer_name") == name).select("customer_id"), "chosen")
    orders = into(star.orders.join(chosen, "customer_id", "left_semi").select("order_id"), "orders")
    bought = into(star.lines.join(orders, "order_id", "left_semi").select("product_id"), "bought")
    return star.products.join(bought, "product_id", "left_semi").select("product_name").distinct()


def orders_by_state(star: Star, customers: DataFrame, n: int = 10) -> DataFrame:
    """Orders per state of the known customers, the others under 'Unknown'; the top ``n``."""
    states = customers.select("customer_id", F.col("state").cast("string").alias("state"))
    return (
        _per_customer(star).drop("spend").join(states, "customer_id", "left")
        .groupBy(F.coalesce("state", F.lit("Unknown")).alias("state"))
        .agg(F.sum("orders").alias("orders"))
        .orderBy(F.desc("orders"), "state").limit(n)
    )


def order_report(star: Star) -> DataFrame:
    """Every order with its customer's name under report names."""
    names = star.customers.select("customer_id", "customer_name")
    return star.orders.join(names, "customer_id", "left").select(
        "order_id",
        F.substring(F.col("order_date").cast("string"), 1, 10).alias("date"),
        F.col("customer_name").alias("customer"),
        "amount",
        F.col("status").alias("status_code"),
    )


def latest_orders(star: Star, n: int = 8) -> DataFrame:
    """The newest orders by (date, id)."""
    return star.orders.orderBy(F.desc("order_date"), F.desc("order_id")).limit(n).select(
        "order_id", F.substring(F.col("order_date").cast("string"), 1, 10).alias("date"), "amount"
    )


def recent_orders(star: Star, n: int = 8) -> DataFrame:
    """The latest order lines with customer and product names.

    The top-n comes first and is written, then the dimensions are reduced to its keys: no
    dimension is shuffled for a handful of rows.
    """
    order = [F.desc("line_date"), F.desc("order_id"), F.desc("line_no"), F.desc("product_id"), F.desc("line_amount")]
    top = written_table(star.lines.orderBy(*order).limit(n), "recent")
    # the top-n has at most n rows, which bounds both broadcasts
    orders = star.orders.join(F.broadcast(top.select("order_id").distinct()), "order_id", "left_semi").select("order_id", "customer_id", "status")
    head = written_table(top.join(orders, "order_id", "left"), "recent")
    customers = star.customers.join(F.broadcast(head.select("customer_id").distinct()), "customer_id", "left_semi").select("customer_id", "customer_name")
    products = star.products.join(F.broadcast(top.select("product_id").distinct()), "product_id", "left_semi").select("product_id", "product_name")
    return (
        head.join(customers, "customer_id", "left").join(products, "product_id", "left")
        .select(
            "order_id",
            F.substring(F.col("line_date").cast("string"), 1, 10).alias("date"),
            F.col("customer_name").alias("customer"),
            F.col("product_name").alias("product"),
            F.col("qty").alias("quantity"),
            F.col("line_amount").alias("amount"),
            F.col("status").alias("status_code"),
        )
        .orderBy(F.desc("date"), F.desc("order_id"))
    )


def not_in(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """SQL ``NOT IN``: no rows if the right side holds a NULL, no NULL keys unless it is empty.

    Written as an ordinary anti join plus two facts about the right side, because the built-in
    null-aware anti join has to broadcast the right side whatever its size.
    """
    right_facts = right.agg(
        F.count("*").alias("n"), F.count_if(F.col(right_key).isNull()).alias("nulls")
    )
    no_null = right_facts.select(F.col("nulls") == 0).scalar()
    is_empty = right_facts.select(F.col("n") == 0).scalar()
    keys = right.select(F.col(right_key).alias(left_key)).dropna().distinct()
    return left.where(no_null & (F.col(left_key).isNotNull() | is_empty)).join(keys, left_key, "left_anti")


def customers_without_orders(star: Star, orders: DataFrame) -> DataFrame:
    return not_in(star.customers, "customer_id", orders, "customer_id").select("customer_name")


def ordered_products(star: Star) -> DataFrame:
    """Distinct names of the products that occur in an order line."""
    ordered = star.lines.select("product_id").distinct()
    return star.products.join(ordered, "product_id", "left_semi").select("product_name").distinct()


def identity_lookup(probes: DataFrame, users: DataFrame) -> DataFrame:
    """Match ``probe`` against user name or e-mail without regard to case.

    Two equi-joins in one: the users are listed under either name, which keeps it a hash join
    where an OR condition would compare every pair.
    """
    names = users.select(
        "user_id", F.explode(F.array_distinct(F.array(F.lower("user_name"), F.lower("email")))).alias("__key")
    ).dropna(subset=["__key"])
    return (
        probes.select("probe", F.lower(F.trim("probe")).alias("__key"))
        .join(names, "__key", "left").select("probe", "user_id").distinct()
    )


# ---- totals and dashboard --------------------------------------------------------------------

def total_amount(star: Star) -> DataFrame:
    return star.orders.agg(F.round(F.sum("amount"), 2).alias("total"))


def largest_amount(star: Star) -> DataFrame:
    return star.orders.agg(F.max("amount").alias("largest"))


def spend_of_state(star: Star, state) -> DataFrame:
    chosen = star.customers.where(F.col("state") == F.lit(state)).select("customer_id")
    return (
        _per_customer(star).join(chosen, "customer_id", "left_semi")
        .agg(F.round(F.sum("spend"), 2).alias("total"))
    )


def average_by(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """Average of an amount with two decimals; the sum is rounded so that order does not matter."""
    return df.groupBy(key).agg(F.try_divide(F.round(F.sum(value), 2), F.count(value)).alias(out))


def kpi_row(star: Star, delivered) -> DataFrame:
    """The seven headline figures: one pass over the orders, three row counts."""
    count_of = lambda df: df.agg(F.count("*")).scalar()
    return star.orders.agg(
        F.count("*").alias("orders"),
        F.coalesce(F.round(F.sum("amount"), 2), F.lit(0.0)).alias("revenue"),
        F.coalesce(F.try_divide(F.round(F.sum("amount"), 2), F.count("amount")), F.lit(0.0)).alias("average_order"),
        F.count_if(F.col("status") == F.lit(delivered)).alias("delivered"),
    ).select(
        count_of(star.customers).alias("customers"),
        count_of(star.products).alias("products"),
        "orders",
        count_of(star.employees).alias("employees"),
        "revenue", "average_order", "delivered",
    )


def orders_by_status(star: Star, labels: dict = vocab.STATUS_LABELS) -> DataFrame:
    """Grouped by code; codes that share the label 'Other' stay separate rows."""
    return (
        star.orders.groupBy("status").agg(F.count("*").alias("orders"))
        .orderBy("status")
        .select(label_by_code(F.col("status"), labels).alias("status"), "orders")
    )


def revenue_by_month(star: Star) -> DataFrame:
    return (
        star.orders.groupBy(month_text(F.col("order_date")).alias("month"))
        .agg(F.round(F.sum("amount"), 2).alias("revenue")).orderBy("month")
    )


def _per_product(star: Star) -> DataFrame:
    return star.lines.groupBy("product_id").agg(F.sum("line_amount").alias("revenue"))


def revenue_by_category(star: Star, products: DataFrame | None = None) -> DataFrame:
    """Revenue per category, products without one under 'Uncategorized'."""
    categories = (star.products if products is None else products).select("product_id", "category")
    return (
        _per_product(star).join(categories, "product_id")
        .groupBy(F.coalesce("category", F.lit("Uncategorized")).alias("category"))
        .agg(F.round(F.sum("revenue"), 2).alias("revenue"))
        .orderBy(F.desc("revenue"), "category")
    )


def headcount_by_department(employees: DataFrame, n: int = 10) -> DataFrame:
    return (
        employees.groupBy(F.coalesce(F.col("department").cast("string"), F.lit("Unassigned")).alias("department"))
        .agg(F.count("*").alias("employees"))
        .orderBy(F.desc("employees"), "department").limit(n)
    )


# ---- top-n -----------------------------------------------------------------------------------

def dearest_product(star: Star) -> DataFrame:
    return star.products.orderBy(F.desc("price"), "product_id").limit(1).select("product_name")


def top_customers(star: Star, n: int = 5) -> DataFrame:
    return (
        star.customers.join(_per_customer(star).drop("orders"), "customer_id")
        .select("customer_id", F.col("customer_name").alias("customer"), F.round("spend", 2).alias("spend"))
        .orderBy(F.desc("spend"), "customer_id").limit(n)
        .select("customer", "spend")
    )


def top_products(star: Star, n: int = 10) -> DataFrame:
    return (
        star.products.join(_per_product(star), "product_id")
        .select("product_id", F.col("product_name").alias("product"), F.round("revenue", 2).alias("revenue"))
        .orderBy(F.desc("revenue"), "product_id").limit(n)
        .select("product_id", "product", "revenue")
    )


def biggest_spender(star: Star) -> DataFrame:
    return top_customers(star, 1).select(F.col("customer").alias("customer_name"))


def largest_category(star: Star) -> DataFrame:
    """The category with the most products."""
    return (
        star.products.groupBy("category").agg(F.count("*").alias("products"))
        .orderBy(F.desc("products"), "category").limit(1).select("category")
    )


def best_selling_category(star: Star) -> DataFrame:
    return revenue_by_category(star).limit(1)
