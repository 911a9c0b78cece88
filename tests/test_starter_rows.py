"""The twenty evaluation questions on the starter rows."""

import pytest

from quillgrid.operators import star
from quillgrid.session import constant_frame
from tests.starter import frames


@pytest.fixture(scope="module")
def sales(spark):
    t = frames(spark)
    return star.star_of_single_line_orders(t["cust_mst"], t["prod_mst"], t["ord_txn"], t["emp_rec"])


def values(df, column=0):
    return [row[column] for row in df.collect()]


MEANINGS = [(1, "pending"), (2, "processing"), (3, "delivered"), (3, "completed delivery"), (4, "cancelled")]

ONE_COLUMN = {
    "e01": (lambda s, m: s.customers.agg({"*": "count"}), [7]),
    "e02": (lambda s, m: star.customers_in_state(s, "MH"), ["Rahul Verma", "Amit Shah", "Arjun Deshmukh"]),
    "e03": (lambda s, m: star.orders_in_month(s, "2025-07"), [3]),
    "e04": (lambda s, m: star.dearest_product(s), ["Laptop 14 inch"]),
    "e05": (lambda s, m: star.employees_in_department(s, "SALES"), ["Meera Joshi", "Anita Rao"]),
    "e06": (lambda s, m: star.products_above_price(s, 10000), [2]),
    "e07": (lambda s, m: star.customers_in_state(s, "KA"), ["Priya Nair", "Kavya Reddy"]),
    "m01": (lambda s, m: star.total_amount(s), [314292.0]),
    "m05": (lambda s, m: star.ordered_products(s), ["Laptop 14 inch", "Wireless Mouse", "Office Chair", "LED Monitor 24", "Mechanical Keyboard"]),
    "m06": (lambda s, m: star.count_by_meaning(s, m, "Delivered"), [5]),
    "m07": (lambda s, m: star.largest_amount(s), [124000.0]),
    "h01": (lambda s, m: star.biggest_spender(s), ["Arjun Deshmukh"]),
    "h02": (lambda s, m: star.products_of_customer(s, "Rahul Verma"), ["Laptop 14 inch", "LED Monitor 24", "Office Chair"]),
    "h03": (lambda s, m: star.spend_of_state(s, "MH"), [231397.0]),
    "h04": (lambda s, m: star.largest_category(s), ["ACCS"]),
    "h05": (lambda s, m: star.customers_without_orders(s, s.orders), []),
    "h06": (lambda s, m: star.orders_with_status_above(s, 1, 8000), [5005, 5010]),
}


@pytest.mark.parametrize("question", sorted(ONE_COLUMN))
def test_one_column_answers(spark, sales, question):
    build, expected = ONE_COLUMN[question]
    meanings = constant_frame(spark, MEANINGS, "status int, meaning string")
    assert sorted(values(build(sales, meanings))) == sorted(expected)


def test_m02_spend_by_customer(sales):
    assert [(r.customer_name, r.total) for r in star.spend_by_customer(sales).collect()] == [
        ("Arjun Deshmukh", 124000.0), ("Rahul Verma", 93500.0), ("Sneha Iyer", 62000.0), ("Amit Shah", 13897.0),
        ("Priya Nair", 8500.0), ("Vikram Singh", 8400.0), ("Kavya Reddy", 3995.0),
    ]


def test_m03_orders_by_customer(sales):
    counts = {r.customer_name: r.orders for r in star.orders_by_customer(sales).collect()}
    assert counts.pop("Rahul Verma") == 3 and counts.pop("Amit Shah") == 2 and set(counts.values()) == {1}


def test_m04_average_salary(sales):
    rows = star.average_by(sales.employees, "department", "salary", "average").collect()
    assert {r.department: r.average for r in rows} == {"SALES": 88500.0, "TECH": 120000.0, "OPS": 67000.0}


def test_dashboard(sales):
    kpi = star.kpi_row(sales, 3).first().asDict()
    assert kpi == {
        "customers": 7, "products": 5, "orders": 10, "employees": 4, "revenue": 314292.0, "average_order": 31429.2, "delivered": 5,
    }
    assert [tuple(r) for r in star.orders_by_status(sales).collect()] == [("Pending", 2), ("Processing", 2), ("Delivered", 5), ("Cancelled", 1)]
    assert [tuple(r) for r in star.revenue_by_month(sales).collect()][-1] == ("2025-07", 136495.0)
    recent = star.recent_orders(sales, 2).collect()
    assert [(r.order_id, r.customer, r.product, r.quantity) for r in recent] == [
        (5010, "Rahul Verma", "Office Chair", 1), (5009, "Kavya Reddy", "Wireless Mouse", 5),
    ]


def test_dashboard_of_empty_tables(spark, sales):
    nothing = star.Star(**{name: getattr(sales, name).limit(0) for name in sales.__dataclass_fields__})
    kpi = star.kpi_row(nothing, 3).first().asDict()
    assert kpi["orders"] == 0 and kpi["revenue"] == 0.0 and kpi["average_order"] == 0.0 and kpi["delivered"] == 0
    assert star.total_amount(nothing).first()[0] is None
    assert star.recent_orders(nothing).count() == 0
