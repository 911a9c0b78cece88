import re

import pytest
from pyspark.sql import functions as F

from quillgrid.functions import generate, text


def column(spark, values):
    return spark.createDataFrame([(v,) for v in values], "s string")


def apply(spark, function, values):
    return [r.out for r in column(spark, values).select(function(F.col("s")).alias("out")).collect()]


def test_tokens(spark):
    found = apply(spark, text.tokenize, ["How many customers have the glass buses?", "Is us his THE", "", "Élan s a2b bus"])
    assert found == [["many", "customer", "glas" + "s", "buse"], ["us", "his"], [], ["lan", "s", "a2b", "bus"]]


def test_token_rows_agree_with_the_array(spark):
    texts = column(spark, ["All orders, boss: 3 products", "who is there", "ss sss ssss bus buses"])
    exploded = [r.term for r in text.token_rows(texts, "s").collect()]
    assert exploded == [t for row in texts.select(text.tokenize(F.col("s")).alias("t")).collect() for t in row.t]


def test_questions_are_normalised(spark):
    values = ["  How MANY, orders?! ", "...", "a-b_c", "STRAßE", "ﬁne ſo", "Élan ŉ", "İd"]
    expected = [" ".join(re.findall("[a-z0-9]+", v.casefold())) for v in values]
    assert apply(spark, text.normalize_question, values) == expected


def test_humanised_names(spark):
    assert apply(spark, text.humanize_name, ["cust_nm", "po_hdr", "xyz", "ord_zz_dt"]) == [
        "customer name", "purchase order header", "xyz", "order zz date",
    ]


@pytest.mark.parametrize("raw, clean", [
    ("```sql\nSELECT 1;\n```", "SELECT 1"),
    ("Here you are: with x as (select 1) select * from x;;", "with x as (select 1) select * from x"),
    ("  DELETE FROM t ; ", "DELETE FROM t"),
    ("selection of SELECT a", "SELECT a"),
    ("", ""),
])
def test_clean_sql(spark, raw, clean):
    assert apply(spark, text.clean_sql_text, [raw]) == [clean]


SAFETY = [  # fixed values: two statements to allow, five to block
    ("SELECT COUNT(*) FROM cust_mst", True),
    ("WITH x AS (\n SELECT cust_id\n FROM cust_mst\n)\nSELECT COUNT(*)\nFROM x", True),
    ("DELETE FROM cust_mst", False),
    ("UPDATE cust_mst\nSET cust_nm = 'HACKED'\nWHERE cust_id = 101", False),
    ("INSERT INTO cust_mst\n(cust_id, cust_nm)\nVALUES (999, 'Bad Row')", False),
    ("DROP TABLE cust_mst", False),
    ("SELECT * FROM cust_mst;\nDELETE FROM cust_mst;", False),
]
MORE = [
    ("SELECT 1;", True),
    ("SELECT 'a; DROP TABLE t' AS x", True),
    ("SELECT 1 -- don't; delete\n", True),
    ("SELECT 1 -- don't\n; DELETE FROM t -- '", False),
    ("SELECT /* ' */ 1; DROP TABLE t /* ' */", False),
    ("WITH x AS (SELECT 1) DELETE FROM t", False),
    ("SELECT replace(a, 'x', 'y'), \"update\" FROM t", True),
    ("SELECT a FROM t UNION SELECT b FROM u", True),
    ("SELECT 'it''s' ; SELECT 2", False),
    ("PRAGMA table_info(t)", False),
    ("EXPLAIN", False),
    ("   ", False),
]


@pytest.mark.parametrize("statement, allowed", SAFETY + MORE)
def test_query_log_safety(spark, statement, allowed):
    assert (apply(spark, text.query_log_verdict, [statement])[0] == "ok") is allowed


def test_long_quoted_text_is_no_problem(spark):
    statement = "SELECT '" + "ab''" * 200_000 + "' AS x"
    assert apply(spark, text.query_log_verdict, [statement, None]) == ["ok", "empty"]


def test_literals(spark):
    rows = spark.createDataFrame([("3", "INTEGER"), ("O'Hara", "TEXT"), ("1.5", "double"), ("x", None)], "v string, t string")
    found = [r.out for r in rows.select(text.sql_literal(F.col("v"), F.col("t")).alias("out")).collect()]
    assert found == ["3", "'O''Hara'", "1.5", "'x'"]


def test_email(spark):
    values = ["a@b.c", "a@b", "a b@c.d", "a@b.c.d", "a@@b.c", "a@b.", "x y@z.w", "a@b.c\n", ""]
    assert apply(spark, text.email_valid, values) == [True, False, False, True, False, False, False, False, False]


def test_value_document(spark):
    rows = spark.createDataFrame([("ord_txn", "stat_cd", "3", ["delivered", "done"]), ("t", "c", "v", [])], "t string, c string, v string, a array<string>")
    found = [r.d for r in rows.select(text.value_document(F.col("t"), F.col("c"), F.col("v"), F.col("a")).alias("d")).collect()]
    assert found == [
        "order transaction status code. Database column ord_txn.stat_cd. Stored database value: 3. Natural language meaning: delivered, done.",
        "t c. Database column t.c. Stored database value: v. Natural language value: v.",
    ]


@pytest.mark.parametrize("name, role", [
    ("st_cd", "state"), ("cust_id", "number"), ("ord_dt", "date"), ("last_run", "date"), ("in_tm", "time"), ("tot_amt", "measure"),
    ("stat_cd", "flag"), ("cust_nm", "name"), ("city_nm", "city"), ("mode_cd", "label"), ("xx_cd", "code"), ("raw_json", "json"),
    ("to_addr", "email"), ("mob_no", "phone"), ("gstin", "tax_number"), ("pin_cd", "post_code"), ("zzz", "text"), ("ts", "text"),
    ("frm_city", "city"), ("hod_emp_id", "number"), ("qty_recv", "measure"), ("cap_units", "measure"),
])
def test_column_roles(spark, name, role):
    assert generate.role_of(name) == role
    assert apply(spark, generate.column_role, [name]) == [role]
