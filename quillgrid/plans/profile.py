"""Catalog profiling and text functions on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates, generate, text, vocab
from ..operators import catalog, ordering, sets
from ..session import new_path
from ..sources.tables import PRIMARY_KEYS, TABLES, Tables
from .registry import query
from .sqltext import folded_words, humanize, tokens

# Meanings of the codes in the given tables.
ALIASES = {
    ("orders", "o_orderstatus", "F"): ["fulfilled", "fulfilled order"],
    ("orders", "o_orderstatus", "O"): ["open", "open order"],
    ("orders", "o_orderstatus", "P"): ["pending", "in progress"],
    ("lineitem", "l_returnflag", "R"): ["returned"],
    ("lineitem", "l_returnflag", "A"): ["accepted"],
    ("customer", "c_mktsegment", "BUILDING"): ["construction", "building trade"],
    ("labels", "quality", "0"): ["low quality"],
    ("labels", "quality", "1"): ["high quality"],
    ("labels", "toxic", "1"): ["toxic"],
}
# Columns that the naming rules leave for the value index.
VALUE_COLUMNS = {
    "region": ["r_name"], "nation": ["n_name"], "customer": ["c_name", "c_mktsegment"], "supplier": ["s_name"],
    "part": ["p_name", "p_brand", "p_type"], "orders": ["o_orderstatus", "o_orderpriority"],
    "lineitem": ["l_returnflag", "l_linestatus"], "events": ["event_type", "props"],
    "documents": ["text", "lang", "source"], "pages": ["url", "html"], "benchmark": ["text"],
    "labels": ["quality", "toxic"], "conversations": ["role", "text"],
}
COLUMN_COUNTS = {
    "region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6, "lineitem": 11, "events": 6,
    "documents": 5, "embeddings": 3, "pages": 3, "benchmark": 2, "labels": 3, "conversations": 4,
}
TARGETS = {"customer": 5000, "part": 3000, "orders": 12000, "supplier": 1500, "region": 5, "nation": 25}
DEFAULT_TARGET = 5000
LIMIT = vocab.VALUE_CARDINALITY_LIMIT

INVENTORY_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", count(*) AS rows, CAST({COLUMN_COUNTS[t]} AS BIGINT) AS columns, "
    f"'{', '.join(PRIMARY_KEYS.get(t, [])) or 'rowid'}' AS primary_key FROM {t}"
    for t in TABLES
)
TARGET_CASE = "CASE \"table\" " + " ".join(f"WHEN '{t}' THEN {n}" for t, n in TARGETS.items()) + f" ELSE {DEFAULT_TARGET} END"


@query("table_inventory", INVENTORY_SQL)
def table_inventory(t: Tables) -> DataFrame:
    return catalog.table_inventory(t.spark, t.all, PRIMARY_KEYS)


@query("total_records", f"SELECT count(*) AS tables, CAST(sum(rows) AS BIGINT) AS records FROM ({INVENTORY_SQL})")
def total_records(t: Tables) -> DataFrame:
    return catalog.total_records(t.all)


@query("row_target_check", f"""
WITH i AS (SELECT *, rows < {TARGET_CASE} AS under FROM ({INVENTORY_SQL}))
SELECT min(rows) AS smallest, max(rows) AS largest, CAST(sum(rows) AS BIGINT) AS total, count(*) FILTER (WHERE under) AS under_target,
       coalesce(string_agg("table", ',' ORDER BY "table") FILTER (WHERE under), '') AS tables_under_target FROM i""")
def row_target_check(t: Tables) -> DataFrame:
    return catalog.row_target_check(table_inventory(t), TARGETS, DEFAULT_TARGET)


@query("count_distinct_nonnull", " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", count(DISTINCT {c}) AS distinct_values FROM {t}"
    for t, cs in VALUE_COLUMNS.items() for c in cs))
def count_distinct_nonnull(t: Tables) -> DataFrame:
    return sets.union_by_name([
        catalog.distinct_counts(getattr(t, name), columns).select(F.lit(name).alias("table"), "column", "distinct_values")
        for name, columns in VALUE_COLUMNS.items()
    ])


VALUES_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, "
    f"'{'INTEGER' if t == 'labels' else 'TEXT'}' AS value_type FROM {t} WHERE {c} IS NOT NULL "
    f"AND (SELECT count(DISTINCT {c}) FROM {t}) <= {LIMIT} GROUP BY {c}"
    for t, cs in VALUE_COLUMNS.items() for c in cs
)
ALIAS_ROWS = ", ".join(f"('{t}', '{c}', '{v}', {a!r})" for (t, c, v), a in ALIASES.items())
EXTRACT_SQL = f"""
SELECT v."table", v."column", v.value, v.value_type, coalesce(a.aliases, []) AS aliases
FROM ({VALUES_SQL}) v LEFT JOIN (VALUES {ALIAS_ROWS}) a(t, c, x, aliases) ON t = v."table" AND c = v."column" AND x = v.value"""


def extracted(t: Tables) -> DataFrame:
    return catalog.extract_values(t.spark, t.all, ALIASES, LIMIT)


@query("value_extract", f"""
SELECT "table", "column", value, value_type, array_to_string(aliases, ' | ') AS aliases FROM ({EXTRACT_SQL})""")
def value_extract(t: Tables) -> DataFrame:
    return extracted(t).withColumn("aliases", F.array_join("aliases", " | "))


@query("value_document", f"""
SELECT "table", "column", value, value_type, array_to_string(aliases, ' | ') AS aliases,
  {humanize('"table"')} || ' ' || {humanize('"column"')} || '. Database column ' || "table" || '.' || "column"
  || '. Stored database value: ' || value || '. ' || CASE WHEN len(aliases) > 0
     THEN 'Natural language meaning: ' || array_to_string(aliases, ', ') || '.'
     ELSE 'Natural language value: ' || value || '.' END AS document
FROM ({EXTRACT_SQL})""")
def value_document(t: Tables) -> DataFrame:
    return catalog.value_documents(extracted(t))


@query("index_table_write", f"""
SELECT 'value_' || (row_number() OVER (ORDER BY "table", "column", value) - 1) AS id, "table", "column", value, value_type,
  array_to_string(aliases, ' | ') AS aliases FROM ({EXTRACT_SQL})""")
def index_table_write(t: Tables) -> DataFrame:
    """The value index as written and read back."""
    _, value_index = catalog.build_index(t.spark, t.all, PRIMARY_KEYS, new_path(t.spark, "index"), ALIASES, LIMIT)
    return value_index.drop("document")


@query("alias_lookup", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag AS value, coalesce(array_to_string(a.aliases, ' | '), '') AS aliases
FROM lineitem LEFT JOIN (VALUES {ALIAS_ROWS}) a(t, c, x, aliases) ON t = 'lineitem' AND c = 'l_returnflag' AND x = l_returnflag""")
def alias_lookup(t: Tables) -> DataFrame:
    rows = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.lit("lineitem").alias("table"), F.lit("l_returnflag").alias("column"),
        F.col("l_returnflag").alias("value"),
    )
    return catalog.with_aliases(rows, ALIASES).select(
        "l_orderkey", "l_linenumber", "l_partkey", "value", F.array_join("aliases", " | ").alias("aliases")
    )


@query("union_all_tables", " UNION ALL ".join([
    "SELECT 'customer' AS \"table\", c_name AS name, c_nationkey AS nation, c_acctbal AS balance FROM customer",
    "SELECT 'supplier', s_name, s_nationkey, s_acctbal FROM supplier"]))
def union_all_tables(t: Tables) -> DataFrame:
    return sets.union_by_name([
        t.customer.select(F.lit("customer").alias("table"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance")),
        t.supplier.select(F.lit("supplier").alias("table"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance")),
    ])


@query("describe_table", " UNION ALL ".join(
    f"""SELECT '{t}' AS "table", {humanize(f"'{t}'")} || '. ' || {humanize(f"'{t}'")} || ' table. Stores ' || {humanize(f"'{t}'")}
    || ' records. Columns: ' || (SELECT string_agg({humanize('column_name')}, ', ' ORDER BY column_index) FROM duckdb_columns() WHERE table_name = '{t}')
    || '.' || CASE WHEN count(*) = 0 THEN ' (currently empty, no data).' ELSE ' (' || count(*) || ' rows of data).' END AS description,
    count(*) = 0 AS empty FROM {t}""" for t in TABLES))
def describe_table(t: Tables) -> DataFrame:
    columns = catalog.catalog_columns(t.spark, t.all, PRIMARY_KEYS)
    return catalog.describe_tables(columns, catalog.table_inventory(t.spark, t.all, PRIMARY_KEYS))


# ---- text ------------------------------------------------------------------------------------

@query("tokenize", f"""
SELECT doc_id, CAST(len(toks) AS INTEGER) AS n_tokens, array_to_string(toks, ' ') AS tokens
FROM (SELECT doc_id, {tokens('text')} AS toks FROM documents)""")
def tokenize(t: Tables) -> DataFrame:
    toks = t.documents.select("doc_id", text.tokenize(F.col("text")).alias("toks"))
    return toks.select("doc_id", F.size("toks").alias("n_tokens"), F.array_join("toks", " ").alias("tokens"))


@query("normalize_question", f"""
SELECT conv_id, turn, array_to_string({folded_words('text')}, ' ') AS question FROM conversations""")
def normalize_question(t: Tables) -> DataFrame:
    return t.conversations.select("conv_id", "turn", text.normalize_question(F.col("text")).alias("question"))


SPACE = r"[\s\p{Z}\x{85}]"
BARE = rf"regexp_replace(regexp_replace(text, '```(?:sql)?', '', 'g'), '\A{SPACE}+|{SPACE}+\z', '', 'g')"
NOT_WORD = r"[^\p{L}\p{N}\p{M}_]"
FROM_KEYWORD = rf"regexp_extract(bare, '(?is)(?:\A|{NOT_WORD})((?:select|with)(?:{NOT_WORD}.*)?)\z', 1)"


@query("clean_sql_text", rf"""
WITH b AS (SELECT conv_id, turn, {BARE} AS bare FROM conversations),
s AS (SELECT conv_id, turn, CASE WHEN {FROM_KEYWORD} = '' THEN bare ELSE {FROM_KEYWORD} END AS body FROM b)
SELECT conv_id, turn, regexp_replace(regexp_replace(body, ';+\z', ''), '\A{SPACE}+|{SPACE}+\z', '', 'g') AS sql_text FROM s""")
def clean_sql_text(t: Tables) -> DataFrame:
    return t.conversations.select("conv_id", "turn", text.clean_sql_text(F.col("text")).alias("sql_text"))


def statement_log(t: Tables) -> DataFrame:
    """A log with one statement per event, of a shape that depends on the event type."""
    number = F.col("event_id").cast("string")
    shape = lambda before, after="": F.concat(F.lit(before), number, F.lit(after))
    kind = F.col("event_type")
    return t.events.select(
        "event_id",
        F.when(kind == "view", shape("SELECT * FROM events WHERE event_id = "))
        .when(kind == "click", shape("WITH x AS (SELECT 'it''s; drop table' AS note) SELECT count(*) FROM x -- don't delete ", "\n;"))
        .when(kind == "purchase", shape("INSERT INTO events (event_id) VALUES (", ")"))
        .when(kind == "error", shape("WITH x AS (SELECT 1) DELETE FROM events WHERE event_id = "))
        .otherwise(shape("SELECT 1 /* ", " */; DROP TABLE events")).alias("statement"),
    )


STATEMENTS_SQL = """
SELECT event_id, CASE event_type
  WHEN 'view' THEN 'SELECT * FROM events WHERE event_id = ' || event_id
  WHEN 'click' THEN 'WITH x AS (SELECT ''it''''s; drop table'' AS note) SELECT count(*) FROM x -- don''t delete ' || event_id || chr(10) || ';'
  WHEN 'purchase' THEN 'INSERT INTO events (event_id) VALUES (' || event_id || ')'
  WHEN 'error' THEN 'WITH x AS (SELECT 1) DELETE FROM events WHERE event_id = ' || event_id
  ELSE 'SELECT 1 /* ' || event_id || ' */; DROP TABLE events' END AS statement FROM events"""
WRITES = "|".join(text.WRITE_KEYWORDS)


@query("query_log_safety", rf"""
WITH log AS ({STATEMENTS_SQL}),
blank AS (SELECT event_id, regexp_replace(statement, '''[^'']*(?:''''[^'']*)*''|"[^"]*"|--[^\n]*|/\*(?s:.*?)\*/', ' ? ', 'g') AS s FROM log),
trimmed AS (SELECT event_id, lower(regexp_replace(s, '\A[\s;]+|[\s;]+\z', '', 'g')) AS s FROM blank)
SELECT event_id, CASE WHEN s = '' THEN 'empty' WHEN contains(s, ';') THEN 'multiple statements'
  WHEN regexp_matches(s, '(?:\A|[;)(])\s*(?:{WRITES})\b\s*(?:[^(\s]|\z)') THEN 'write statement'
  WHEN NOT regexp_matches(s, '\bselect\b') THEN 'no select' ELSE 'ok' END AS verdict FROM trimmed""")
def query_log_safety(t: Tables) -> DataFrame:
    return statement_log(t).select("event_id", text.query_log_verdict(F.col("statement")).alias("verdict"))


@query("prompt_token_estimate", """
SELECT source, count(*) AS texts, CAST(sum(length(text) // 4) AS BIGINT) AS full_tokens,
       CAST(coalesce(sum(length(text) // 4) FILTER (WHERE quality = 1), 0) AS BIGINT) AS retrieved_tokens
FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source""")
def prompt_token_estimate(t: Tables) -> DataFrame:
    sized = t.documents.select("doc_id", "source", text.token_estimate(F.col("text")).alias("tokens"))
    labelled = sized.join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    return labelled.groupBy("source").agg(
        F.count("*").alias("texts"), F.sum("tokens").alias("full_tokens"),
        F.coalesce(F.sum(F.when(F.col("quality") == 1, F.col("tokens"))), F.lit(0)).alias("retrieved_tokens"),
    )


@query("cache_key", """
SELECT md5('model-a::' || text) AS cache_key, count(*) AS prompts, min(conv_id) AS first_conversation FROM conversations GROUP BY 1""")
def cache_key(t: Tables) -> DataFrame:
    return t.conversations.groupBy(text.cache_key(F.lit("model-a"), F.col("text")).alias("cache_key")).agg(
        F.count("*").alias("prompts"), F.min("conv_id").alias("first_conversation")
    )


PART = r"[^@\s\p{Z}\x{85}]+"


@query("email_valid", rf"""
SELECT word, count(*) AS occurrences FROM (SELECT unnest(regexp_split_to_array(text, '[\s\p{{Z}}\x{{85}}]+')) AS word FROM documents)
WHERE regexp_full_match(word, '{PART}@{PART}\.{PART}') GROUP BY word""")
def email_valid(t: Tables) -> DataFrame:
    word = F.explode(F.split("text", r"(?U)\s+")).alias("word")
    return t.documents.select(word).where(text.email_valid(F.col("word"))).groupBy("word").agg(F.count("*").alias("occurrences"))


@query("json_tag", """
SELECT o_orderkey, CAST(to_json({'source': o_orderpriority, 'table': 'orders', 'row': o_orderkey}) AS VARCHAR) AS raw_json FROM orders""")
def json_tag(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey", text.json_tag(F.col("o_orderpriority"), F.lit("orders"), F.col("o_orderkey")).alias("raw_json")
    )


AS_OF = "2024-01-15 00:00:00"


@query("expired_flag", f"SELECT event_id, TIMESTAMP '{AS_OF}' > ts + INTERVAL 5 MINUTE AS expired FROM events")
def expired_flag(t: Tables) -> DataFrame:
    as_of = F.lit(AS_OF).cast(t.events.schema["ts"].dataType)
    return t.events.select("event_id", dates.is_expired(F.col("ts"), as_of).alias("expired"))


END_DATE = "2025-12-31"


@query("spread_date", f"""
WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS i, count(*) OVER () AS n FROM orders)
SELECT o_orderkey, strftime(DATE '2020-01-01' + CAST(round_even(CAST((i + 17) % n AS DOUBLE)
  * date_diff('day', DATE '2020-01-01', DATE '{END_DATE}') / greatest(n - 1, 1), 0) AS INTEGER), '%Y-%m-%d') AS spread FROM r""")
def spread_date(t: Tables) -> DataFrame:
    numbered = ordering.enumerate_rows(t.orders.select("o_orderkey"), "o_orderkey")
    total = numbered.agg(F.count("*")).scalar()
    return numbered.select("o_orderkey", dates.spread_date(F.col("row_index"), total, END_DATE, offset=17).cast("string").alias("spread"))


@query("format_codes", """
SELECT o_orderkey, printf('%02d:%02d:00', 8 + o_orderkey % 10, (o_orderkey * 7) % 60) AS time_text,
  '9' || (o_orderkey % 10) || printf('%08d', (o_orderkey * 7919) % 100000000) AS phone,
  'contact' || (o_orderkey + 1) || '@example.test' AS email, printf('27DEMO%09dZ1', o_orderkey + 1) AS tax_number,
  CAST(100000 + o_orderkey % 899999 AS VARCHAR) AS post_code FROM orders""")
def format_codes(t: Tables) -> DataFrame:
    i = F.col("o_orderkey")
    return t.orders.select(
        "o_orderkey", generate.time_text(i).alias("time_text"), generate.phone(i).alias("phone"),
        generate.email(i).alias("email"), generate.tax_number(i).alias("tax_number"), generate.post_code(i).alias("post_code"),
    )
