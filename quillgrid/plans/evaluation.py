"""Result comparison, accuracy, ablation and run logs on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vocab
from ..functions.text import token_estimate
from ..operators import delta, evaluate, sets
from ..session import new_path, written_table
from ..sources.tables import Tables, read_run_log, refresh_answers, write_run_log
from .registry import query

# ---- bags and cells: the orders of every customer against those above an amount ----------------


def compared(t: Tables) -> tuple[DataFrame, DataFrame]:
    rows = lambda orders: evaluate.result_rows(
        orders.select("o_custkey", "o_orderstatus", "o_orderpriority"), "o_custkey"
    )
    return rows(t.orders), rows(t.orders.where("o_totalprice > 25000"))


PAIR_SQL = """
g AS (SELECT o_custkey AS question_id, o_orderstatus AS s, o_orderpriority AS p, 1 AS side FROM orders
      UNION ALL SELECT o_custkey, o_orderstatus, o_orderpriority, -1 FROM orders WHERE o_totalprice > 25000)"""


@query("bag_equal", f"""
WITH {PAIR_SQL}, d AS (SELECT question_id, s, p, sum(side) AS surplus FROM g GROUP BY ALL)
SELECT question_id, CAST(coalesce(sum(surplus) FILTER (WHERE surplus > 0), 0) AS BIGINT) AS missing_rows,
       CAST(coalesce(-sum(surplus) FILTER (WHERE surplus < 0), 0) AS BIGINT) AS extra_rows, bool_and(surplus = 0) AS equal
FROM d GROUP BY question_id""")
def bag_equal(t: Tables) -> DataFrame:
    gold, predicted = compared(t)
    return evaluate.bag_equal(gold, predicted)


@query("cells_subset", f"""
WITH {PAIR_SQL}, c AS (SELECT question_id, side, s AS cell FROM g UNION SELECT question_id, side, p FROM g),
m AS (SELECT question_id, cell, max(side) AS high, min(side) AS low FROM c GROUP BY ALL)
SELECT question_id, count(*) FILTER (WHERE high = 1) AS gold_cells, count(*) FILTER (WHERE low = -1) AS predicted_cells,
       count(*) FILTER (WHERE low = 1) AS missing_cells FROM m GROUP BY question_id""")
def cells_subset(t: Tables) -> DataFrame:
    return evaluate.cell_facts(*compared(t))


# The prediction's rows, as the branches of the match see them: equal, with a further column,
# with a row missing, and with unrelated cells beyond the harmless number.
MATCH_CASES = ("same", "wider", "shorter", "different", "padded")


@query("result_match", f"""
WITH g AS (SELECT c_custkey AS k, c_name AS a, count(*) AS n FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_name),
gold AS (SELECT [a, n::VARCHAR] AS cells FROM g),
pred AS (SELECT 'same' AS kind, cells FROM gold
  UNION ALL SELECT 'wider', [k::VARCHAR, a, n::VARCHAR] FROM g
  UNION ALL SELECT 'shorter', [a, n::VARCHAR] FROM g WHERE k <> (SELECT min(k) FROM g)
  UNION ALL SELECT 'different', [a, (n + 1)::VARCHAR] FROM g
  UNION ALL SELECT 'padded', [a, n::VARCHAR] FROM g UNION ALL SELECT 'padded', ['row', k::VARCHAR || 'x'] FROM g),
kinds AS (SELECT DISTINCT kind FROM pred),
gc AS (SELECT DISTINCT unnest(cells) AS cell FROM gold), pc AS (SELECT DISTINCT kind, unnest(cells) AS cell FROM pred),
f AS (SELECT kind,
  (SELECT list_sort(list(array_to_string(cells, chr(1)))) FROM gold) = (SELECT list_sort(list(array_to_string(cells, chr(1)))) FROM pred p WHERE p.kind = kinds.kind) AS equal,
  (SELECT count(*) FROM gc WHERE cell NOT IN (SELECT cell FROM pc WHERE pc.kind = kinds.kind)) AS missing,
  (SELECT count(*) FROM gold) = (SELECT count(*) FROM pred p WHERE p.kind = kinds.kind) AS as_many,
  (SELECT count(*) FROM pc WHERE pc.kind = kinds.kind) - (SELECT count(*) FROM gc) AS extra FROM kinds)
SELECT kind, CASE WHEN equal THEN true WHEN (SELECT count(*) FROM gc) = 0 THEN false WHEN missing > 0 THEN false
  ELSE as_many OR extra <= {vocab.HARMLESS_EXTRA_CELLS} END AS correct FROM f""")
def result_match(t: Tables) -> DataFrame:
    """Orders per customer against five predictions, of which some must be wrong."""
    counted = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    named = written_table(t.customer.select("c_custkey", "c_name").join(counted, "c_custkey"), "counted")
    gold = named.select("c_name", "n")
    first = named.agg(F.min("c_custkey")).scalar()
    extra = named.select(F.lit("row").alias("c_name"), F.concat(F.col("c_custkey").cast("string"), F.lit("x")).alias("n"))
    predictions = {
        "same": gold,
        "wider": named.select("c_custkey", "c_name", "n"),
        "shorter": named.where(F.col("c_custkey") != first).select("c_name", "n"),
        "different": named.select("c_name", (F.col("n") + 1).alias("n")),
        "padded": gold.withColumn("n", F.col("n").cast("string")).unionByName(extra),
    }
    results = [evaluate.result_match(gold, predictions[kind]).select(F.lit(kind).alias("kind"), "correct") for kind in MATCH_CASES]
    return sets.union_by_name(results)


# ---- a batch of questions: order totals per nation, with predictions of six kinds ----------------

VARIANTS = 6


def nation_answers(t: Tables) -> DataFrame:
    per_customer = t.orders.groupBy(F.col("o_custkey").alias("c_custkey"), "o_orderstatus").agg(
        F.count("*").alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total")
    )
    return (
        per_customer.join(t.customer.select("c_custkey", F.col("c_nationkey").alias("question_id")), "c_custkey")
        .groupBy("question_id", "o_orderstatus").agg(F.sum("n").alias("n"), F.sum("total").cast("decimal(18,2)").alias("total"))
    )


def batch_sides(t: Tables, shift: int = 0) -> tuple[DataFrame, DataFrame]:
    """Gold rows, and predicted rows that differ in a way that depends on the nation:
    the same, a further column, a row dropped, a total changed, copies of a row, unrelated rows."""
    answers = written_table(nation_answers(t), "answers")  # read once per kind of change
    gold = evaluate.result_rows(answers)
    kind = F.pmod(F.col("question_id") + shift, F.lit(VARIANTS))
    total = F.when(kind == 3, F.col("total") + 1).otherwise(F.col("total")).cast("decimal(18,2)")
    changed = answers.where((kind != 2) | (F.col("o_orderstatus") != "P")).withColumn("total", total)
    plain = evaluate.result_rows(changed.where(kind != 1))
    wider = evaluate.result_rows(changed.where(kind == 1).withColumn("note", F.lit("extra")))
    copied = changed.where((kind == 4) & (F.col("o_orderstatus") == "F"))
    unrelated = changed.where((kind == 5) & (F.col("o_orderstatus") == "F")).select(
        "question_id", F.explode(F.sequence(F.lit(1), F.lit(14))).alias("number")
    ).select("question_id", F.concat(F.lit("x"), F.col("number").cast("string")).alias("text"))
    return gold, sets.union_by_name([plain, wider, evaluate.result_rows(copied), evaluate.result_rows(unrelated)])


def batch_results(t: Tables, shift: int = 0) -> DataFrame:
    questions = t.nation.select(F.col("n_nationkey").alias("question_id"), "n_regionkey")
    levels = questions.join(t.region.select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("level")), "n_regionkey")
    matched = evaluate.batch_result_match(questions, *batch_sides(t, shift))
    return matched.join(levels.select("question_id", "level"), "question_id")


def batch_sql(shift: int = 0, name: str = "results") -> str:
    """CTE ``name``(question_id, level, correct): the outcome by comparing rows and cells directly."""
    return f"""
answers AS (SELECT c_nationkey AS q, o_orderstatus AS s, CAST(count(*) AS VARCHAR) AS n, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total
            FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY ALL),
kinds AS (SELECT *, (q + {shift}) % {VARIANTS} AS kind FROM answers),
{name}_pred AS (
  SELECT q, [s, n, CAST(CASE WHEN kind = 3 THEN total + 1 ELSE total END AS VARCHAR)] || CASE WHEN kind = 1 THEN ['extra'] ELSE [] END AS cells
  FROM kinds WHERE kind <> 2 OR s <> 'P'
  UNION ALL SELECT q, [s, n, CAST(total AS VARCHAR)] FROM kinds WHERE kind = 4 AND s = 'F'
  UNION ALL SELECT q, ['x' || i] FROM kinds, range(1, 15) r(i) WHERE kind = 5 AND s = 'F'),
{name}_gold AS (SELECT q, [s, n, CAST(total AS VARCHAR)] AS cells FROM kinds),
{name} AS (SELECT n_nationkey AS question_id, r_name AS level, CASE
    WHEN (SELECT list_sort(list(array_to_string(cells, ','))) FROM {name}_gold WHERE q = n_nationkey)
         IS NOT DISTINCT FROM (SELECT list_sort(list(array_to_string(cells, ','))) FROM {name}_pred WHERE q = n_nationkey) THEN true
    WHEN (SELECT count(*) FROM {name}_gold WHERE q = n_nationkey) = 0 THEN (SELECT count(*) FROM {name}_pred WHERE q = n_nationkey) = 0
    WHEN NOT list_has_all((SELECT coalesce(flatten(list(cells)), []) FROM {name}_pred WHERE q = n_nationkey),
                          (SELECT flatten(list(cells)) FROM {name}_gold WHERE q = n_nationkey)) THEN false
    ELSE (SELECT count(*) FROM {name}_gold WHERE q = n_nationkey) = (SELECT count(*) FROM {name}_pred WHERE q = n_nationkey)
      OR (SELECT len(list_distinct(flatten(list(cells)))) FROM {name}_pred WHERE q = n_nationkey)
         <= (SELECT len(list_distinct(flatten(list(cells)))) FROM {name}_gold WHERE q = n_nationkey) + {vocab.HARMLESS_EXTRA_CELLS} END AS correct
  FROM nation JOIN region ON r_regionkey = n_regionkey)"""


@query("batch_result_match", f"WITH {batch_sql()} SELECT question_id, level, correct FROM results")
def batch_result_match(t: Tables) -> DataFrame:
    return batch_results(t)


@query("accuracy_rollup", f"""
WITH {batch_sql()}
SELECT CASE WHEN grouping(level) = 1 THEN 'OVERALL' ELSE level END AS level, count(*) FILTER (WHERE correct) AS correct, count(*) AS total,
       round(100 * count(*) FILTER (WHERE correct) / count(*), 1) AS percent
FROM results GROUP BY ROLLUP (level)""")
def accuracy_rollup(t: Tables) -> DataFrame:
    return evaluate.accuracy_rollup(batch_results(t))


# ---- run logs: one entry per event -----------------------------------------------------------


def event_log(t: Tables, limit: float = 50.0) -> DataFrame:
    number = F.col("event_id").cast("string")
    sql = F.concat(F.lit("SELECT value,\n 'a \"quoted\" text' FROM events WHERE event_id = "), number)
    message = F.concat(F.lit("event "), number, F.lit(" failed: "), F.repeat(F.col("props"), 20))
    return t.events.select(
        number.alias("id"), F.col("event_type").alias("level"),
        (F.col("value") < limit).cast("int").alias("correct"),
        F.col("props").alias("question"), sql.alias("generated_sql"), sql.alias("gold_sql"),
        F.when(F.col("event_type") == "error", F.substring(message, 1, vocab.ERROR_TEXT_LENGTH)).alias("error"),
        token_estimate(sql).alias("tokens"), F.floor("value").cast("long").alias("ms"),
    )


LOG_SQL = """
SELECT CAST(event_id AS VARCHAR) AS id, event_type AS level, CAST(value < 50 AS INTEGER) AS correct, props AS question,
  'SELECT value,' || chr(10) || ' ''a "quoted" text'' FROM events WHERE event_id = ' || event_id AS generated_sql,
  'SELECT value,' || chr(10) || ' ''a "quoted" text'' FROM events WHERE event_id = ' || event_id AS gold_sql,
  CASE WHEN event_type = 'error' THEN left('event ' || event_id || ' failed: ' || repeat(props, 20), 120) END AS error,
  CAST(length('SELECT value,' || chr(10) || ' ''a "quoted" text'' FROM events WHERE event_id = ' || event_id) // 4 AS BIGINT) AS tokens,
  CAST(floor(value) AS BIGINT) AS ms FROM events"""


@query("eval_log_write", LOG_SQL)
def eval_log_write(t: Tables) -> DataFrame:
    path = new_path(t.spark, "runlog")
    write_run_log(event_log(t), path)
    return read_run_log(t.spark, path)


@query("run_log_stats", f"""
SELECT level, count(*) AS questions, count(*) FILTER (WHERE correct = 1) AS correct, count(*) FILTER (WHERE coalesce(error, '') <> '') AS errors,
       CAST(sum(tokens) AS DOUBLE) / count(tokens) AS mean_tokens, CAST(sum(ms) AS DOUBLE) / count(ms) AS mean_ms, max(ms) AS max_ms,
       quantile_cont(ms, 0.5) AS p50_ms, quantile_cont(ms, 0.9) AS p90_ms, quantile_cont(ms, 0.95) AS p95_ms
FROM ({LOG_SQL}) GROUP BY level""")
def run_log_stats(t: Tables) -> DataFrame:
    return evaluate.run_log_stats(event_log(t))


def compared_logs(t: Tables) -> DataFrame:
    """A run that skipped the sign-ups, and a later one that skipped the clicks."""
    run = lambda limit, skipped: event_log(t, limit).where(F.col("level") != skipped).select(
        "id", "level", (F.col("correct") == 1).alias("correct")
    )
    return evaluate.ablation_compare(run(50.0, "signup"), run(60.0, "click"))


ABLATION_SQL = """
b AS (SELECT event_id, event_type, value < 50 AS before FROM events WHERE event_type <> 'signup'),
a AS (SELECT event_id, event_type, value < 60 AS after FROM events WHERE event_type <> 'click'),
c AS (SELECT CAST(event_id AS VARCHAR) AS id, coalesce(b.event_type, a.event_type) AS level, before, after, CASE
  WHEN before IS NULL THEN 'added' WHEN after IS NULL THEN 'removed' WHEN NOT before AND after THEN 'fixed'
  WHEN before AND NOT after THEN 'broken' ELSE 'same' END AS change FROM b FULL OUTER JOIN a USING (event_id))"""


@query("ablation_compare", f"WITH {ABLATION_SQL} SELECT id, level, before, after, change FROM c")
def ablation_compare(t: Tables) -> DataFrame:
    return compared_logs(t)


@query("ablation_summary", f"""
WITH {ABLATION_SQL}, s AS (SELECT level, count(*) AS questions, 100 * count(*) FILTER (WHERE before) / nullif(count(before), 0) AS before,
  100 * count(*) FILTER (WHERE after) / nullif(count(after), 0) AS after,
  count(*) FILTER (WHERE change = 'fixed') AS fixed, count(*) FILTER (WHERE change = 'broken') AS broken FROM c GROUP BY level)
SELECT level, questions, round(before, 1) AS before, round(after, 1) AS after, round(after - before, 1) AS delta, fixed, broken FROM s""")
def ablation_summary(t: Tables) -> DataFrame:
    return evaluate.ablation_summary(compared_logs(t))


# ---- saved answers ---------------------------------------------------------------------------

SAVED = [
    ("Spend of every customer",
     "SELECT c_name, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total FROM {customer} "
     "JOIN {orders} ON c_custkey = o_custkey GROUP BY c_custkey, c_name"),
    ("Orders of July 1996",
     "SELECT count(*) AS orders FROM {orders} WHERE o_orderdate >= TIMESTAMP_NTZ '1996-07-01 00:00:00' AND o_orderdate < TIMESTAMP_NTZ '1996-08-01 00:00:00'"),
    ("Part type with the largest revenue",
     "SELECT p_type, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS revenue FROM {lineitem} "
     "JOIN {part} ON p_partkey = l_partkey GROUP BY p_type ORDER BY revenue DESC, p_type LIMIT 1"),
    ("Customers of nation 7", "SELECT c_name FROM {customer} WHERE c_nationkey = 7"),
    ("Number of fulfilled orders", "SELECT count(*) AS orders FROM {orders} WHERE o_orderstatus = 'F'"),
]


@query("answers_refresh", " UNION ALL ".join([
    "SELECT 'Spend of every customer' AS question, 'c_name,total' AS columns, c_name || '|' || "
    "sum(CAST(o_totalprice AS DECIMAL(18,2))) AS cells FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_name",
    "SELECT 'Orders of July 1996', 'orders', CAST(count(*) AS VARCHAR) FROM orders WHERE strftime(o_orderdate, '%Y-%m') = '1996-07'",
    "SELECT * FROM (SELECT 'Part type with the largest revenue', 'p_type,revenue', p_type || '|' || "
    "sum(CAST(l_extendedprice AS DECIMAL(18,2))) FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY p_type "
    "ORDER BY sum(CAST(l_extendedprice AS DECIMAL(18,2))) DESC, p_type LIMIT 1)",
    "SELECT 'Customers of nation 7', 'c_name', c_name FROM customer WHERE c_nationkey = 7",
    "SELECT 'Number of fulfilled orders', 'orders', CAST(count(*) AS VARCHAR) FROM orders WHERE o_orderstatus = 'F'"]))
def answers_refresh(t: Tables) -> DataFrame:
    """Every saved query again over the present tables, written as a new version."""
    answers = refresh_answers(t.spark, SAVED, t.all, new_path(t.spark, "answers"), 1)
    return answers.withColumn("cells", F.array_join("cells", "|"))


# ---- saved sums kept up to date from changes -------------------------------------------------

def changed_spend(t: Tables) -> DataFrame:
    """Spend per customer: saved without pending orders; then these arrive, low priorities go, and urgent prices double."""
    columns, sums = ["o_custkey", "o_totalprice"], {"total": F.col("o_totalprice")}
    saved = t.orders.where("o_orderstatus <> 'P'")
    state = written_table(delta.answer_state(saved.select(*columns), ["o_custkey"], sums), "spend")
    urgent = saved.where("o_orderpriority = '1-URGENT'").select(*columns)
    changes = delta.signed_changes(
        t.orders.where("o_orderstatus = 'P'").select(*columns), saved.where("o_orderpriority = '5-LOW'").select(*columns),
        (urgent, urgent.withColumn("o_totalprice", 2 * F.col("o_totalprice"))),
    )
    return delta.apply_changes(state, changes, ["o_custkey"], sums)


SPEND_SQL = """
SELECT o_custkey, count(*) AS orders, CAST(sum(CAST(CASE WHEN o_orderstatus <> 'P' AND o_orderpriority = '1-URGENT' THEN 2 ELSE 1 END
  * o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders WHERE o_orderstatus = 'P' OR o_orderpriority <> '5-LOW' GROUP BY o_custkey"""


@query("answers_delta", SPEND_SQL)
def answers_delta(t: Tables) -> DataFrame:
    return changed_spend(t).select("o_custkey", F.col("rows").alias("orders"), F.round("total", 2).cast("double").alias("total"))


@query("answers_delta_top", f"SELECT * FROM ({SPEND_SQL}) ORDER BY total DESC, o_custkey LIMIT 10")
def answers_delta_top(t: Tables) -> DataFrame:
    """The ten largest spenders, read off the maintained state."""
    top = delta.top_of_state(changed_spend(t), "total", ["o_custkey"], 10)
    return top.select("o_custkey", F.col("rows").alias("orders"), F.round("total", 2).cast("double").alias("total"))
