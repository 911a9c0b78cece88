import random

import pytest
from pyspark.sql import functions as F

from quillgrid.operators import evaluate
from quillgrid.sources import tables


def verdict(gold, predicted):
    """The rule on plain rows."""
    if sorted(map(repr, gold)) == sorted(map(repr, predicted)):
        return True
    g, p = ({str(v) for row in rows for v in row} for rows in (gold, predicted))
    if not any(gold):
        return not p
    return g <= p and (len(gold) == len(predicted) or len(p) <= len(g) + 12)


def frame(spark, rows):
    if not rows:
        return spark.createDataFrame([], "a string")
    kinds = {int: "long", float: "double", str: "string"}
    schema = ", ".join(f"c{i} {kinds[type(v)]}" for i, v in enumerate(rows[0]))
    return spark.createDataFrame(rows, schema)


CASES = [
    ([(1, "a")], [(1, "a")]),
    ([(1, "a"), (2, "b")], [(2, "b"), (1, "a")]),
    ([(1,)], [(1.0,)]),
    ([(1,)], [("1",)]),
    ([(1,), (1,)], [(1,)]),
    ([], []),
    ([], [(1,)]),
    ([(1,)], []),
    ([(1,)], [(1, "extra")]),
    ([(1,)], [(1, "x"), (2, "y")]),
    ([(1,)], [(i, f"x{i}") for i in range(1, 8)]),
    ([(1,)], [(i,) for i in range(1, 14)]),
    ([(1,)], [(i,) for i in range(1, 15)]),
    ([(1, 2)], [(1,), (2,)]),
    ([("a",), ("b",)], [("a",), ("c",)]),
]


@pytest.mark.parametrize("gold, predicted", CASES)
def test_result_match(spark, gold, predicted):
    assert evaluate.result_match(frame(spark, gold), frame(spark, predicted)).first().correct is verdict(gold, predicted)


def test_batch_equals_one_by_one(spark):
    one_column = [(g, p) for g, p in CASES if all(len(r) == 1 and type(r[0]) is int for r in g + p)]
    long = lambda side: spark.createDataFrame(
        [(q, row[0]) for q, case in enumerate(one_column) for row in case[side]], "question_id long, v long"
    )
    questions = spark.createDataFrame([(q,) for q in range(len(one_column))], "question_id long")
    matched = evaluate.batch_result_match(questions, evaluate.result_rows(long(0)), evaluate.result_rows(long(1)))
    assert {r.question_id: r.correct for r in matched.collect()} == {q: verdict(*c) for q, c in enumerate(one_column)}


def test_null_differs_from_the_word_none(spark):
    gold = spark.createDataFrame([(None,)], "v string")
    assert evaluate.result_match(gold, spark.createDataFrame([(None,)], "v string")).first().correct
    rows = evaluate.bag_difference(
        evaluate.result_rows(gold.withColumn("question_id", F.lit(1))),
        evaluate.result_rows(spark.createDataFrame([("None", 1)], "v string, question_id int")),
    )
    assert rows.count() == 2


def test_rollup(spark):
    rows = [("easy", True)] * 3 + [("medium", True), ("medium", False), ("hard", False)]
    found = evaluate.accuracy_rollup(spark.createDataFrame(rows, "level string, correct boolean")).collect()
    assert {r.level: (r.correct, r.total, r.percent) for r in found} == {
        "easy": (3, 3, 100.0), "medium": (1, 2, 50.0), "hard": (0, 1, 0.0), "OVERALL": (4, 6, 66.7),
    }
    assert evaluate.accuracy_rollup(spark.createDataFrame([], "level string, correct boolean")).count() == 0


def test_recall_and_rank(spark):
    ranks = spark.createDataFrame([(1,), (3,), (2,), (None,)], "rank long")
    row = evaluate.recall_and_rank(ranks, 2).first()
    assert (row.expected, row.found, row.recall, row.mean_rank) == (4, 3, 0.5, 2.0)


def test_settings_grid_equals_single_runs(spark):
    draw = random.Random(5)
    rows = [(draw.randint(1, 9), draw.choice([0.1, 0.25, 0.5, 0.9, 1.5])) for _ in range(300)]
    rows += [(None, None), (None, 0.1), (2, None), (1, float("nan"))]
    ranks = spark.createDataFrame(rows, "rank long, distance double")
    ks, cuts = [8, 1, 3, 3, 5], [0.5, 0.1, 1.0, 0.25]
    grid = {(r.k, r.cut): (r.expected, r.found, r.recall, r.mean_rank) for r in evaluate.settings_grid(ranks, ks, cuts).collect()}
    assert set(grid) == {(k, c) for k in ks for c in cuts}
    for (k, cut), got in grid.items():
        hits = [r for r, d in rows if r is not None and d is not None and r <= k and d <= cut]
        mean = sum(hits) / len(hits) if hits else None
        assert got == (len(rows), len(hits), len(hits) / len(rows), mean)


def test_settings_grid_of_nothing(spark):
    none = spark.createDataFrame([], "rank long, distance double")
    rows = evaluate.settings_grid(none, [1, 2], [0.5]).collect()
    assert [(r.expected, r.found, r.recall, r.mean_rank) for r in rows] == [(0, 0, None, None)] * 2


def test_threshold_sweep(spark):
    rows = [(0.633, False), (0.797, False), (0.828, True), (0.91, True), (None, True)]
    decisions = spark.createDataFrame(rows, "distance double, abstain_expected boolean")
    sweep = {round(r.threshold, 2): r.right for r in evaluate.threshold_sweep(decisions).collect()}
    assert sweep == {0.64: 4, 0.8: 5, 0.83: 4, 0.91: 3}
    assert evaluate.best_threshold(evaluate.threshold_sweep(decisions)).first().threshold == 0.8


def test_ablation(spark):
    log = lambda rows: spark.createDataFrame(rows, "id string, level string, correct boolean")
    before = log([("a", "easy", False), ("b", "easy", True), ("c", "hard", True), ("d", "hard", True)])
    after = log([("a", "easy", True), ("b", "easy", False), ("c", "hard", True), ("e", "hard", True)])
    found = {r.id: r.change for r in evaluate.ablation_compare(before, after).collect()}
    assert found == {"a": "fixed", "b": "broken", "c": "same", "d": "removed", "e": "added"}


def test_subset_and_levels(spark):
    items = spark.createDataFrame([("e1", "easy"), ("h1", "hard"), ("e2", "easy")], "id string, level string")
    assert evaluate.eval_subset(items, level="easy", first=1).first().id == "e1"
    assert evaluate.eval_subset(items, ids=["h1"]).count() == 1
    assert [tuple(r) for r in evaluate.group_by_level(items).collect()] == [("easy", "e1"), ("easy", "e2"), ("hard", "h1")]


def test_run_log_survives_quotes_and_line_breaks(spark, tmp_path):
    row = ("q1", "easy", 1, "how, \"many\"?", "SELECT 1\n FROM t", " padded ", None, 12, 34)
    log = spark.createDataFrame([row], tables.RUN_LOG_SCHEMA)
    tables.write_run_log(log, str(tmp_path / "log"))
    assert [tuple(r) for r in tables.read_run_log(spark, str(tmp_path / "log")).collect()] == [row]


def quantile_by_sort(values, share):
    values = sorted(v for v in values if v is not None)
    if not values:
        return None
    at = share * (len(values) - 1)
    low, high = values[int(at)], values[min(int(at) + 1, len(values) - 1)]
    return low + (high - low) * (at - int(at))


@pytest.mark.parametrize("bins", [50, 1024])
def test_exact_quantiles(spark, bins):
    draw = random.Random(bins)
    groups = {
        "a": [draw.randint(-50, 50) for _ in range(301)], "b": [draw.randint(-10**15, 10**15) for _ in range(100)],
        "c": [7], "d": [None, None], None: [1, 2, None, 4], "e": [5] * 400 + [6], "f": [0, 10**17],
    }
    rows = [(g, v) for g, values in groups.items() for v in values]
    found = evaluate.exact_quantiles(spark.createDataFrame(rows, "g string, v long"), "g", "v", [0.0, 0.5, 0.95, 1.0], bins).collect()
    assert len(found) == 4 * len(groups)
    for r in found:
        expected = quantile_by_sort(groups[r.g], r.share)
        assert r.quantile is None if expected is None else r.quantile == pytest.approx(expected, rel=1e-12)


def test_quantiles_of_one_hot_level_are_counted_in_bins(spark, monkeypatch):
    """No task gets more than the bins: what is written per pass are ranks, what is shuffled are counts."""
    rows = spark.range(0, 200_000, 1, 8).select(F.lit("all").alias("g"), (F.col("id") * 7919 % 1_000_003).alias("v"))
    passes = []
    written = evaluate.written_table
    monkeypatch.setattr(evaluate, "written_table", lambda df, name: passes.append((name, (out := written(df, name)).count())) or out)
    r = evaluate.exact_quantiles(rows, "g", "v", [0.5], bins=64).first()
    assert r.quantile == quantile_by_sort([i * 7919 % 1_000_003 for i in range(200_000)], 0.5)
    assert all(n <= 2 for name, n in passes) and len(passes) <= 2 + 5


def test_run_log_without_milliseconds(spark):
    log = spark.createDataFrame([("x", 1, None, 3, None), ("x", 0, "e", 5, None), (None, 1, "", 4, 8)], "level string, correct int, error string, tokens long, ms long")
    stats = {r.level: (r.questions, r.correct, r.errors, r.max_ms, r.p50_ms, r.p95_ms) for r in evaluate.run_log_stats(log).collect()}
    assert stats == {"x": (2, 1, 1, None, None, None), None: (1, 1, 0, 8, 8.0, 8.0)}


def test_changed_state_is_that_of_a_full_run(spark, tmp_path):
    from quillgrid.operators import delta

    draw = random.Random(4)
    schema = "k string, x double"
    row = lambda: (draw.choice(["a", "b", "b", "b", None, "z"]), draw.choice([None, round(draw.uniform(-9, 9), 2)]))
    frame_of = lambda rows: spark.createDataFrame(rows, schema)
    contents = lambda df: {tuple(r) for r in df.collect()}
    for keys in (["k"], []):
        facts, sums = [row() for _ in range(60)] + [("gone", 1.5)], {"x": F.col("x")}
        state = delta.answer_state(frame_of(facts), keys, sums)
        for number in range(3):
            inserted = [row() for _ in range(10)]
            deleted = [facts.pop(draw.randrange(len(facts))) for _ in range(5)] + ([facts.pop(facts.index(("gone", 1.5)))] if ("gone", 1.5) in facts else [])
            old = [facts.pop(draw.randrange(len(facts))) for _ in range(5)]
            new = [(draw.choice("abcd"), x and x + 1) for _, x in old]
            facts += inserted + new
            changes = delta.signed_changes(frame_of(inserted), frame_of(deleted), (frame_of(old), frame_of(new)))
            state.write.mode("overwrite").parquet(f"{tmp_path}/{len(keys)}-{number}")
            saved = spark.read.parquet(f"{tmp_path}/{len(keys)}-{number}")
            state = delta.apply_changes(saved, changes, keys, sums)
            full = delta.answer_state(frame_of(facts), keys, sums)
            assert contents(state) == contents(full) and state.dtypes == full.dtypes
            if keys:
                assert contents(delta.top_of_state(state, "x", keys, 2)) == contents(full.orderBy(F.desc("x"), "k").limit(2))


def test_no_change_and_no_facts(spark):
    from quillgrid.operators import delta

    none = spark.createDataFrame([], "k string, x double")
    state = delta.answer_state(none, ["k"], {"x": F.col("x")})
    assert delta.apply_changes(state, delta.signed_changes(none), ["k"], {"x": F.col("x")}).collect() == []
    one = delta.answer_state(none, [], {"x": F.col("x")})
    assert [tuple(r) for r in delta.apply_changes(one, delta.signed_changes(none), [], {"x": F.col("x")}).collect()] == [(0, 0)]
