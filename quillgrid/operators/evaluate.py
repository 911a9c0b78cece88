"""Evaluation of result sets, retrieval and abstention, over many questions at once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import vocab
from ..session import broadcast_if_small, written_table


def cell_text(df: DataFrame, column: str) -> Column:
    """A value as the evaluator sees it in a flat list: 1 and 1.0 differ, NULL is 'None'."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit("None"))


def row_text(df: DataFrame, columns: list[str]) -> Column:
    """A whole row as text; quoted strings keep '1' apart from 1 and 'None' from NULL."""
    cells = []
    for column in columns:
        text = cell_text(df, column)
        if isinstance(df.schema[column].dataType, T.StringType):
            quoted = F.concat(F.lit("'"), F.replace(F.replace(F.col(f"`{column}`"), F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'")), F.lit("'"))
            text = F.when(F.col(f"`{column}`").isNull(), "None").otherwise(quoted)
        cells.append(text)
    return F.concat_ws(", ", *cells)


def result_rows(df: DataFrame, question: str = "question_id") -> DataFrame:
    """Result rows of many questions as (question_id, row, cells)."""
    columns = [c for c in df.columns if c != question]
    return df.select(
        F.col(question).alias("question_id"),
        row_text(df, columns).alias("row"),
        F.array(*[cell_text(df, c) for c in columns]).alias("cells"),
    )


def _both(gold: DataFrame, predicted: DataFrame) -> DataFrame:
    return gold.withColumn("side", F.lit(1)).unionByName(predicted.withColumn("side", F.lit(-1)))


def bag_difference(gold: DataFrame, predicted: DataFrame) -> DataFrame:
    """Rows whose number of copies differs: (question_id, row, surplus); positive = missing.

    One aggregation over both sides instead of a sort of either; copies of a row meet in the
    scan tasks first.
    """
    return (
        _both(gold, predicted).groupBy("question_id", "row").agg(F.sum("side").alias("surplus"))
        .where("surplus <> 0")
    )


def bag_equal(gold: DataFrame, predicted: DataFrame) -> DataFrame:
    """Per question: gold rows missing, rows too many, and whether the bags are equal."""
    rows = _both(gold, predicted).groupBy("question_id", "row").agg(F.sum("side").alias("surplus"))
    return rows.groupBy("question_id").agg(
        F.sum(F.greatest("surplus", F.lit(0))).alias("missing_rows"),
        F.sum(F.greatest(-F.col("surplus"), F.lit(0))).alias("extra_rows"),
        F.every(F.col("surplus") == 0).alias("equal"),
    )


def _cell_facts(rows: DataFrame) -> DataFrame:
    """From rows(question_id, cells, high, low), where high = 1 means in gold, low = -1 predicted."""
    cells = (
        rows.select("question_id", F.explode("cells").alias("cell"), "high", "low")
        .groupBy("question_id", "cell").agg(F.max("high").alias("high"), F.min("low").alias("low"))
    )
    return cells.groupBy("question_id").agg(
        F.count_if(F.col("high") == 1).alias("gold_cells"),
        F.count_if(F.col("low") == -1).alias("predicted_cells"),
        F.count_if(F.col("low") == 1).alias("missing_cells"),
    )


def cell_facts(gold: DataFrame, predicted: DataFrame) -> DataFrame:
    """Per question: distinct gold cells, distinct predicted cells, gold cells not predicted."""
    both = _both(gold, predicted)
    return _cell_facts(both.select("question_id", "cells", F.col("side").alias("high"), F.col("side").alias("low")))


def batch_result_match(questions: DataFrame, gold: DataFrame, predicted: DataFrame) -> DataFrame:
    """Execution accuracy per question: (question_id, correct).

    Correct if the rows are equal as bags; or, for a non-empty gold answer, if all its cells
    occur in the prediction, which has as many rows or at most 12 distinct cells more.
    """
    # written: rows and cells are both counted from it, and the compared queries run once
    rows = written_table(
        _both(gold, predicted).groupBy("question_id", "row", "cells").agg(
            F.sum("side").alias("surplus"), F.max("side").alias("high"), F.min("side").alias("low")
        ),
        "compared",
    )
    row_facts = rows.groupBy("question_id").agg(
        F.count_if(F.col("surplus") != 0).alias("different"), F.sum("surplus").alias("row_surplus")
    )
    cells = _cell_facts(rows)
    facts = questions.select("question_id").join(row_facts, "question_id", "left").join(cells, "question_id", "left")
    number = lambda name: F.coalesce(F.col(name), F.lit(0))
    contained = (number("missing_cells") == 0) & (
        (number("row_surplus") == 0)
        | (number("predicted_cells") <= number("gold_cells") + vocab.HARMLESS_EXTRA_CELLS)
    )
    correct = (
        F.when(number("different") == 0, True)
        .when(number("gold_cells") == 0, number("predicted_cells") == 0)
        .otherwise(contained)
    )
    return facts.select("question_id", correct.alias("correct"))


def result_match(gold: DataFrame, predicted: DataFrame) -> DataFrame:
    """The same for one question, whose rows may have different columns: one row (correct)."""
    one = lambda df: result_rows(df.withColumn("question_id", F.lit(1)))
    question = gold.sparkSession.range(1, 2).select(F.col("id").cast("int").alias("question_id"))
    return batch_result_match(question, one(gold), one(predicted)).select("correct")


def accuracy_rollup(results: DataFrame) -> DataFrame:
    """Correct, total and percent per level and overall, from results(level, correct)."""
    return (
        results.rollup("level")
        .agg(F.count_if("correct").alias("correct"), F.count("*").alias("total"), F.grouping_id().alias("all_levels"))
        .select(
            F.when(F.col("all_levels") == 1, "OVERALL").otherwise(F.col("level")).alias("level"),
            "correct", "total",
            F.round(F.try_divide(100 * F.col("correct"), F.col("total")), 1).alias("percent"),
        )
        .where("total > 0")
    )


def eval_subset(items: DataFrame, ids: list[str] | None = None, level: str | None = None, first: int | None = None) -> DataFrame:
    """Selection of evaluation items by id, level or position; all of them by default."""
    if ids:
        items = items.where(F.col("id").isin(ids))
    if level:
        items = items.where(F.col("level") == level)
    return items.orderBy("id").limit(first) if first else items


def group_by_level(items: DataFrame) -> DataFrame:
    """Ids per level, sorted: (level, id) in that order, so a level may hold any number of items."""
    return items.select("level", "id").orderBy("level", "id")


def recall_and_rank(ranks: DataFrame, k: int) -> DataFrame:
    """Share of the expected items within the first ``k``, and the mean rank of those found."""
    return ranks.agg(
        F.count("*").alias("expected"),
        F.count("rank").alias("found"),
        F.try_divide(F.count_if(F.col("rank") <= k), F.count("*")).alias("recall"),
        F.try_divide(F.sum("rank"), F.count("rank")).alias("mean_rank"),
    )


def settings_grid(ranks: DataFrame, ks: list[int], cuts: list[float]) -> DataFrame:
    """Recall and mean rank for every (k, cut) in one pass over ranks(rank, distance).

    An expected item counts for a setting if its rank is at most ``k`` and its distance at most
    ``cut``. Each row is counted once, in the cell of the smallest settings it satisfies; sums of
    the cells along both axes give all settings, so neither rows nor searches multiply with them.
    Rows without rank or distance, or beyond all settings, count as expected only; NaN is beyond
    every cut. Repeated settings are one. An empty table has recall and mean rank NULL.
    """
    ks, cuts = sorted(set(ks)), sorted(set(map(float, cuts)))
    # number of settings that are too small for the row: its place on the axis
    beyond = lambda settings, value, kind: F.size(F.filter(F.array(*map(F.lit, settings)).cast(f"array<{kind}>"), lambda x: x < value))
    seen = F.col("rank").isNotNull() & F.col("distance").isNotNull()
    cells = written_table(
        ranks.groupBy(
            F.when(seen, beyond(ks, F.col("rank"), "long")).alias("k_at"), F.when(seen, beyond(cuts, F.col("distance"), "double")).alias("cut_at")
        ).agg(F.count("*").alias("n"), F.sum("rank").cast("long").alias("sum_rank")),
        "cells",
    )
    expected = cells.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    places = lambda settings, kind: F.posexplode(F.array(*map(F.lit, settings)).cast(f"array<{kind}>"))
    settings = ranks.sparkSession.range(1).select(places(ks, "long").alias("k_at", "k")).select(
        "k_at", "k", places(cuts, "double").alias("cut_at", "cut")
    )
    # at most (settings of k + 1) * (cuts + 1) + 1 cells, whatever the size of the table
    filled = settings.join(F.broadcast(cells), ["k_at", "cut_at"], "left")
    upto = lambda group, order: Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    along = lambda df, window: df.select("k_at", "cut_at", "k", "cut", *[F.sum(c).over(window).alias(c) for c in ("n", "sum_rank")])
    sums = along(along(filled.fillna(0, ["n", "sum_rank"]), upto("k_at", "cut_at")), upto("cut_at", "k_at"))
    return sums.select(
        "k", "cut", expected.cast("long").alias("expected"), F.col("n").alias("found"),
        F.try_divide("n", expected).alias("recall"), F.try_divide("sum_rank", "n").alias("mean_rank"),
    )


def distance_ranges(decisions: DataFrame) -> DataFrame:
    """Smallest and largest distance per expected class: decisions(expected, distance)."""
    return decisions.groupBy("expected").agg(
        F.count("*").alias("questions"), F.min("distance").alias("nearest"), F.max("distance").alias("farthest")
    )


def threshold_sweep(decisions: DataFrame, step: float = 0.01) -> DataFrame:
    """Accuracy at every threshold of a grid: decisions(abstain_expected, distance).

    Each question is counted once in its grid step; the sums over all lower steps give every
    threshold at once, where comparing all thresholds with all questions would be a product.
    The grid has as many rows as there are steps between the distances.
    """
    scale = round(1 / step)
    # a question is answered at threshold t if distance <= t
    step_of = F.ceil(F.round(F.col("distance") * scale, 6))
    counted = decisions.groupBy(step_of.cast("long").alias("step")).agg(
        F.count_if(~F.col("abstain_expected")).alias("answerable"),
        F.count_if("abstain_expected").alias("unanswerable"),
    )
    # distances without a bound give a grid without a bound: sums run inside ranges of steps
    grid = written_table(counted.repartitionByRange("step").withColumn("range", F.spark_partition_id()), "grid")
    totals = grid.agg(F.sum("unanswerable").alias("refused"), F.sum(F.col("answerable") + F.col("unanswerable")).alias("questions")).first()
    known = grid.where("step IS NOT NULL")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range, which bounds the broadcast
    ranges = known.groupBy("range").agg(F.sum("answerable").alias("a"), F.sum("unanswerable").alias("u")).select(
        "range", F.coalesce(F.sum("a").over(before), F.lit(0)).alias("a"), F.coalesce(F.sum("u").over(before), F.lit(0)).alias("u")
    )
    upto = Window.partitionBy("range").orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    answered = F.sum("answerable").over(upto) + F.col("a")
    refused = F.lit(totals.refused).cast("long") - F.sum("unanswerable").over(upto) - F.col("u")
    sweep = known.join(F.broadcast(ranges), "range").select(
        "step", (answered + refused).alias("right"), F.lit(totals.questions).cast("long").alias("questions")
    )
    return sweep.select(
        (F.col("step") / scale).alias("threshold"), "right", "questions",
        F.try_divide("right", "questions").alias("accuracy"),
    )


def best_threshold(sweep: DataFrame) -> DataFrame:
    """The smallest threshold with the highest accuracy."""
    return sweep.orderBy(F.desc("accuracy"), "threshold").limit(1)


def ablation_compare(before: DataFrame, after: DataFrame) -> DataFrame:
    """Per question of two run logs (id, level, correct): fixed, broken or same."""
    left = before.select("id", F.col("level").alias("level_before"), F.col("correct").alias("before"))
    right = after.select("id", F.col("level").alias("level_after"), F.col("correct").alias("after"))
    change = (
        F.when(F.col("before").isNull(), "added").when(F.col("after").isNull(), "removed")
        .when(~F.col("before") & F.col("after"), "fixed").when(F.col("before") & ~F.col("after"), "broken")
        .otherwise("same")
    )
    return left.join(right, "id", "full_outer").select(
        "id", F.coalesce("level_before", "level_after").alias("level"), "before", "after", change.alias("change")
    )


def ablation_summary(comparison: DataFrame) -> DataFrame:
    """Per level: accuracy of both runs, their difference, and the numbers fixed and broken."""
    share = lambda c: F.try_divide(100 * F.count_if(c), F.count(c))
    return comparison.groupBy("level").agg(
        F.count("*").alias("questions"),
        F.round(share(F.col("before")), 1).alias("before"),
        F.round(share(F.col("after")), 1).alias("after"),
        F.round(share(F.col("after")) - share(F.col("before")), 1).alias("delta"),
        F.count_if(F.col("change") == "fixed").alias("fixed"),
        F.count_if(F.col("change") == "broken").alias("broken"),
    )


QUANTILE_BINS = 1024


def exact_quantiles(df: DataFrame, group: str, value: str, shares: list[float], bins: int = QUANTILE_BINS) -> DataFrame:
    """(group, share, quantile): interpolated quantiles of whole numbers per group, without sorting any group.

    A quantile lies between two rows of known rank. Every pass counts the values of the interval that
    holds a rank in ``bins`` equal bins and goes on with the bin that holds it, until an interval is one
    value: a pass divides the interval by ``bins``. What is shuffled and held is one row per group, interval and
    bin, so a group with all rows is no heavy task. Null values do not count; a group without values
    has null quantiles. A null group is a group.
    """
    spark = df.sparkSession
    rows = df.select(F.col(group).alias("group"), F.col(value).cast("long").alias("value"))
    sizes = written_table(rows.groupBy("group").agg(F.count("value").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")), "sizes")
    position = F.col("share") * (F.col("n") - 1)
    wanted = sizes.where("n > 0").select("*", F.explode(F.array(*map(F.lit, shares))).alias("share")).select(
        "group", "low", "high", F.explode(F.array(F.floor(position).cast("long"), F.ceil(position).cast("long"))).alias("rank")
    )
    open_ranks = written_table(wanted.distinct().withColumn("before", F.lit(0).cast("long")), "ranks")
    found = []
    while True:
        found.append(open_ranks.where("low = high").select("group", "rank", F.col("low").alias("at_rank")))
        open_ranks = open_ranks.where("low < high")
        if open_ranks.isEmpty():
            break
        # whole numbers throughout: doubles would put values of large intervals into wrong bins
        width = F.expr(f"(high - low) div {bins} + 1")
        intervals = open_ranks.select("group", "low", "high").distinct().withColumn("width", width)
        inside = rows.join(
            broadcast_if_small(intervals.withColumnRenamed("group", "of"), 100_000),
            F.col("group").eqNullSafe(F.col("of")) & F.col("value").between(F.col("low"), F.col("high")),
        )
        counted = inside.groupBy("group", "low", F.expr("(value - low) div width").alias("bin"), "width").count()
        upto = Window.partitionBy("group", "low").orderBy("bin")
        cumulated = counted.withColumn("upto", F.sum("count").over(upto)).withColumnRenamed("group", "of").withColumnRenamed("low", "from")
        there = F.col("rank") - F.col("before")
        holds = F.col("group").eqNullSafe(F.col("of")) & (F.col("low") == F.col("from")) & (there < F.col("upto")) & (there >= F.col("upto") - F.col("count"))
        start = F.col("low") + F.col("bin") * F.col("width")
        open_ranks = written_table(open_ranks.join(cumulated, holds).select(
            "group", start.alias("low"), F.least(start + F.col("width") - 1, F.col("high")).alias("high"), "rank",
            (F.col("before") + F.col("upto") - F.col("count")).alias("before"),
        ), "ranks")
    ranks = reduce(DataFrame.unionByName, found).select(F.col("group").alias("of"), "rank", "at_rank")
    asked = sizes.select("group", "n", F.explode(F.array(*map(F.lit, shares))).alias("share")).withColumn("position", position)
    at = lambda name, rank: ranks.select(F.col("of").alias(f"of_{name}"), F.col("rank").alias(f"rank_{name}"), F.col("at_rank").alias(name))
    join = lambda left, name, rank: left.join(at(name, rank), F.col("group").eqNullSafe(F.col(f"of_{name}")) & (rank == F.col(f"rank_{name}")), "left")
    both = join(join(asked, "below", F.floor("position").cast("long")), "above", F.ceil("position").cast("long"))
    between = (F.ceil("position") - F.col("position")) * F.col("below") + (F.col("position") - F.floor("position")) * F.col("above")
    return both.select(
        F.col("group").alias(group), "share",
        F.when(F.col("below") == F.col("above"), F.col("below").cast("double")).otherwise(between.cast("double")).alias("quantile"),
    )


def run_log_stats(log: DataFrame) -> DataFrame:
    """Per level: questions, errors, tokens, and milliseconds with their exact percentiles."""
    shares = {50: 0.5, 90: 0.9, 95: 0.95}
    figures = log.groupBy("level").agg(
        F.count("*").alias("questions"),
        F.count_if(F.col("correct") == 1).alias("correct"),
        F.count_if(F.coalesce(F.col("error"), F.lit("")) != "").alias("errors"),
        F.try_divide(F.sum("tokens"), F.count("tokens")).alias("mean_tokens"),
        F.try_divide(F.sum("ms"), F.count("ms")).alias("mean_ms"),
        F.max("ms").alias("max_ms"),
    )
    quantiles = exact_quantiles(log.select("level", "ms"), "level", "ms", list(shares.values()))
    percentiles = quantiles.groupBy(F.col("level").alias("of_level")).agg(
        *[F.max(F.when(F.col("share") == share, F.col("quantile"))).alias(f"p{p}_ms") for p, share in shares.items()]
    )
    return figures.join(percentiles, F.col("level").eqNullSafe(F.col("of_level"))).drop("of_level")
