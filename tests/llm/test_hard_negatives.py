import numpy as np
import pytest
from pyspark.sql import types as T

from quillgrid.llm import hard_negatives
from quillgrid.llm.hard_negatives import mine_hard_negatives, surviving_pairs

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("vector", T.ArrayType(T.DoubleType())), T.StructField("label", T.IntegerType()),
    # columns whose names the operator uses inside
    T.StructField("id", T.StringType()), T.StructField("score", T.StringType()), T.StructField("anchor", T.StringType()),
])


def plainly(rows, every=100, wanted=5):
    usable = []
    for i, vector, label in rows:
        if i is not None and vector is not None and label is not None and all(x is not None and np.isfinite(x) for x in vector):
            usable.append((i, [int(np.floor(256 * x)) for x in vector], label))
    out = []
    for i, vector, label in usable:
        if i % every:
            continue
        score = [(-sum(a * b for a, b in zip(vector, v)), j, l) for j, v, l in usable if j != i]
        for p, positive, l in sorted(s for s in score if s[2] == label)[:wanted]:
            window = sorted(s for s in score if s[2] != label and 80 * -p <= 100 * -s[0] <= 100 * -p)[:wanted]
            out += [(i, positive, k + 1, j, -p, -n) for k, (n, j, _) in enumerate(window)]
    return sorted(out)


@pytest.fixture(scope="module")
def check(spark):
    def run(rows, partitions=3, **kind):
        table = spark.createDataFrame([(*r, "x", None, "y") for r in rows], SCHEMA).repartition(partitions)
        assert sorted(map(tuple, mine_hard_negatives(table, **kind).collect())) == (expected := plainly(rows, kind.get("every", 100)))
        return expected

    return run


def sphere(n, width, seed, step=20):
    draw = np.random.default_rng(seed)
    vectors = draw.normal(size=(n, width)) / np.sqrt(width)
    return [(step * i, vectors[i].tolist(), int(draw.integers(0, 4))) for i in range(n)]


@pytest.mark.parametrize("width", [1, 3, 8, 21, 64])
def test_same_as_all_pairs(check, width):
    assert check(sphere(700, width, width))


def test_small_batches_of_anchors_and_blocks(check, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 50)
    check(sphere(600, 12, 1), batch_values=12 * 20)


def test_hot_label_and_copies_of_one_vector(check):
    rows = sphere(500, 16, 2)
    copy = rows[0][1]
    rows = [(i, copy if k % 3 == 0 else v, 1 if k % 3 == 0 else label) for k, (i, v, label) in enumerate(rows)]
    # copies under another label are the hardest negatives of all
    rows += [(10_001 + k, copy, 2) for k in range(9)]
    check(rows)


def test_sparse_positive_vectors(check):
    draw = np.random.default_rng(5)
    rows = [(10 * i, np.where(draw.random(40) < 0.1, draw.random(40), 0).tolist(), i % 3) for i in range(400)]
    check(rows)


def test_rows_that_take_no_part(check):
    rows = sphere(200, 4, 3)
    rows += [(None, [1.0] * 4, 1), (300, None, 1), (500, [1.0, None, 0.0, 0.0], 1), (700, [float("nan")] * 4, 1), (900, [float("inf")] * 4, 1), (1100, [1.0] * 4, None)]
    check(rows)


def test_shared_ids_lengths_ties_and_zeros(check):
    rows = [(100, [0.5, 0.5], 1), (100, [0.5, 0.25], 1), (7, [0.5, 0.5, 3.0], 1), (8, [0.5], 1), (9, [], 1), (200, [0.0, 0.0], 2), (300, [], 2)]
    rows += [(20 + i, [0.5, 0.4], 2) for i in range(12)] + [(40 + i, [-0.5, 0.4], 3) for i in range(8)] + [(20, [0.5, 0.4], 2)]
    check(rows)


def test_scores_beyond_doubles(check):
    check([(i, [3e5 + i, 2e5 - i, 1e6 + 1e-3 * i], i % 2) for i in range(0, 400, 5)])


def test_empty_table_and_no_anchor(check):
    assert check([]) == [] and check([(1, [1.0], 1), (2, [1.0], 2)]) == []


def test_bounds_rule_out_pairs_and_lose_none():
    draw = np.random.default_rng(0)
    items = np.floor(256 * draw.normal(size=(3000, 64)) / 8)
    queries, threshold = items[:40], 0.45 * (items[:40] ** 2).sum(1)
    every = lambda order: np.ones((40, len(order)), bool)
    rows, columns = surviving_pairs(queries, items, threshold, every)
    scores = queries @ items.T
    wanted = set(zip(*np.nonzero(scores >= threshold[:, None])))
    got = set(zip(rows, columns))
    assert wanted <= got and len(got) < 40 * 3000 / 10
