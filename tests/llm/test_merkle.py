import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillgrid.llm import merkle
from quillgrid.llm.merkle import manifest

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # columns whose names the operator uses inside
    T.StructField("tree", T.StringType()), T.StructField("position", T.StringType()), T.StructField("leaf", T.StringType()),
])


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(row, more=0):
    i, text, lang, source, n = row[:5]
    return H(*map(field, (i, source, lang, n + more if n is not None else None, text)))


def levels_over(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][k:k + 2]) for k in range(0, len(levels[-1]), 2)])
    return levels


def way(levels, k):
    out = []
    for level in levels[:-1]:
        run = level[k // 2 * 2:k // 2 * 2 + 2]
        out.append((k % 2, [x for j, x in enumerate(run) if j != k % 2]))
        k //= 2
    return out


def fold(node, steps):
    for place, others in steps:
        node = H(node, *others) if place == 0 else H(*others, node)
    return node


def plainly(rows):
    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append(row)
    order = sorted(trees, key=lambda lang: (lang is not None, (lang or "").encode()))
    for lang in order:
        trees[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
    levels = {lang: levels_over([leaf_of(r) for r in trees[lang]]) for lang in order}
    top = levels_over([levels[lang][-1][0] for lang in order])
    root, out = top[-1][0], []
    for place, lang in enumerate(order):
        for k, row in enumerate(trees[lang]):
            steps = way(levels[lang], k) + way(top, place)
            bad = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[4] is not None
            again = fold(leaf_of(row, 1) if bad else leaf_of(row), steps)
            proof = H(*(x for _, others in steps for x in others))
            out.append((row[0], leaf_of(row), levels[lang][-1][0], root, proof, again, again == root))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def check(spark):
    def run(rows, partitions=4):
        docs = spark.createDataFrame([(*r, "t", None, "l") for r in rows], SCHEMA).repartition(partitions)
        got = manifest(docs, F.crc32(F.col("doc_id").cast("string")) % 7 == 0)
        assert sorted(map(tuple, got.collect()), key=repr) == plainly(rows)

    return run


@pytest.mark.parametrize("sizes", [[1], [2, 1], [1, 2, 3, 5], [7, 16, 1, 33, 4], [1] * 9])
def test_trees_of_all_shapes(check, sizes):
    check([(1000 * j + 3 * k, f"text {k}", f"l{j}", "web", k) for j, size in enumerate(sizes) for k in range(size)])


def test_more_nodes_than_slots(check, monkeypatch):
    rows = [(k * 37 % 100_003 - 500, f"t{k}", "en" if k % 3 else "de", None, k) for k in range(3000)]
    check(rows)


def test_words_edges_and_negative_ids(check):
    ids = [-(1 << 63), -65, -64, -63, -1, 0, 1, 62, 63, 64, 127, 128, (1 << 63) - 1, 1 << 40]
    check([(i, "x", "en", "s", 1) for i in ids])


def test_nulls_in_every_column_and_long_values(check):
    check([
        (None, None, None, None, None), (1, None, "en", "s", 2), (2, "", "", "", 0), (3, "ü" * 50_000, "en", None, None),
        (7, "x", None, "s", (1 << 63) - 2), (8, "a:b", "é", "1:a", -5), (24, "x", "en", "s", 3), (None, "y", "en", "s", 3),
    ])


def test_rows_that_share_an_id(check):
    rows = [(5, f"t{k % 7}", "en", "s", k % 3) for k in range(60)] + [(k, "t", "en", "s", 1) for k in range(20)]
    rows += [(None, f"n{k % 5}", "en", "s", 1) for k in range(40)] + [(9, "same", None, "s", 1)] * 30
    check(rows)


def test_empty_table(spark):
    empty = manifest(spark.createDataFrame([], SCHEMA))
    assert empty.collect() == [] and empty.columns == ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_without_tampering_every_proof_holds(spark, documents):
    assert manifest(documents).where("NOT verified").isEmpty()


def test_slots_of_an_array_are_bounded(spark, documents):
    leaves = merkle.leaf_rows(documents)
    index = merkle.rank_index(leaves)
    arrays = merkle.slot_arrays(merkle.ranked(leaves, index).withColumnRenamed("leaf", "node"), index.sizes)
    assert arrays.agg(F.max(F.size("slots"))).first()[0] <= 1 << merkle.SLOT_BITS
    # a place is found for every row, and the places of a tree are consecutive
    places = merkle.ranked(leaves, index).groupBy("tree").agg(F.count("*").alias("n"), F.max("position").alias("last"), F.count_distinct("position").alias("d"))
    assert all(r.n == r.d == r.last + 1 for r in places.collect())
