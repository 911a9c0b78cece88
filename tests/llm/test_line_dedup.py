import contextlib
import io

from pyspark.sql import functions as F

from quillgrid.llm.line_dedup import SPACE, dedup_lines, drop_bitmaps, frequent_lines, hashed_lines

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
NONE = -(1 << 63)


def key(line):
    return line.strip(SPACE).translate(FOLD)


def plainly(rows, least_chars=40, least_docs=5):
    """(id, n_lines, n_dropped, kept) of every row, by plain dictionaries."""
    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least_chars:
                holders.setdefault(key(line), set()).add(NONE if i is None else i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        goes = [len(holders.get(key(x), ())) >= least_docs and max(holders[key(x)]) != (NONE if i is None else i) for x in lines]
        out.append((i, len(lines), sum(goes), "\n".join(x for x, g in zip(lines, goes) if not g)))
    return sorted(out, key=repr)


def found(docs, **limits):
    return sorted(map(tuple, dedup_lines(docs, **limits).collect()), key=repr)


LONG = "the same licence line that very many of the documents hold"


def test_lines_of_many_documents(make_docs):
    rows = [(i, f"{i} first\n \t{LONG.upper() if i % 2 else LONG}\r\nshort\nshort\n{LONG}") for i in range(12)]
    rows += [(50 + i, f"{LONG} but in four documents only") for i in range(4)]
    rows += [(70, "É" * 39), (71, "É" * 40), (72, "é" * 40)]
    assert found(make_docs(rows)) == plainly(rows)
    assert {r[2] for r in found(make_docs(rows)) if r[0] < 11} == {2}


def test_ids_that_are_null_or_repeated(make_docs):
    rows = [(None, f"{LONG}\na"), (None, f"{LONG}\nb"), (3, LONG), (3, f"x\n{LONG}"), (4, LONG), (4, LONG), (5, LONG), (6, f"{LONG}\n{LONG}")]
    assert found(make_docs(rows)) == plainly(rows)
    # rows without id are one document
    assert found(make_docs(rows[:2] + rows[4:])) == plainly(rows[:2] + rows[4:])


def test_odd_texts(odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert found(odd_docs) == plainly(rows)
    assert found(odd_docs, least_chars=1, least_docs=2) == plainly(rows, 1, 2)


def test_long_document_with_many_lines(make_docs):
    rows = [(i, "\n".join(f"{LONG} {j % 400}" for j in range(i * 3000))) for i in range(7)]
    assert found(make_docs(rows)) == plainly(rows)


def test_bitmaps_hold_only_words_with_a_dropped_line(make_docs):
    rows = [(i, "\n".join(["own line"] * 200 + [LONG] + ["own line"] * 100)) for i in range(5)] + [(9, "nothing")]
    bitmaps = {r.id: r for r in drop_bitmaps(make_docs(rows)).collect()}
    assert sorted(bitmaps) == [0, 1, 2, 3]
    assert [tuple(w) for w in bitmaps[0].words] == [(200 // 64, 1 << (200 % 64))] and bitmaps[0].n_dropped == 1


def test_empty_table(make_docs):
    assert found(make_docs([])) == []


def test_a_line_in_all_documents_is_many_ranges(spark, make_docs):
    rows = [(i, f"{LONG}\n{LONG} {i}") for i in range(4000)]
    lines = hashed_lines(make_docs(rows, 8), "doc_id", "text", 40)
    ordered = lines.repartitionByRange(16, "hash_1", "hash_2", "id")
    sizes = [r["count"] for r in ordered.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 3 * sum(sizes) / 16
    with contextlib.redirect_stdout(io.StringIO()) as plan:
        frequent_lines(lines, 5).explain()
    exchanges = [line for line in plan.getvalue().splitlines() if "Exchange" in line and "RoundRobin" not in line]
    assert len(exchanges) == 2 and any("rangepartitioning" in line for line in exchanges)
    assert found(make_docs(rows)) == plainly(rows)
