import hashlib
import os
import random

import numpy as np
import pyarrow as pa
import pytest

from quillgrid.llm import common, repeats
from quillgrid.llm.common import SLICE
from quillgrid.llm.repeats import repeated_passages, shared_bytes


def brute(rows, length):
    first = {}
    for doc, text in rows:
        raw = (text or "").encode()
        if doc is not None:
            for p in range(len(raw) - length + 1):
                s = raw[p:p + length]
                first[s] = min(first.get(s, doc), doc)
    out = []
    for doc, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            if doc is not None and first[raw[p:p + length]] < doc:
                gone[p:p + length] = b"\x01" * length
        rest = bytes(b for b, g in zip(raw, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc, len(raw), sum(gone), runs, hashlib.sha256(rest).hexdigest(), rest))
    return sorted(out, key=repr)


def got(frame):
    return sorted(((r.id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in frame.collect()), key=repr)


def test_documents(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    expected = brute(rows, 50)
    assert sum(r[2] for r in expected) > 0
    assert got(repeated_passages(documents)) == expected


def test_small_alphabets_and_overlaps(make_docs):
    random.seed(2)
    parts = ["".join(random.choice("ab") for _ in range(random.randint(20, 90))) for _ in range(12)]
    rows = [(random.randint(0, 30), "".join(random.choice(parts) for _ in range(random.randint(0, 6)))) for _ in range(60)]
    rows += [(40 + i, "a" * (40 + i * 5)) for i in range(8)] + [(60 + i, "ab" * (20 + i * 4)) for i in range(8)]
    assert got(repeated_passages(make_docs(rows))) == brute(rows, 50)


def test_edges_of_shared_passages(make_docs):
    """One shared passage between different neighbours, down to exactly the length and one byte less."""
    random.seed(4)
    word = lambda n: "".join(random.choice("abcdefghij ") for _ in range(n))
    passage, rows = word(200), []
    for i in range(40):
        start, size = random.randint(0, 100), random.choice([49, 50, 51, 60, 100])
        rows.append((i, word(random.randint(0, 80)) + passage[start:start + size] + word(random.randint(0, 80))))
    assert got(repeated_passages(make_docs(rows))) == brute(rows, 50)


@pytest.mark.parametrize("flush, every", [(2, 3), (3, 10_000), (64, 2)])
def test_triggers_with_many_phrases(make_docs, flush, every):
    """One sequence between ever different neighbours, with the triggers spread in all ways."""
    random.seed(6)
    word = lambda n: "".join(random.choice("abcdef ") for _ in range(n))
    core, tails = word(30), [word(12) for _ in range(8)]
    rows = [(i, word(5) + random.choice(tails) + random.choice(tails) + core + random.choice(tails) + random.choice(tails)) for i in range(150)]
    docs = make_docs(rows, 7)
    assert got(repeated_passages(docs, hot_in_flush=flush, hot_in_all=every)) == brute(rows, 50)


def test_many_bytes_in_few_rows(make_docs):
    """Texts longer than one chunk of hashing."""
    random.seed(5)
    long = "".join(random.choice("abcdefgh") for _ in range(100_000))
    rows = [(1, long), (2, long[30_000:70_000] + "x" + long[:20_000]), (3, "short"), (4, long)]
    assert got(repeated_passages(make_docs(rows))) == brute(rows, 50)


def test_odd_rows(odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert got(repeated_passages(odd_docs)) == brute(rows, 50)
    assert repeated_passages(odd_docs.where("false")).collect() == []


def test_ids_with_several_texts(make_docs):
    a, b = "".join(f"w{i} " for i in range(40)), "".join(f"v{i} " for i in range(40))
    rows = [(1, a), (1, b), (1, a + b), (2, b + a), (2, a), (2, a), (3, "new " + b)]
    assert got(repeated_passages(make_docs(rows))) == brute(rows, 50)


@pytest.mark.parametrize("texts", [2, 300])
def test_many_texts_of_one_id(make_docs, texts):
    random.seed(8)
    word = lambda n: "".join(random.choice("abcdefgh ") for _ in range(n))
    passage = word(400)
    rows = [(1, passage)] + [(7, word(random.randint(0, 40)) + passage[(a := random.randint(0, 300)):a + random.randint(40, 90)] + word(30)) for _ in range(texts)]
    assert got(repeated_passages(make_docs(rows))) == brute(rows, 50)


@pytest.mark.parametrize("length", [16, 50, 300])
def test_other_lengths(make_docs, length):
    random.seed(9)
    parts = ["".join(random.choice("abc") for _ in range(random.randint(100, 400))) for _ in range(6)]
    rows = [(i, "".join(random.choice(parts) for _ in range(random.randint(0, 4)))) for i in range(40)]
    assert got(repeated_passages(make_docs(rows), length=length)) == brute(rows, length)


def test_orders_of_phrases():
    rows = np.random.default_rng(3).integers(0, 2, (500, 16), dtype=np.uint8)
    order, shared = shared_bytes(rows)
    ordered = [bytes(r) for r in rows[order]]
    assert ordered == sorted(map(bytes, rows))
    assert shared.tolist() == [-1] + [len(os.path.commonprefix([a, b])) for a, b in zip(ordered, ordered[1:])]


def test_kept_texts_leave_in_bounded_parts(spark, monkeypatch):
    """Texts that shrink to little in the shuffle are many megabytes again when they are cut."""
    made = []

    def held(df, function, schema):
        made.append(function)
        return spark.createDataFrame([], schema)

    monkeypatch.setattr(repeats, "in_tasks", held)
    docs = spark.createDataFrame([], "id long, variant long, text string")
    ranges = spark.createDataFrame([], "id long, variant long, first int, size int")
    repeats.cut_texts(docs, ranges)
    pack, cut = made
    texts = pa.RecordBatch.from_pydict({"id": list(range(24)), "variant": [0] * 24, "text": ["x" * (1 << 20)] * 24})
    packed = next(pack([texts]))
    whole = pa.array([[{"first": 0, "size": 1 << 19}]] * 24, pa.list_(pa.struct([("first", pa.int32()), ("size", pa.int32())])))
    assert packed.nbytes < 1 << 16
    parts = list(cut([pa.RecordBatch.from_arrays([packed["id"], packed["packed"], whole], names=["id", "packed", "ranges"])]))
    assert sum(p.num_rows for p in parts) == 24
    assert max(p.nbytes for p in parts) <= SLICE + (1 << 20)


def test_groups_give_their_memory_back(spark, monkeypatch):
    grouped, made = spark.range(1).groupBy("id"), []
    monkeypatch.setattr(type(grouped), "applyInArrow", lambda self, function, schema: made.append(function))
    freed = []
    monkeypatch.setattr(common, "release_memory", lambda: freed.append(True))
    common.in_groups(grouped, lambda table: table.slice(0, 1), "id long")
    assert made[0](pa.table({"id": [1, 2]})).num_rows == 1 and freed == [True]
