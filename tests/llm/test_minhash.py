import random
from collections import defaultdict

import numpy as np
import pytest

from quillgrid.llm.minhash import Circle, WordHashes, drop_near_copies, near_duplicates, shingles


def sets_of(text, width):
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return frozenset()
    if len(words) < width:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i:i + width]) for i in range(len(words) - width + 1))


def brute(rows, width, percent=80):
    """All pairs that share a shingle, then a plain search for components."""
    sets, where = {}, defaultdict(set)
    for doc, text in rows:
        sets[doc] = sets_of(text, width)
        for s in sets[doc]:
            where[s].add(doc)
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for doc, own in sets.items():
        shared = defaultdict(int)
        for s in own:
            for other in where[s]:
                if other < doc:
                    shared[other] += 1
        for other, both in shared.items():
            if 100 * both >= percent * (len(own) + len(sets[other]) - both):
                a, b = sorted((root(doc), root(other)))
                parent[b] = a
    return sorted((d, len(sets[d]), root(d), root(d) == d) for d in sets)


def got(frame):
    return sorted((r.id, r.n_shingles, r.component_id, r.kept) for r in frame.collect())


@pytest.mark.parametrize("width", [2, 5])
def test_documents_like_brute_force(documents, width):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert got(near_duplicates(documents, width=width)) == brute(rows, width)


def test_group_at_the_threshold(make_docs):
    """Near copies that are linked only along a chain, and a common passage that must not link."""
    random.seed(3)
    words = [f"w{i}" for i in range(400)]
    rows, chain = [], words[:120]
    for i in range(40):
        chain = list(chain)
        for at in random.sample(range(120), 4):
            chain[at] = f"c{i}x{at}"
        rows.append((i, " ".join(chain)))
    passage = " ".join(words[200:260])
    rows += [(100 + i, passage + " " + " ".join(f"u{i}v{j}" for j in range(25))) for i in range(60)]
    assert got(near_duplicates(make_docs(rows), width=2, tries=1)) == brute(rows, 2)


def test_group_of_near_copies_without_a_centre(make_docs):
    """Copies of one text with more and more changes: some are linked, the others lie just beyond."""
    random.seed(8)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(120):
        words = list(base)
        for at in random.sample(range(150), random.randint(0, 20)):
            words[at] = f"x{i}y{at}"
        rows.append((i, " ".join(words)))
    expected = brute(rows, 2)
    assert 20 < sum(r[3] for r in expected) < 100
    assert got(near_duplicates(make_docs(rows), width=2)) == expected


def test_odd_rows(odd_docs):
    frame = near_duplicates(odd_docs, width=2)
    rows = {r.doc_id: r.text for r in odd_docs.collect() if r.doc_id is not None}
    expected = {r[0]: r for r in brute(rows.items(), 2)}
    results = [tuple(r) for r in frame.collect()]
    assert len(results) == odd_docs.count()
    for row in results:
        assert row == expected[row[0]] if row[0] is not None else row[2:] == (None, True)


def test_empty_table(odd_docs):
    assert near_duplicates(odd_docs.where("false")).collect() == []


def test_one_document_of_a_group_stays(make_docs):
    text = " ".join(f"w{i}" for i in range(100))
    docs = make_docs([(1, text), (2, text + " end"), (3, "other words stand here"), (None, text), (4, None)])
    kept = drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 3, 4]


def test_coordinates_are_shifted_readings_of_one_permutation():
    circle, memo = Circle(), WordHashes()
    a, b = shingles("one two three four five six", 2, memo), shingles("one two three four five seven", 2, memo)
    low = np.minimum(circle.signature(a), circle.signature(b))
    assert (circle.signature(np.unique(np.concatenate([a, b]))) == low).all()
    assert circle.readings[5][0] == circle.readings[0][5]
