import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from quillgrid.llm.exact_dedup import drop_exact_copies, exact_groups, landed, sha256, stream_state
from quillgrid.session import new_path


def brute(rows):
    groups = defaultdict(list)
    for doc, text in rows:
        text = text or ""
        groups[re.sub(r"[\x20\x09-\x0D]", "", text)].append((-len(text), doc is None, doc or 0, doc))
    out = []
    for members in groups.values():
        members.sort()
        for place, (_, _, _, doc) in enumerate(members):
            out.append((doc, members[0][3], len(members), place == 0))
    return sorted(out, key=repr)


def got(frame):
    return sorted(((r.id, r.keep_id, r.group_size, r.kept) for r in frame.collect()), key=repr)


def test_odd_rows(odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert got(exact_groups(odd_docs)) == brute(rows)


@pytest.mark.parametrize("files", [None, 1])
def test_colliding_digests_are_split_by_bytes(make_docs, files):
    """With a digest of the length alone nearly every hit differs in its bytes."""
    rows = [(i, t) for i, t in enumerate(["ab", "a b", "cd", "c d ", "xyz", "x yz", "", None, "ab"])] + [(20, "q")]
    weak = lambda text: F.length(text).cast("string").cast("binary")
    assert got(exact_groups(make_docs(rows), digest=weak, files_per_batch=files)) == brute(rows)


def test_state_lives_on_between_batches(spark, make_docs):
    rows = [(i, f"text {i % 7}") for i in range(60)]
    base = new_path(spark, "batches")
    table = landed(make_docs(rows, 6), "doc_id", "text", sha256)
    table.write.parquet(f"{base}/landed")
    source = spark.read.parquet(f"{base}/landed")
    state = stream_state(spark, source, f"{base}/landed", base, 1).collect()
    assert sorted((r.best.id, r["size"]) for r in state) == [(i, len(range(i, 60, 7))) for i in range(7)]
    # a second start of the same stream finds nothing new
    again = stream_state(spark, source, f"{base}/landed", base, 1).collect()
    assert sorted(again) == sorted(state)


def test_empty_table(make_docs):
    empty = make_docs([(1, "a")]).where("false")
    assert exact_groups(empty).collect() == []
    assert drop_exact_copies(empty).collect() == []


def test_dropping_keeps_one_row_with_all_columns(odd_docs):
    kept = drop_exact_copies(odd_docs)
    assert kept.columns == odd_docs.columns
    bodies = [re.sub(r"[\x20\x09-\x0D]", "", r.text or "") for r in kept.collect()]
    assert len(bodies) == len(set(bodies))
