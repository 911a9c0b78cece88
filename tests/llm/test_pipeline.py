"""The stages on the whole small tables, each against a plain reading of its own input."""

import re
from functools import cache

import corpus_pipeline
import pytest

from quillgrid.llm.queries import piece_model
from tests.llm.test_exact_dedup import brute as exact_brute
from tests.llm.test_minhash import brute as near_brute

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output of every stage, written and read again in between."""
    base = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, FOLDER)
        result.write.parquet(f"{base}/{name}")
        result = spark.read.parquet(f"{base}/{name}")
        out[name] = docs, result
        docs = result
    return out


def rows_of(frame):
    return {r.doc_id: r.text for r in frame.collect()}


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == list(stages)
    assert all(out.columns == before.columns for before, out in list(stages.values())[:-1])


def test_toxic_documents_go(spark, stages):
    before, after = map(rows_of, stages["toxicity"])
    toxic = {r.doc_id for r in spark.read.parquet(f"{FOLDER}/labels.parquet").where("toxic = 1").collect()}
    clean = {r.doc_id for r in spark.read.parquet(f"{FOLDER}/labels.parquet").where("toxic = 0").collect()}
    gone = before.keys() - after.keys()
    assert len(gone & toxic) >= 0.9 * len(toxic) and len(gone & clean) <= 0.01 * len(clean)


def test_one_of_equal_texts_stays(stages):
    before, after = map(rows_of, stages["exact_dedup"])
    assert set(after) == {doc for doc, _, _, kept in exact_brute(list(before.items())) if kept}


def test_one_of_near_copies_stays(stages):
    before, after = map(rows_of, stages["minhash_near_dedup"])
    assert set(after) == {doc for doc, _, _, kept in near_brute(list(before.items()), 5) if kept}


def test_benchmark_passages_go(spark, stages):
    before, after = map(rows_of, stages["benchmark_decontamination"])
    items = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    words = cache(lambda text: tuple(re.findall(r"\w+", text.lower())))
    windows = {words(t)[k:k + 8] for t in items for k in range(len(words(t)) - 7)}
    holds = {d for d, t in before.items() if any(i in t for i in items)}
    touched = {d for d, t in before.items() if any(words(t)[k:k + 8] in windows for k in range(len(words(t)) - 7))}
    gone = before.keys() - after.keys()
    assert holds and holds <= gone <= touched


def test_ids_of_what_is_left(stages):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    before, out = stages["sentencepiece"]
    texts = rows_of(before)
    result = out.collect()
    assert len(result) == len(texts)
    for r in result[:200]:
        ids = library.encode(texts[r.doc_id], add_bos=True, add_eos=True)
        assert list(memoryview(bytes(r.ids)).cast("I")) == ids and r.n_tokens == len(ids) and r.decoded == texts[r.doc_id]


def test_odd_rows_go_through(spark, odd_docs):
    """All stages on nulls, blanks, ties and repeated rows; every kind of row has its place."""
    docs = odd_docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == odd_docs.columns, name
    bodies = [re.sub(r"[\x20\x09-\x0D]", "", r.text or "") for r in docs.collect()]
    assert len(bodies) == len(set(bodies)) and "" in bodies
    assert corpus_pipeline.encode_stage(spark, docs, FOLDER).count() == len(bodies)
    assert corpus_pipeline.encode_stage(spark, odd_docs.where("false"), FOLDER).count() == 0
