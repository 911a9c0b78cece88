import __spark_entry__
import check_oracle
import pytest

from quillgrid.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


def test_all_are_registered():
    names = __spark_entry__.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names
    assert set(ORACLES) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, name, monkeypatch):
    monkeypatch.setitem(check_oracle.QUERIES, name, QUERIES[name])
    monkeypatch.setitem(check_oracle.ORACLES, name, ORACLES[name])
    assert check_oracle.compare(spark, FOLDER, name, check_oracle.connect(FOLDER)) is None


@pytest.mark.parametrize("name, columns", [
    ("op1_semi_markov_pii", ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]),
    ("op3_circulant_minhash", ["doc_id", "n_shingles", "component_id", "kept"]),
    ("op4_prefix_free_parsing", ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]),
    ("op7_sentencepiece", ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]),
    ("op8_exact_dedup", ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]),
    ("op9_page_differencing", ["page_id", "url", "text", "n_chars"]),
    ("op10_toxicity", ["doc_id", "held_out", "score", "predicted"]),
    ("op11_merkle_manifest", ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]),
    ("op12_line_dedup", ["doc_id", "n_lines", "n_dropped", "kept_sha256"]),
])
def test_one_row_per_row(spark, name, columns):
    frame = QUERIES[name](spark, FOLDER)
    assert frame.columns == columns
    assert frame.count() == spark.read.parquet(f"{FOLDER}/{'pages' if 'page_id' in columns else 'documents'}.parquet").count()
