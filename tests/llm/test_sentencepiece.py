import hashlib
import random

import pytest

from quillgrid.llm import sentencepiece_codec
from quillgrid.llm.queries import piece_model
from quillgrid.llm.sentencepiece_codec import Codec, encode, encode_digests


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=piece_model())


@pytest.fixture(scope="module")
def coder():
    return Codec(piece_model())


def ids_of(coder, text):
    return list(memoryview(coder.encode(text)).cast("I"))


def test_random_texts(library, coder):
    random.seed(5)
    alphabets = ["ab ", "the ing er ", "▁ a", " \n\tx", "éüñß ", "①😀中文 a", "\x00\x7f ​", "aA1.,;:!? "]
    for _ in range(3000):
        letters = random.choice(alphabets) + random.choice(alphabets)
        text = "".join(random.choice(letters) for _ in range(random.randint(0, 40)))
        expected = library.encode(text, add_bos=True, add_eos=True)
        assert ids_of(coder, text) == expected, text
        assert coder.decode(expected) == library.decode(expected), text


def test_runs_longer_than_any_piece(library, coder):
    for text in [" " * 100, "a" * 500, "▁" * 70 + "①", "  " + "=" * 200 + "   x"]:
        assert ids_of(coder, text) == library.encode(text, add_bos=True, add_eos=True)


def test_words_and_marks_are_remembered_apart(library):
    coder = Codec(piece_model())
    words = [f"{a}erendes{b}" for a in "abcdefghij" for b in "klmnopqrst"]
    text = " ".join(word + mark for word in words for mark in [",", ".", "!", "?", ";", ":", "...", ".\n", "\n\n", ")."])
    assert ids_of(coder, text) == library.encode(text, add_bos=True, add_eos=True)
    assert len(coder.units) <= len(words) + 20


def test_frequent_units_outlive_a_full_memory(library, monkeypatch):
    monkeypatch.setattr(sentencepiece_codec, "MEMO_UNITS", 100)
    coder, asked = Codec(piece_model()), []
    compute = coder.unit_ids
    monkeypatch.setattr(coder, "unit_ids", lambda unit: asked.append(unit) or compute(unit))
    for k in range(100):
        text = " ".join(["the"] + [f"{'abcdefghij'[k // 10]}{'klmnopqrst'[k % 10]}{'uvwxyzabcdefghijklmn'[i]}erende" for i in range(20)])
        assert ids_of(coder, text) == library.encode(text, add_bos=True, add_eos=True)
    assert asked.count(" the") == 1


def test_small_memories_and_mixed_scripts(library, monkeypatch):
    for name, bound in [("MEMO_UNITS", 6), ("MEMO_LENGTH", 5), ("MEMO_PAIRS", 9), ("MEMO_STEPS", 7)]:
        monkeypatch.setattr(sentencepiece_codec, name, bound)
    coder = Codec(piece_model())
    random.seed(7)
    parts = ["the", "ing", "Über", "это", "ский", "ال", "据数", "取获", "一个", "══", "──", "12", "7", ".", "!!", "\n", "\t", " ", "  ", "▁", "€", "😀", "İ", "\r", "]", "^", "\\", "-"]
    for _ in range(3000):
        text = "".join(random.choice(parts) for _ in range(random.randint(1, 15)))
        assert ids_of(coder, text) == library.encode(text, add_bos=True, add_eos=True), text
    assert len(coder.units) <= 3 and len(coder.units.older) <= 3 and max(map(len, coder.units)) <= 5


def test_decoding_of_any_ids(library, coder):
    random.seed(6)
    size = library.get_piece_size()
    for _ in range(3000):
        ids = [random.choice([random.randrange(size), random.randrange(3, 259)]) for _ in range(random.randint(0, 8))]
        assert coder.decode(ids) == library.decode(ids), ids


def test_documents(documents, library):
    texts = {r.doc_id: r.text for r in documents.collect()}
    result = encode_digests(documents, piece_model()).collect()
    assert len(result) == len(texts)
    for r in result:
        ids = library.encode(texts[r.id], add_bos=True, add_eos=True)
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(raw).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_odd_rows(odd_docs, library):
    result = sorted((r.id or -1, bytes(r.tokens), r.decoded) for r in encode(odd_docs, piece_model()).collect())
    expected = []
    for r in odd_docs.collect():
        ids = library.encode(r.text or "", add_bos=True, add_eos=True)
        expected.append((r.doc_id or -1, b"".join(i.to_bytes(4, "little") for i in ids), library.decode(ids)))
    assert result == sorted(expected)


def test_empty_table(odd_docs):
    assert encode(odd_docs.where("false"), piece_model()).collect() == []
