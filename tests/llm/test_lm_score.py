import math
import random
from collections import Counter

import numpy as np

from quillgrid.llm.lm_score import CONTEXTS, NEXT, PAD, SIZE, WindowNetwork, encoded, letter_logs, letters_of, padded, pseudo_likelihood, tokens_of, train, unknown_logs, word_blocks, word_counts
from quillgrid.llm.common import narrow


def network(seed=0):
    net = WindowNetwork(np.random.default_rng(seed).normal(0, 0.3, SIZE).astype(np.float32))
    return net


def test_probabilities_sum_to_one():
    net = network()
    ids = np.full(5, PAD, np.int32)
    total = 0.0
    for word in range(0, 1024):
        ids[2] = word
        total += math.exp(float(net.log_probabilities(ids, np.array([2]))[0]))
    assert abs(total - 1) < 1e-3


def test_slope():
    net = network(1)
    ids, at, _ = encoded(["a b c a d b a c e"], {w: i + 1 for i, w in enumerate("abcde")})
    slope = net.gradient(ids, at)
    picks = np.argsort(-np.abs(slope))[[0, 5, 40]].tolist()
    for k in picks:
        before = net.flat[k]
        net.flat[k] = before + 1e-2
        high = net.log_probabilities(ids, at).astype(np.float64).mean()
        net.flat[k] = before - 1e-2
        low = net.log_probabilities(ids, at).astype(np.float64).mean()
        net.flat[k] = before
        assert abs((high - low) / 2e-2 - slope[k]) < 2e-2 * max(1, abs(slope[k]))


def test_counts_cover_all_texts(documents):
    expected = Counter(w for r in documents.collect() for w in r.text.lower().split())
    got = {r.word: r.n for r in word_counts(word_blocks(narrow(documents, "doc_id", "text"))).collect()}
    assert got == expected


def test_better_than_single_words(documents):
    """Both sides tell more about a word than its frequency does."""
    rows = {r.id: r for r in pseudo_likelihood(documents).collect()}
    texts = {r.doc_id: r.text.lower().split() for r in documents.collect()}
    assert {d: r.n_tokens for d, r in rows.items()} == {d: len(t) for d, t in texts.items()}
    counts = Counter(w for t in texts.values() for w in t)
    known = dict(sorted(counts.items(), key=lambda x: (-x[1], x[0].encode()))[:1023])
    total = sum(counts.values())
    rare = total - sum(known.values())
    single = sum(math.log((known.get(w) or rare) / total) for t in texts.values() for w in t)
    assert sum(r.log_likelihood for r in rows.values()) > single + 0.05 * total


def test_order_of_words_matters(make_docs):
    random.seed(0)
    cycle = "red green blue black white gold".split()
    docs = [(i, " ".join(cycle[(i + k) % 6] for k in range(120))) for i in range(300)]
    mixed = [(1000 + i, " ".join(random.choice(cycle) for _ in range(120))) for i in range(20)]
    rows = {r.id: r.mean_log_likelihood for r in pseudo_likelihood(make_docs(docs + mixed)).collect()}
    assert np.mean([rows[i] for i in range(300)]) > np.mean([rows[1000 + i] for i in range(20)]) + 0.5


def test_odd_rows(odd_docs):
    rows = pseudo_likelihood(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert all((r.mean_log_likelihood is None) == (r.n_tokens == 0) and r.log_likelihood <= 0 for r in rows)
    assert pseudo_likelihood(odd_docs.where("false")).collect() == []


def test_letters_sum_to_one():
    words = ["aba", "é", "x" * 300, "\x00b"]
    cells, first = letters_of(words)
    assert [int(c) % NEXT for c in cells[:4]] == [97, 98, 97, 256] and first.tolist() == [0, 4, 7, 308]
    logs = letter_logs(np.bincount(cells, minlength=CONTEXTS * NEXT)).reshape(CONTEXTS, NEXT)
    assert np.allclose(np.exp(logs).sum(axis=1), 1)


def test_unknown_words_have_their_own_probability(make_docs):
    """1100 frequent words fill the vocabulary; behind it stand prose, a repeated word and random letters."""
    random.seed(1)
    syllables = "ba ra ti on en ing mo le sa ri ve".split()
    rare = sorted({"".join(random.choice(syllables) for _ in range(4)) for _ in range(900)})[:600]
    junk = ["".join(random.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(len(rare[k]))) for k in range(20)]
    common = " ".join(f"w{k}" for k in range(1100))
    docs = [(k, common) for k in range(4)] + [(10 + k, w) for k, w in enumerate(rare)] + [(2000 + k, w) for k, w in enumerate(junk)] + [(3000, "twice"), (3001, "twice x"), (None, "twice"), (None, "twice")]
    frame = make_docs(docs)
    rows = pseudo_likelihood(frame).collect()
    assert len(rows) == len(docs)
    counts = word_counts(word_blocks(narrow(frame, "doc_id", "text")))
    known = {r.word: k for k, r in enumerate(sorted(counts.collect(), key=lambda r: (-r.n, r.word))[:1023], 1)}
    logs = {r.word: r.log_p for r in unknown_logs(counts, known).collect() if not r.known}
    assert not set(logs) & set(known) and len(logs) == counts.count() - 1023 and sum(map(math.exp, logs.values())) <= 1
    texts = {i: t for i, t in docs}
    for r in rows:
        own = [logs[w] for w in texts[r.id].split() if w not in known]
        assert r.n_unknown == len(own) and abs(r.word_log_likelihood - r.log_likelihood - sum(own)) < 1e-6
    value = {r.id: r.mean_word_log_likelihood for r in rows}
    prose = np.mean([value[10 + k] for k in range(len(rare))])
    assert prose > np.mean([value[2000 + k] for k in range(len(junk))]) + 5


def test_blocks_hold_the_texts(odd_docs):
    texts = narrow(odd_docs, "doc_id", "text")
    got = []
    for r in word_blocks(texts).collect():
        sizes = np.array(r.sizes)
        words = [r.words[t] for t in tokens_of(bytes(r.tokens), sizes)]
        ends = np.cumsum(sizes)
        got += [(i, words[e - n:e]) for i, n, e in zip(r.ids, sizes, ends)]
    assert sorted(map(repr, got)) == sorted(repr((r.id, r.text.lower().split())) for r in texts.collect())


def test_padded_is_encoded():
    texts = ["a b c", "", "b", "c c a d"]
    known = {"a": 1, "b": 2, "c": 3}
    ids, at, sizes = encoded(texts, known)
    got, places = padded(np.array([known.get(w, 0) for t in texts for w in t.split()], np.int32), sizes)
    assert got.tolist() == ids.tolist() and places.tolist() == at.tolist()


def test_plain_loop_over_words(spark, documents):
    """log_likelihood recomputed word by word in plain Python from the trained weights."""
    few = documents.orderBy("doc_id").limit(40).cache()
    texts = narrow(few, "doc_id", "text")
    blocks = word_blocks(texts)
    known, flat, _ = train(texts, blocks)
    net = WindowNetwork(flat)
    rows = {r.id: r for r in pseudo_likelihood(few).collect()}
    for r in few.collect()[:6]:
        ids = [PAD, PAD, *(known.get(w, 0) for w in r.text.lower().split()), PAD, PAD]
        total = 0.0
        for k in range(2, len(ids) - 2):
            h = np.tanh(sum(net.words[j][ids[k + o]] for j, o in enumerate((-2, -1, 1, 2))) + net.bias)
            kind, member = divmod(ids[k], 32)
            for logits, pick in ((h @ net.to_class + net.class_bias, kind), (h @ net.to_member[kind] + net.member_bias[kind], member)):
                total += float(logits[pick]) - math.log(sum(math.exp(float(v)) for v in logits))
        assert abs(total - rows[r.doc_id].log_likelihood) < 1e-3 * max(1.0, abs(total))


def test_a_word_of_many_texts_is_sent_once(make_docs):
    words = [f"w{k}" for k in range(100)]
    docs = make_docs([(i, (" ".join(words) + " ") * 3800) for i in range(4)], 1)  # more than 1 MB each
    blocks = word_blocks(narrow(docs, "doc_id", "text"))
    assert blocks.selectExpr("explode(words) AS w").count() == 100


def test_chosen_logs_are_the_shares_logs():
    draw = np.random.default_rng(4)
    h, weights, bias = (draw.normal(size=s).astype(np.float32) * 3 for s in ((50, 16), (16, 32), (32,)))
    target = draw.integers(0, 32, 50)
    logits = (h @ weights + bias).astype(np.float64)
    plain = np.exp(logits) / np.exp(logits).sum(axis=1, keepdims=True)
    assert np.allclose(WindowNetwork.shares(h, weights, bias).T, plain, atol=1e-5)
    assert np.allclose(WindowNetwork.logs_of(h, weights, bias, target), np.log(plain[np.arange(50), target]), atol=1e-4)
