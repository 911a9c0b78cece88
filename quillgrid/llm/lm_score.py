"""Masked pseudo-likelihood of documents under a bidirectional window network.

The network sees two words on each side and predicts the word between them; its output is
factored into a class and a member of the class, so every probability is normalised at the cost
of two short rows. It is trained in numpy: a bounded sample gives the start, then every task runs
through all of its documents and the tasks' weights are averaged by their numbers of words. The
score of a document sums the log probability of every word given both sides.

To the network all words but the most frequent are one. Which of them a word is has a probability
of its own, from the counts of all words and from a model of letters; a second score has both.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written_table
from .common import arrow_schema, in_tasks, narrow

CLASSES, MEMBERS, HIDDEN = 32, 32, 16
VOCABULARY = CLASSES * MEMBERS
PAD = VOCABULARY
OFFSETS = (-2, -1, 1, 2)
STEP = 1 << 14  # words per step
BLOCK_CHARS, BLOCK_ROWS = 1 << 24, 40_000  # texts of together so many characters or rows, or one long text
BLOCK_SHAPE = "ids array<long>, sizes array<int>, tokens binary, words array<string>, times array<long>"
SAMPLE_BYTES = 1 << 16  # longer texts do not serve for the start, so the sample is bounded
SHAPES = (
    ("words", (len(OFFSETS), VOCABULARY + 1, HIDDEN)), ("bias", (HIDDEN,)), ("to_class", (HIDDEN, CLASSES)), ("class_bias", (CLASSES,)),
    ("to_member", (CLASSES, HIDDEN, MEMBERS)), ("member_bias", (CLASSES, MEMBERS)),
)
SIZE = sum(int(np.prod(shape)) for _, shape in SHAPES)
BLOCK = 4096
CONTEXTS, NEXT, END = 4096, 257, 256  # the byte before and four bits of the one before that; bytes and the end
PRIOR = 16.0


class WindowNetwork:
    """Weights as one vector and as views of it."""

    def __init__(self, flat: np.ndarray):
        self.flat, at = flat, 0
        for name, shape in SHAPES:
            size = int(np.prod(shape))
            setattr(self, name, flat[at:at + size].reshape(shape))
            at += size

    @classmethod
    def fresh(cls, shares: np.ndarray) -> "WindowNetwork":
        """Small random weights; the output biases start at the words' shares."""
        net = cls(np.random.default_rng(17).normal(0.0, 0.1, SIZE).astype(np.float32))
        table = np.log(shares + 1e-7).reshape(CLASSES, MEMBERS)
        whole = np.log(np.exp(table).sum(axis=1))
        net.bias[:], net.class_bias[:], net.member_bias[:] = 0.0, whole, table - whole[:, None]
        return net

    def hidden(self, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
        x = self.words[0][ids[at + OFFSETS[0]]]
        for k, offset in enumerate(OFFSETS[1:], 1):
            x += self.words[k][ids[at + offset]]
        return np.tanh(x + self.bias)

    @staticmethod
    def shares(h: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
        """Probabilities, a column per row of ``h``: sums over the first axis are quick."""
        out = weights.T @ h.T
        out += bias[:, None]
        out -= out.max(axis=0)
        np.exp(out, out=out)
        out /= out.sum(axis=0)
        return out

    @staticmethod
    def logs_of(h: np.ndarray, weights: np.ndarray, bias: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Log probability of each row's own target."""
        out = weights.T @ h.T
        out += bias[:, None]
        out -= out.max(axis=0)
        own = out[target, np.arange(len(target))]
        np.exp(out, out=out)
        return own - np.log(out.sum(axis=0))

    def log_probabilities(self, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
        """log P(word | both sides) of the words at the places ``at``."""
        out = np.empty(len(at), np.float32)
        for start in range(0, len(at), STEP):
            places = at[start:start + STEP]
            h, target = self.hidden(ids, places), ids[places]
            kind, member = target // MEMBERS, target % MEMBERS
            value = self.logs_of(h, self.to_class, self.class_bias, kind)
            order = np.argsort(kind.astype(np.uint8), kind="stable")
            edges = np.searchsorted(kind[order], np.arange(CLASSES + 1))
            for c in range(CLASSES):
                rows = order[edges[c]:edges[c + 1]]
                if len(rows):
                    value[rows] += self.logs_of(h[rows], self.to_member[c], self.member_bias[c], member[rows])
            out[start:start + STEP] = value
        return out

    def gradient(self, ids: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Mean slope of the log probabilities, as one vector."""
        slope = WindowNetwork(np.zeros(SIZE, np.float32))
        h, target = self.hidden(ids, places), ids[places]
        kind, member = target // MEMBERS, target % MEMBERS
        error = -self.shares(h, self.to_class, self.class_bias)
        error[kind, np.arange(len(places))] += 1
        slope.to_class[:], slope.class_bias[:] = (error @ h).T, error.sum(axis=1)
        back = error.T @ self.to_class.T
        order = np.argsort(kind.astype(np.uint8), kind="stable")
        edges = np.searchsorted(kind[order], np.arange(CLASSES + 1))
        for c in range(CLASSES):
            rows = order[edges[c]:edges[c + 1]]
            if len(rows):
                part = h[rows]
                error = -self.shares(part, self.to_member[c], self.member_bias[c])
                error[member[rows], np.arange(len(rows))] += 1
                slope.to_member[c], slope.member_bias[c] = (error @ part).T, error.sum(axis=1)
                back[rows] += error.T @ self.to_member[c].T
        back *= 1 - h * h
        slope.bias[:] = back.sum(axis=0)
        for k, offset in enumerate(OFFSETS):
            seen = ids[places + offset]
            order = np.argsort(seen.astype(np.uint16), kind="stable")
            sorted_ids = seen[order]
            first = np.flatnonzero(np.concatenate([[True], sorted_ids[1:] != sorted_ids[:-1]]))
            slope.words[k][sorted_ids[first]] = np.add.reduceat(back[order], first, axis=0)
        return slope.flat / len(places)


class Trainer:
    """Steps scaled by the gathered squares of each weight's slope."""

    def __init__(self, flat: np.ndarray, rate: float):
        self.net, self.rate, self.seen = WindowNetwork(flat.copy()), rate, 0
        self.squares = np.full(SIZE, 1e-6, np.float32)

    def learn(self, ids: np.ndarray, at: np.ndarray) -> None:
        for start in range(0, len(at), STEP):
            slope = self.net.gradient(ids, at[start:start + STEP])
            self.squares += slope * slope
            self.net.flat += self.rate * slope / np.sqrt(self.squares)
        self.seen += len(at)


def encoded(texts: Iterable[str], known: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word ids of texts with pads around each, the places of the words, and the words per text."""
    get, edge, parts, counts = known.get, [PAD, PAD], [], []
    for text in texts:
        words = text.lower().split()
        parts.append(edge)
        parts.append([get(w, 0) for w in words])
        counts.append(len(words))
    parts.append(edge)
    ids = np.concatenate([np.array(p, np.int32) for p in parts])
    return ids, np.flatnonzero(ids != PAD), np.array(counts, np.int64)


def word_blocks(texts: DataFrame) -> DataFrame:
    """(block, ids, sizes, tokens, words, times): consecutive texts with their words as numbers.

    A block has each of its words once, with its number of occurrences; tokens are places in that
    list, as 32-bit numbers, compressed. So every text is split into words once, and what is known of
    a word later travels to a block once, however often the block has it.
    """
    schema = arrow_schema(BLOCK_SHAPE)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", compression_level=1)
        ids: list[int | None] = []
        sizes: list[int] = []
        parts: list[np.ndarray] = []
        number: dict[str, int] = {}
        chars = 0

        def out() -> pa.RecordBatch:
            tokens = np.concatenate(parts)
            times = np.bincount(tokens, minlength=len(number))
            raw = tokens.tobytes()
            columns = [ids, sizes, codec.compress(raw, asbytes=True) if raw else b"", list(number), times]
            return pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(columns, schema)], schema=schema)

        for batch in batches:
            for doc, text in zip(batch.column("id").to_pylist(), batch.column("text")):
                text = text.as_py()
                words = text.lower().split()
                parts.append(np.fromiter((number.setdefault(w, len(number)) for w in words), np.uint32, len(words)))
                ids.append(doc)
                sizes.append(len(words))
                chars += len(text)
                if chars >= BLOCK_CHARS or len(ids) >= BLOCK_ROWS:
                    yield out()
                    ids, sizes, parts, number, chars = [], [], [], {}, 0
        if ids:
            yield out()

    made = in_tasks(texts.select("id", "text"), run, BLOCK_SHAPE)
    return written_table(made.withColumn("block", F.monotonically_increasing_id()), "word-blocks")


def tokens_of(packed: bytes, sizes: np.ndarray) -> np.ndarray:
    size = int(sizes.sum())
    return np.frombuffer(pa.Codec("zstd").decompress(packed, size * 4, asbytes=True) if size else b"", np.uint32)


def padded(ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word ids with two pads around each text, and the places of the words; as ``encoded`` gives them."""
    at = np.arange(len(ids)) + 2 * (1 + np.repeat(np.arange(len(sizes)), sizes))
    out = np.full(len(ids) + 2 * (len(sizes) + 1), PAD, np.int32)
    out[at] = ids
    return out, at


def word_counts(blocks: DataFrame) -> DataFrame:
    """(word, n) over all blocks."""
    each = blocks.select(F.explode(F.arrays_zip("words", "times")).alias("w"))
    return each.select(F.col("w.words").alias("word"), F.col("w.times").alias("n")).groupBy("word").agg(F.sum("n").alias("n"))


def blocks_of(texts: Iterable[str], size: int = 1 << 21) -> Iterator[list[str]]:
    """Consecutive texts of together ``size`` characters or one long text."""
    held, total = [], 0
    for text in texts:
        held.append(text)
        total += len(text)
        if total >= size:
            yield held
            held, total = [], 0
    if held:
        yield held


def averaged(blocks: DataFrame, known: dict[str, int], start: np.ndarray, rate: float) -> np.ndarray:
    """Train on every document of every task from ``start``; the mean of the tasks' weights.

    The tasks' vectors are summed in blocks on the executors, in two levels, so neither a task
    nor the driver receives a number of vectors that grows with the corpus.
    """

    def train(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer, mark = Trainer(start, rate), 0
        for batch in batches:
            for packed, sizes, words in zip(batch.column("tokens"), batch.column("sizes"), batch.column("words")):
                sizes = sizes.values.to_numpy()
                own = np.array([known.get(w, 0) for w in words.as_py()], np.int32)
                ids, at = padded(own[tokens_of(packed.as_py(), sizes)], sizes)
                trainer.learn(ids, at)
                mark = (mark * 31 + len(at)) % 1_000_003
        if trainer.seen:
            weighted = trainer.net.flat.astype(np.float64) * trainer.seen
            blocks = [weighted[k:k + BLOCK].tobytes() for k in range(0, SIZE, BLOCK)]
            yield pa.RecordBatch.from_pydict({
                "block": pa.array(range(len(blocks)), pa.int32()), "salt": pa.array([mark % 64] * len(blocks), pa.int32()),
                "seen": pa.array([trainer.seen] * len(blocks), pa.int64()), "total": pa.array(blocks, pa.binary()),
            })

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(b.as_py(), np.float64) for b in table["total"])
        return pa.table({
            "block": table["block"][:1], "salt": table["salt"][:1], "seen": pa.array([sum(table["seen"].to_pylist())], pa.int64()),
            "total": pa.array([total.tobytes()], pa.binary()),
        })

    shape = "block int, salt int, seen long, total binary"
    vectors = in_tasks(blocks.select("tokens", "sizes", "words"), train, shape)
    summed = vectors.groupBy("block", "salt").applyInArrow(add, shape).groupBy("block").applyInArrow(add, shape)
    rows = summed.orderBy("block").collect()  # one vector
    if not rows:
        return start
    whole = np.concatenate([np.frombuffer(r.total, np.float64) for r in rows])
    return (whole / rows[0].seen).astype(np.float32)


def letters_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(cell of each byte and end of the words, first place of each word); a cell is context and byte."""
    raw = [w.encode("utf-8", "surrogatepass") for w in words]
    sizes = np.array([len(r) + 3 for r in raw], np.int64)
    ends = np.cumsum(sizes) - 1
    codes = np.frombuffer(b"".join(b"\0\0" + r + b"\0" for r in raw), np.uint8).astype(np.int32)
    codes[ends] = END
    wanted = np.ones(len(codes), bool)
    wanted[ends - sizes + 1] = wanted[ends - sizes + 2] = False
    at = np.flatnonzero(wanted)
    cells = (codes[at - 1] * 16 + (codes[at - 2] & 15)) * NEXT + codes[at]
    return cells, np.concatenate([[0], np.cumsum(sizes - 2)[:-1]])


def letter_logs(cells: np.ndarray) -> np.ndarray:
    """log P(byte or end | context) of all cells from their counts, smoothed by the bytes' shares."""
    table = cells.reshape(CONTEXTS, NEXT).astype(np.float64)
    shares = (table.sum(axis=0) + 1) / (table.sum() + NEXT)
    return np.log((table + PRIOR * shares) / (table.sum(axis=1, keepdims=True) + PRIOR)).ravel()


def unknown_logs(counts: DataFrame, known: dict[str, int]) -> DataFrame:
    """(word, known, log_p) of every counted word: its id and 0, or 0 and log P(word | unknown).

    Each word gives up one of its occurrences; what all have given up is dealt by the letters, so a
    word seen once has the probability of its spelling, and all words together have one. Only the
    counts of the cells are gathered, whose number is fixed.
    """
    strange = lambda batch: [(w, n) for w, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()) if w not in known]
    cell_schema = arrow_schema("cell int, n long, words long, total long")

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, words, total = np.zeros(CONTEXTS * NEXT, np.int64), 0, 0
        for batch in batches:
            if rows := strange(batch):
                cells += np.bincount(letters_of([w for w, _ in rows])[0], minlength=len(cells))
                words, total = words + len(rows), total + sum(n for _, n in rows)
        used = np.flatnonzero(cells)
        if len(used):
            rest = np.zeros(len(used), np.int64)
            columns = [used, cells[used], rest.copy(), rest.copy()]
            columns[2][0], columns[3][0] = words, total
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, cell_schema)], schema=cell_schema)

    found = in_tasks(counts, count, "cell int, n long, words long, total long")
    sums = found.groupBy("cell").agg(F.sum("n").alias("n"), F.sum("words").alias("words"), F.sum("total").alias("total")).toArrow()
    cells = np.zeros(CONTEXTS * NEXT, np.int64)
    cells[sums["cell"].to_numpy()] = sums["n"].to_numpy()
    n_words, total = int(sums["words"].to_numpy().sum()), int(sums["total"].to_numpy().sum())
    logs = letter_logs(cells).astype(np.float32)
    shape = "word string, known int, log_p double"
    schema = arrow_schema(shape)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            words, n = batch.column("word").to_pylist(), batch.column("n").to_numpy().astype(np.float64)
            ids = np.array([known.get(w, 0) for w in words], np.int32)
            at, first = letters_of(words)
            spelled = np.add.reduceat(logs[at].astype(np.float64), first)
            with np.errstate(divide="ignore"):
                value = np.logaddexp(np.log((n - 1) / max(total, 1)), np.log(max(n_words, 1) / max(total, 1)) + spelled)
            value[ids > 0] = 0.0
            yield pa.RecordBatch.from_arrays([batch.column("word"), pa.array(ids), pa.array(value)], schema=schema)

    return in_tasks(counts, score, shape)


def train(texts: DataFrame, blocks: DataFrame, sample_docs: int = 400, sample_rounds: int = 4) -> tuple[dict[str, int], np.ndarray, DataFrame]:
    """(word ids, weights, counts of all words). Words and weights come from all texts; only the start is fitted on at
    most ``sample_docs`` texts of up to SAMPLE_BYTES bytes, chosen by a hash of the id."""
    counts = written_table(word_counts(blocks), "word-counts")
    top = counts.orderBy(F.desc("n"), "word").limit(VOCABULARY - 1).collect()
    known = {r.word: k for k, r in enumerate(top, 1)}
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    shares = np.full(VOCABULARY, 0.0)
    shares[1:len(top) + 1] = [r.n / total for r in top]
    shares[0] = max(0.0, 1.0 - shares.sum())
    flat = WindowNetwork.fresh(shares).flat
    # the ids are chosen first, so no task sends texts that another task's hash pushes out
    keyed = texts.where(F.octet_length("text") <= SAMPLE_BYTES).select("id", "text", F.xxhash64("text").alias("h"))
    chosen = written_table(keyed.select("id", "h").orderBy(F.xxhash64("id"), "h").limit(sample_docs), "lm-sample")
    own = F.broadcast(chosen.select(F.col("id").alias("own_id"), F.col("h").alias("own_h")).distinct())  # sample_docs rows
    sample = keyed.join(own, F.col("id").eqNullSafe(F.col("own_id")) & (F.col("h") == F.col("own_h")), "left_semi")
    held = sorted(r.text for r in sample.dropDuplicates(["id", "h"]).collect())
    trainer = Trainer(flat, 0.1)
    for _ in range(sample_rounds):
        for part in blocks_of(held, 1 << 18):
            ids, at, _ = encoded(part, known)
            trainer.learn(ids, at)
    return known, averaged(blocks, known, trainer.net.flat, 0.05), counts


def pseudo_likelihood(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_tokens, log_likelihood (a sum), mean_log_likelihood, n_unknown,
    word_log_likelihood (a sum), mean_word_log_likelihood.

    Words are what white space separates, in lower case. In log_likelihood the words outside the
    vocabulary share one id and are predicted like any other; word_log_likelihood adds log P(word |
    unknown) for each of these n_unknown words, so every word's own probability is in it. Null and
    blank texts have no token, the sums 0 and null means. Null ids, repeated rows and extra columns
    change nothing; an empty table gives no rows.
    """
    texts = narrow(docs, id_col, text_col)
    blocks = word_blocks(texts)
    known, flat, counts = train(texts, blocks)
    shape = "id long, n_tokens long, log_likelihood double, n_unknown long, word_log_likelihood double"
    schema = arrow_schema(shape)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = WindowNetwork(flat)
        sums = lambda values, ends, sizes: (lambda c: c[ends] - c[ends - sizes])(np.concatenate([[0], np.cumsum(values)]))
        for batch in batches:
            for docs_of, packed, sizes, found in zip(*(batch.column(c) for c in ("ids", "tokens", "sizes", "found"))):
                sizes = sizes.values.to_numpy().astype(np.int64)
                tokens, ends = tokens_of(packed.as_py(), sizes), np.cumsum(sizes)
                if len(tokens):
                    words = found.values
                    place = words.field("place").to_numpy()
                    own, own_logs = np.empty(len(place), np.int32), np.empty(len(place))
                    own[place], own_logs[place] = words.field("known").to_numpy(), words.field("log_p").to_numpy()
                    word_ids = own[tokens]
                    ids, at = padded(word_ids, sizes)
                    score = sums(net.log_probabilities(ids, at).astype(np.float64), ends, sizes)
                    unknown, spelled = sums((word_ids == 0).astype(np.int64), ends, sizes), sums(own_logs[tokens], ends, sizes)
                else:
                    score, unknown, spelled = np.zeros(len(sizes)), np.zeros(len(sizes), np.int64), np.zeros(len(sizes))
                columns = [docs_of.values, sizes, score, unknown, score + spelled]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    each = blocks.select("block", F.posexplode("words").alias("place", "word"))
    # one row per block and word; a block's list is as long as its number of different words
    found = each.join(unknown_logs(counts, known), "word").groupBy("block").agg(F.collect_list(F.struct("place", "known", "log_p")).alias("found"))
    joined = blocks.select("block", "ids", "sizes", "tokens").join(found, "block", "left").drop("block")
    scored = in_tasks(joined, run, shape)
    mean = lambda name: F.when(F.col("n_tokens") > 0, F.col(name) / F.col("n_tokens")).alias(f"mean_{name}")
    return scored.select("id", "n_tokens", "log_likelihood", mean("log_likelihood"), "n_unknown", "word_log_likelihood", mean("word_log_likelihood"))
