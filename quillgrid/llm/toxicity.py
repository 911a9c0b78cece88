"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

A bounded sample of labelled rows teaches a lexicon (words and word stems that toxic documents
share and clean ones lack), then the trees, then the calibration. Every whole text is scored in
one pass of the scan; nothing is shuffled for it.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written_table
from .common import in_tasks, narrow, per_batch, without_ids

# Words for the person spoken to, and signs that stand for letters.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deiner ihr euch euer tu te toi ton ta tes vous votre vos "
    "usted ustedes tú ti tuyo vosotros".split()
)
LOOKALIKE = str.maketrans("013457@$!|", "oieastasii")

WORD = re.compile(r"[^\W\d_]+")
BLANK, LETTER, DIGIT, SIGN, OTHER = range(5)
KIND_OF_BYTE = np.full(256, OTHER, np.uint8)  # bytes of other scripts count as letters
KIND_OF_BYTE[:33] = BLANK
for _low, _high, _kind in ((48, 57, DIGIT), (65, 90, LETTER), (97, 122, LETTER), (128, 255, LETTER)):
    KIND_OF_BYTE[_low:_high + 1] = _kind
KIND_OF_BYTE[[ord(c) for c in "@$!|*._-"]] = SIGN  # signs that may stand inside a disguised word
STEMS = (4, 5, 6, 7)

FEATURES = (
    "lexicon_count", "lexicon_density", "lexicon_weight", "lexicon_kinds", "near_second_person", "second_person_density",
    "capital_rate", "shouted_density", "exclamation_rate", "question_rate", "run_density", "symbol_rate",
    "mixed_density", "hidden_lexicon_density", "stretched_density", "log_words",
)


def word_keys(text: str) -> set[str]:
    """Words of a text and, marked with ``*``, the stems of its words."""
    words = set(WORD.findall(text.lower()))
    return words | {f"{w[:k]}*" for w in words for k in STEMS if len(w) >= k}


class Lexicon:
    """Finds weighted words and stems at word starts, and words of address; built once per batch."""

    def __init__(self, weights: dict[str, float]):
        self.weights = weights
        self.machine = ahocorasick.Automaton()
        for word in SECOND_PERSON:
            self.machine.add_word(f" {word} ", (len(word) + 2, True, 0.0, ""))
        for key, weight in weights.items():
            self.machine.add_word(key.rstrip("*"), (len(key.rstrip("*")), key.endswith("*"), weight, key))
        self.machine.make_automaton()

    def hits(self, lowered: str) -> tuple[list[tuple[int, float, str]], list[int]]:
        """(start, weight, key) of each hit, of hits with one start the heaviest; places of words of address."""
        found: dict[int, tuple[float, str]] = {}
        persons: list[int] = []
        lowered = f" {lowered} "
        size = len(lowered)
        for end, (length, stem, weight, key) in self.machine.iter(lowered):
            start = end - length + 1
            if not key:
                persons.append(start)
                continue
            if start and lowered[start - 1].isalpha():
                continue
            if not stem and end + 1 < size and lowered[end + 1].isalpha():
                continue
            if start not in found or weight > found[start][0]:
                found[start] = (weight, key)
        return [(start, *found[start]) for start in sorted(found)], persons


def runs(mask: np.ndarray, least: int) -> int:
    """Number of runs of at least ``least`` true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
    return int(np.count_nonzero(edges[1::2] - edges[::2] >= least))


def disguised(raw: np.ndarray, kinds: np.ndarray) -> list[str]:
    """Words with digits or signs between letters, and letters spelled out with single gaps."""
    letter = kinds == LETTER
    inner = (kinds == DIGIT) | (kinds == SIGN)
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inner, [False]]).astype(np.int8)))
    first, after = edges[::2], edges[1::2]
    inside = (first > 0) & (after < len(raw))
    first, after = first[inside], after[inside]
    between = letter[first - 1] & letter[after]
    out, reached = [], -1
    for at in first[between].tolist():
        if at < reached:
            continue
        low, high = at, at
        while low and kinds[low - 1] in (LETTER, DIGIT, SIGN):
            low -= 1
        while high < len(raw) and kinds[high] in (LETTER, DIGIT, SIGN):
            high += 1
        reached = high
        out.append(raw[low:high].tobytes().decode("utf-8", "ignore"))
    if len(raw) >= 7:
        gap = (raw == 32) | (raw == 46) | (raw == 45)
        spelled = letter[:-6] & gap[1:-5] & letter[2:-4] & gap[3:-3] & letter[4:-2] & gap[5:-1] & letter[6:]
        spelled[1:] &= ~letter[:-7]
        reached = -1
        for at in np.flatnonzero(spelled).tolist():
            if at < reached:
                continue
            high = at + 7
            while high + 1 < len(raw) and gap[high] and letter[high + 1]:
                high += 2
            reached = high
            out.append(raw[at:high].tobytes().decode("utf-8", "ignore"))
    return out


def features(text: str, lexicon: Lexicon) -> list[float]:
    """The dense features of one whole text, in the order of FEATURES."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    kinds = KIND_OF_BYTE[raw]
    counts = np.bincount(raw, minlength=256)
    solid = kinds != BLANK
    words = max(1, int(np.count_nonzero(solid[1:] & ~solid[:-1])) + int(len(raw) and solid[0]))
    letters = max(1, int(counts[65:91].sum() + counts[97:123].sum()))
    hits, persons = lexicon.hits(text.lower())
    near = 0
    if hits and persons:
        starts, addressed = np.array([h[0] for h in hits]), np.array(persons)
        place = np.searchsorted(addressed, starts)
        before = np.abs(starts - addressed[np.maximum(place - 1, 0)])
        behind = np.abs(addressed[np.minimum(place, len(addressed) - 1)] - starts)
        near = int(np.count_nonzero(np.minimum(before, behind) <= 30))
    mixed = disguised(raw, kinds)
    hidden = 0
    for token in mixed:
        token = token.lower()
        plain = re.sub(r"[^\w]|_", "", token.translate(LOOKALIKE))
        hidden += bool(lexicon.hits(plain)[0]) and not lexicon.hits(token)[0]
    marks = (kinds == SIGN) | (kinds == OTHER)
    capitals = (raw >= 65) & (raw <= 90)
    bangs = (raw == 33) | (raw == 63)
    same = (raw[1:] == raw[:-1]) & (kinds[1:] == LETTER)
    return [
        float(len(hits)), len(hits) / words, sum(w for _, w, _ in hits), float(len({k for _, _, k in hits})),
        float(near), len(persons) / words,
        float(np.count_nonzero(capitals)) / letters, runs(capitals, 3) / words,
        float(counts[33]) / words, float(counts[63]) / words, (runs(bangs, 2) + runs(marks, 3)) / words,
        float(np.count_nonzero(marks)) / words,
        len(mixed) / words, hidden / words, runs(same, 3) / words, math.log(words),
    ]


@dataclass
class Trees:
    """Boosted regression trees on the logistic loss; a tree is a list of (feature, cut, left, right, value)."""

    start: float = 0.0
    rate: float = 0.2
    trees: list[list[tuple]] = field(default_factory=list)

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for tree in self.trees:
            at = np.zeros(len(x), np.int64)
            leaf = np.zeros(len(x), bool)
            columns = [np.array(c) for c in zip(*tree)]
            while not leaf.all():
                feature = columns[0][at]
                leaf = feature < 0
                go = np.where(x[np.arange(len(x)), np.maximum(feature, 0)] <= columns[1][at], columns[2][at], columns[3][at])
                at = np.where(leaf, at, go)
            out += self.rate * columns[4][at]
        return out


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 3, bins: int = 32, least: int = 5) -> Trees:
    """Fit the trees on at most ``bins`` cuts per feature, taken at quantiles of its values."""
    share = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
    model = Trees(math.log(share / (1 - share)))
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[:-1])) for j in range(x.shape[1])]
    coded = [np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)]
    margin = np.full(len(y), model.start)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        slope, bend = y - p, p * (1 - p)
        tree: list[tuple] = [(-1, 0.0, 0, 0, 0.0)]
        waiting = [(0, np.arange(len(y)), depth)]
        while waiting:
            node, rows, left = waiting.pop()
            g, h = slope[rows].sum(), bend[rows].sum()
            best = (1e-6, -1, 0)
            if left and len(rows) >= 2 * least:
                for j, c in enumerate(cuts):
                    code = coded[j][rows]
                    gs, hs, ns = (np.cumsum(np.bincount(code, w, len(c) + 1))[:-1] for w in (slope[rows], bend[rows], None))
                    gain = gs**2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1) - g**2 / (h + 1)
                    gain[(ns < least) | (len(rows) - ns < least)] = 0
                    if len(gain) and gain.max() > best[0]:
                        best = (float(gain.max()), j, int(gain.argmax()))
            tree[node] = (-1, 0.0, 0, 0, float(g / (h + 1)))
            if best[1] >= 0:
                j, cut = best[1], best[2]
                low = coded[j][rows] <= cut
                tree += [(-1, 0.0, 0, 0, 0.0)] * 2
                tree[node] = (j, float(cuts[j][cut]), len(tree) - 2, len(tree) - 1, 0.0)
                waiting += [(len(tree) - 2, rows[low], left - 1), (len(tree) - 1, rows[~low], left - 1)]
        model.trees.append(tree)
        margin += Trees(0.0, model.rate, [tree]).raw(x)
    return model


def isotonic(margin: np.ndarray, y: np.ndarray) -> tuple[list[float], list[float]]:
    """Pool adjacent violators: knots (margin, share of label 1) of a rising step curve."""
    pools: list[list[float]] = []
    for m, label in sorted(zip(margin.tolist(), y.tolist())):
        pools.append([m, m, label, 1.0])
        while len(pools) > 1 and (pools[-2][2] / pools[-2][3] >= pools[-1][2] / pools[-1][3] or pools[-2][1] == pools[-1][0]):
            low, high = pools[-2], pools.pop()
            pools[-1] = [low[0], high[1], low[2] + high[2], low[3] + high[3]]
    knots = [(m, p[2] / p[3]) for p in pools for m in ((p[0], p[1]) if p[1] > p[0] else (p[0],))]
    return [k[0] for k in knots], [k[1] for k in knots]


@dataclass
class ToxicityModel:
    lexicon: dict[str, float]
    trees: Trees
    knots: tuple[list[float], list[float]]

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probabilities; a thousandth of the plain logistic keeps the order inside a step."""
        margin = self.trees.raw(x)
        steps = np.interp(margin, *self.knots) if self.knots[0] else np.full(len(x), 0.0)
        return 0.999 * steps + 0.001 / (1 + np.exp(-margin))


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int) -> DataFrame:
    """(id, text, toxic) of at most ``max_rows`` labelled documents, chosen by a hash of the id.

    Repeated labels of a document count as toxic if one of them does; null ids and labels are left out.
    """
    chosen = (
        labels.where("id IS NOT NULL AND toxic IS NOT NULL").groupBy("id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("id"), "id").limit(max_rows)
    )
    # bounded by max_rows rows of two numbers
    return written_table(docs.join(F.broadcast(chosen), "id"), "toxic-sample")


def learn_lexicon(rows: DataFrame, toxic: int, clean: int, least_share: float = 0.01, max_keys: int = 400) -> dict[str, float]:
    """Words and stems with a significant excess in toxic documents, weighted by log odds."""

    def counts(batch: dict[str, list]) -> dict[str, list]:
        seen = Counter(), Counter()
        for text, label in zip(batch["text"], batch["toxic"]):
            seen[label > 0].update(word_keys(text))
        keys = list(seen[1])  # a key without a toxic document never enters the lexicon
        return {"key": keys, "bad": [seen[1][k] for k in keys], "good": [seen[0][k] for k in keys]}

    def clean_counts(batch: dict[str, list]) -> dict[str, list]:
        seen: Counter = Counter()
        for text, label in zip(batch["text"], batch["toxic"]):
            if label <= 0:
                seen.update(word_keys(text) & wanted)
        return {"key": list(seen), "good": list(seen.values())}

    least = max(3, int(least_share * toxic))
    bad = per_batch(rows.where("toxic > 0"), "key string, bad long, good long", counts)
    frequent = bad.groupBy("key").agg(F.sum("bad").alias("bad")).where(F.col("bad") >= least)
    # a key in at least 1 % of the toxic documents: their number is bounded by the words of a hundred documents
    found = {r.key: r.bad for r in frequent.orderBy(F.desc("bad"), "key").limit(200_000).collect()}
    wanted = set(found)
    good = per_batch(rows.where("toxic <= 0"), "key string, good long", clean_counts).groupBy("key").agg(F.sum("good").alias("good"))
    lacking = {r.key: r.good for r in good.collect()}
    scored = []
    for key, a in found.items():
        b = lacking.get(key, 0)
        odds = math.log((a + 0.5) / (toxic + 1)) - math.log((b + 0.5) / (clean + 1))
        share = (a + b) / (toxic + clean)
        excess = 2 * (a * math.log(a / (toxic * share)) + (b * math.log(b / (clean * share)) if b else 0.0))
        if odds >= math.log(20) and excess >= 15:
            scored.append((-excess, key, odds))
    return {key: odds for _, key, odds in sorted(scored)[:max_keys]}


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000) -> ToxicityModel:
    """Fit on at most ``max_rows`` labelled documents; four fifths for the trees, the rest for the calibration."""
    rows = training_rows(docs, labels, max_rows)
    size = {bool(r.bad): r["count"] for r in rows.groupBy((F.col("toxic") > 0).alias("bad")).count().collect()}
    toxic, clean = size.get(True, 0), size.get(False, 0)
    if not toxic or not clean:
        return ToxicityModel({}, Trees(-20.0 if not toxic else 20.0), ([], []) if not toxic else ([0.0], [1.0]))
    weights = learn_lexicon(rows, toxic, clean)

    def measure(batch: dict[str, list]) -> dict[str, list]:
        lexicon = Lexicon(weights)
        return {
            "id": batch["id"], "toxic": [int(t > 0) for t in batch["toxic"]],
            "x": [features(t, lexicon) for t in batch["text"]],
        }

    # max_rows rows of a few numbers
    table = per_batch(rows, "id long, toxic int, x array<double>", measure).toArrow().sort_by("id")
    x = np.array(table["x"].to_pylist())
    y = np.array(table["toxic"].to_pylist(), float)
    for_curve = np.arange(len(y)) % 5 == 4
    if y[for_curve].sum() < 5 or y[~for_curve].sum() < 5:
        for_curve[:] = False
    trees = boost(x[~for_curve], y[~for_curve])
    held = for_curve if for_curve.any() else ~for_curve
    return ToxicityModel(weights, trees, isotonic(trees.raw(x[held]), y[held]))


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(id, score, predicted) for every row of (id, text)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(model.lexicon)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.array([features(t, lexicon) for t in batch.column("text").to_pylist()])
            value = np.clip(model.scores(x), 0.0, 1.0)
            yield pa.RecordBatch.from_pydict(
                {"id": batch.column("id"), "score": value, "predicted": (value >= 0.5).astype(np.int32)}
            )

    return in_tasks(docs.select("id", "text"), run, "id long, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_rows: int = 20_000) -> DataFrame:
    """One row per row of ``docs``: id, held_out, score, predicted.

    Documents whose crc32(id as text) mod 5 is 0 are held out: their labels are never read. Only
    the text is an input. Null text counts as empty and is scored like any other; a null id is
    scored and not held out. Without any labelled document the score is near 0. Repeated rows are
    scored alike, extra columns are ignored, an empty table gives no rows.
    """
    held = lambda column: F.coalesce(F.crc32(column.cast("string").cast("binary")) % 5 == 0, F.lit(False))
    texts = narrow(docs, id_col, text_col)
    known = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("toxic"))
    model = train(texts, known.where(~held(F.col("id"))), max_rows)
    return score(texts, model).select("id", held(F.col("id")).alias("held_out"), "score", "predicted")


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns; rows without id stay."""
    return without_ids(docs, id_col, toxicity(docs, labels, id_col, text_col).where("predicted = 1").select("id"))
