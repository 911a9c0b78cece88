"""Personal data by a semi-Markov conditional random field over candidate segments.

Four kinds have an exact base form; those matches always stay. Around digits and ``@`` the model
scores whole candidate segments (their shape, checks on all of their digits, the words before
them) and dynamic programming over segments of bounded length chooses boundaries and kinds
together. A text without such a sign has no candidate, so the rest of a text needs no search: a
word outside scores nothing, and the best segmentation of a text is that of its regions.

The weights are fitted by conditional likelihood on regions of the given documents, whose labels
are the base forms and keyed secrets.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written_table
from .common import narrow, per_batch

# The kinds in the order of the result, and the base forms.
KINDS = ("email", "ip", "card", "phone", "secret")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SECRET_KEYS = frozenset("token secret key apikey api_key password passwd pwd auth bearer credential".split())

MAX_TOKENS = 16  # tokens of one entity
REACH = 48  # characters around a sign that belong to its region
TOKEN = re.compile(r"[^\W_]+|\S")
SIGN = re.compile(r"[0-9@]+")
KEYED = re.compile(r"(?i)(?<![^\W_])(?:" + "|".join(sorted(SECRET_KEYS, key=len, reverse=True)) + r")\s*[=:]\s*[\"']?([A-Za-z0-9_\-]{16,96})")


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for place, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if place % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Each ``@`` with the local part before it and the domain behind it; linear in the text."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Leftmost, non-overlapping matches of each kind that pass its check, by kind and start."""
    out = [("email", a, b) for a, b in emails(text)]
    for m in IP.finditer(text):
        if all(int(part) <= 255 for part in (p.lstrip("0")[:4] or "0" for p in m.group().split("."))):
            out.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = digits_of(m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    for m in PHONE.finditer(text):
        if 9 <= len(digits_of(m.group())) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def regions(text: str) -> Iterator[tuple[int, int]]:
    """Stretches of REACH characters around signs; those that meet are joined."""
    start = end = -1
    for m in SIGN.finditer(text):
        a, b = max(0, m.start() - REACH), min(len(text), m.end() + REACH)
        if a <= end:
            end = b
            continue
        if start >= 0:
            yield start, end
        start, end = a, b
    if start >= 0:
        yield start, end


FEATURES = (
    "bias", "digits_few", "digits_phone", "digits_card", "digits_more", "luhn", "octets", "plus", "at", "domain",
    "spelled_at", "digits_and_gaps", "phone_signs", "brackets", "long_hex", "long_mixed", "after_key", "quoted",
    "cut_left", "cut_right", "goes_on", "blanks", "two_groups", "no_sign",
)
HEX = re.compile(r"[0-9a-fA-F]{24,}")
MIXED = re.compile(r"[A-Za-z0-9_\-]{20,}")
GAPS = re.compile(r"[0-9](?:[\x20-]?[0-9])*")
PHONE_SIGNS = re.compile(r"[+0-9\x20().-]+")
OCTETS = re.compile(r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}")
SPELLED = re.compile(r"(?i)[\w.+-]+\s*[(\[]?\s?at\s?[)\]]?\s*[\w-]+(?:\s*[(\[]?\s?dot\s?[)\]]?\s*[\w-]+)+")
MAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")


def span_features(text: str, start: int, end: int) -> list[float]:
    """Features of a whole candidate, in the order of FEATURES."""
    span = text[start:end]
    digits = digits_of(span)
    n = len(digits)
    before, after = text[max(0, start - 20):start], text[end:end + 2]
    words = re.findall(r"[^\W\d]+", before.lower())
    glued = lambda a, b: a.isalnum() and b.isalnum()
    flags = (
        True, 0 < n < 9, 9 <= n <= 15, 13 <= n <= 19, n > 19, 13 <= n <= 19 and luhn(digits), bool(OCTETS.fullmatch(span)),
        span[0] == "+", span.count("@") == 1, bool(MAIL.fullmatch(span)), bool(SPELLED.fullmatch(span)), bool(GAPS.fullmatch(span)),
        bool(PHONE_SIGNS.fullmatch(span)), "(" in span and ")" in span, bool(HEX.fullmatch(span)),
        bool(MIXED.fullmatch(span)) and n > 2 and n < len(span), bool(words) and words[-1] in SECRET_KEYS,
        before[-1:] in ("'", '"') and after[:1] == before[-1:], bool(before) and glued(before[-1], span[0]),
        bool(after) and glued(span[-1], after[0]),
        # a mark and a digit or letter follow, as inside a longer number, address or name
        len(after) == 2 and after[0] in ".-_@ " and (after[1].isdigit() or after[0] != " " and after[1].isalnum()),
        " " in span, len(re.findall(r"[0-9]+", span)) > 1, not n and "@" not in span,
    )
    return [float(f) for f in flags]


def candidates(text: str, start: int, end: int, taken: list[tuple[int, int]]) -> tuple[list[tuple[int, int]], list[tuple[int, int, list[float]]]]:
    """Tokens of a region and its candidate segments (first token, last token + 1, features).

    A candidate has at most MAX_TOKENS tokens, holds a sign, begins and ends with a letter, a
    digit or ``+``, and does not touch a base match.
    """
    tokens = [(m.start(), m.end()) for m in TOKEN.finditer(text, start, end)]
    out = []
    for i, (a, _) in enumerate(tokens):
        if not (text[a].isalnum() or text[a] == "+"):
            continue
        signs = False
        for j in range(i, min(len(tokens), i + MAX_TOKENS)):
            b = tokens[j][1]
            if j > i and len(text[tokens[j - 1][1]:tokens[j][0]]) > 1 or any(x < b and a < y for x, y in taken):
                break  # wide gaps and base matches end every candidate
            signs = signs or bool(SIGN.search(text, tokens[j][0], b))
            if signs and text[b - 1].isalnum():
                out.append((i, j + 1, span_features(text, a, b)))
    return tokens, out


NEVER = float("-inf")


def added(a: float, b: float) -> float:
    """log(exp(a) + exp(b))."""
    if a < b:
        a, b = b, a
    return a if b == NEVER else a + math.log1p(math.exp(b - a))


class SegmentModel:
    """Weights per kind, and one for two entities that follow each other without a word between."""

    def __init__(self, weights: np.ndarray, adjacent: float):
        self.weights, self.adjacent = weights, adjacent

    def best(self, size: int, segments: list[tuple[int, int, list[float]]]) -> list[tuple[int, int, str]]:
        """The best segmentation; ties prefer fewer entities, then the earlier kind."""
        if not segments:
            return []
        scores = np.array([s[2] for s in segments]) @ self.weights.T
        ending: dict[int, list[int]] = {}
        for k, (_, end, _) in enumerate(segments):
            ending.setdefault(end, []).append(k)
        # value and origin after a word outside (0) or an entity (1)
        value = [[0.0, -np.inf]] + [[-np.inf, -np.inf] for _ in range(size)]
        origin: list[list] = [[None, None] for _ in range(size + 1)]
        for end in range(1, size + 1):
            state = int(value[end - 1][1] > value[end - 1][0])
            value[end][0], origin[end][0] = value[end - 1][state], (end - 1, state, None)
            for k in ending.get(end, ()):
                first, kind = segments[k][0], int(scores[k].argmax())
                for state, extra in ((0, 0.0), (1, self.adjacent)):
                    total = value[first][state] + extra + scores[k][kind]
                    if total > value[end][1] + 1e-12:
                        value[end][1], origin[end][1] = total, (first, state, kind)
        out, at, state = [], size, int(value[size][1] > value[size][0])
        while at:
            first, before, kind = origin[at][state]
            if kind is not None:
                out.append((first, at, KINDS[kind]))
            at, state = first, before
        return out[::-1]

    def gradient(self, size: int, segments: list, gold: set[tuple[int, int, int]]) -> tuple[float, np.ndarray, float]:
        """Log likelihood of the gold segmentation and its slope, by sums over all segmentations."""
        x = np.array([s[2] for s in segments])
        scores = x @ self.weights.T
        whole = np.logaddexp.reduce(scores, axis=1).tolist()
        near = self.adjacent
        by_end: dict[int, list[int]] = {}
        by_start: dict[int, list[int]] = {}
        for k, (first, end, _) in enumerate(segments):
            by_end.setdefault(end, []).append(k)
            by_start.setdefault(first, []).append(k)
        # sums over all segmentations up to a place, after a word outside and after an entity
        outside, inside, either = [0.0], [NEVER], [0.0]
        for end in range(1, size + 1):
            total = NEVER
            for k in by_end.get(end, ()):
                total = added(total, either[segments[k][0]] + whole[k])
            outside.append(added(outside[-1], inside[-1]))
            inside.append(total)
            either.append(added(outside[-1], total + near))
        # and from a place on, when an entity does not and when it does end there
        after, behind = [0.0] * (size + 1), [0.0] * (size + 1)
        for at in range(size - 1, -1, -1):
            total = NEVER
            for k in by_start.get(at, ()):
                total = added(total, whole[k] + behind[segments[k][1]])
            after[at], behind[at] = added(after[at + 1], total), added(after[at + 1], total + near)
        total = added(outside[size], inside[size])
        starts, ends = [s[0] for s in segments], [s[1] for s in segments]
        rest = np.array([behind[e] for e in ends]) - total
        share = np.exp(scores + (np.array([either[i] for i in starts]) + rest)[:, None])
        slope = -(share.T @ x)
        near_slope = -float(np.exp(np.array(whole) + np.array([inside[i] for i in starts]) + near + rest).sum())
        likely, closed = -total, {e for _, e, _ in gold}
        place = {s[:2]: k for k, s in enumerate(segments)}
        for first, end, kind in gold:
            k = place[first, end]
            slope[kind] += x[k]
            likely += scores[k][kind] + (near if first in closed else 0.0)
            near_slope += first in closed
        return likely, slope, near_slope


def labelled_regions(text: str) -> Iterator[tuple[int, int, list, set]]:
    """(start, size, segments, gold) of the regions of a text; gold are base forms and keyed secrets."""
    base = base_spans(text)
    for start, end in regions(text):
        spans = [(k, a, b) for k, a, b in base if start <= a and b <= end]
        spans += [("secret", m.start(1), m.end(1)) for m in KEYED.finditer(text, start, end)]
        tokens, segments = candidates(text, start, end, [])
        first, last = {a: i for i, (a, _) in enumerate(tokens)}, {b: i + 1 for i, (_, b) in enumerate(tokens)}
        known = {(s[0], s[1]) for s in segments}
        gold: set = set()
        for kind, a, b in spans:
            place = (first.get(a), last.get(b))
            free = all(place[1] <= i or j <= place[0] for i, j, _ in gold) if None not in place else False
            if place in known and free:
                gold.add((*place, KINDS.index(kind)))
        yield start, len(tokens), segments, gold


def train(docs: DataFrame, max_regions: int = 600, steps: int = 40) -> SegmentModel:
    """Fit on at most ``max_regions`` regions, chosen by a hash of document and place.

    Each region with an entity of a kind competes with others of that kind and regions without
    any compete with each other, so rare kinds are seen.
    """

    def cut(batch: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {"id": [], "at": [], "kind": [], "region": []}
        for doc, text in zip(batch["id"], batch["text"]):
            if not SIGN.search(text):
                continue
            found = base_spans(text) + [("secret", m.start(1), m.end(1)) for m in KEYED.finditer(text)]
            for start, end in regions(text):
                kinds = [k for k, a, b in found if start <= a and b <= end]
                out["id"].append(doc)
                out["at"].append(start)
                out["kind"].append(KINDS.index(kinds[0]) if kinds else -1)
                # long runs of numbers would make the sums long; a region is enough to learn from
                out["region"].append(text[start:min(end, start + 400)])
        return out

    found = written_table(per_batch(docs, "id long, at int, kind int, region string", cut), "pii-regions")
    order = F.xxhash64("id", "at", "region")
    share = max(1, max_regions // (len(KINDS) + 1))
    per_kind = [
        found.where(F.col("kind") == k).orderBy(order, "region").limit(share).select("region") for k in range(-1, len(KINDS))
    ]
    chosen = per_kind[0]
    for more in per_kind[1:]:
        chosen = chosen.unionAll(more)
    examples = []
    for row in sorted(chosen.collect()):  # at most max_regions short rows
        for _, size, segments, gold in labelled_regions(row.region):
            if segments:
                examples.append((size, segments, gold))
    model = SegmentModel(np.zeros((len(KINDS), len(FEATURES))), 0.0)
    if not examples:
        model.weights[:, 0] = -1.0
        return model
    # ascent with a step per weight; the prior pulls towards 0
    memory, near_memory = np.full_like(model.weights, 1e-6), 1e-6
    for _ in range(steps):
        slope, near = -0.02 * model.weights, -0.02 * model.adjacent
        for size, segments, gold in examples:
            _, s, n = model.gradient(size, segments, gold)
            slope, near = slope + s, near + n
        memory, near_memory = memory + slope**2, near_memory + near**2
        model.weights += 0.8 * slope / np.sqrt(memory)
        model.adjacent += 0.8 * near / np.sqrt(near_memory)
    return model


def spans_of(text: str, model: SegmentModel) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, base) of one whole text, by kind and start."""
    if not SIGN.search(text):
        return []
    base = base_spans(text)
    out = [(*s, True) for s in base]
    taken = sorted((a, b) for _, a, b in base)
    at = 0
    for start, end in regions(text):
        while at < len(taken) and taken[at][1] <= start:
            at += 1
        inside = []
        for a, b in taken[at:]:
            if a >= end:
                break
            inside.append((a, b))
        tokens, segments = candidates(text, start, end, inside)
        out += [(kind, tokens[i][0], tokens[j - 1][1], False) for i, j, kind in model.best(len(tokens), segments)]
    return sorted(out, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_regions: int = 600) -> DataFrame:
    """(id, spans) for every row; spans are (kind, start, end, base, value) in code points, end exclusive.

    Base matches always stay and no added span touches one. Null and empty texts have no spans.
    Null ids and repeated rows are rows like any other, extra columns are ignored, an empty table
    gives no rows. Whole texts are read; an entity has at most MAX_TOKENS tokens.
    """
    texts = narrow(docs, id_col, text_col)
    model = train(texts, max_regions)

    def run(batch: dict[str, list]) -> dict[str, list]:
        found = []
        for text in batch["text"]:
            found.append([
                {"kind": k, "start": a, "end": b, "base": base, "value": text[a:b]} for k, a, b, base in spans_of(text, model)
            ])
        return {"id": batch["id"], "spans": found}

    return per_batch(texts, "id long, spans array<struct<kind string, start int, end int, base boolean, value string>>", run)


def joined(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def digest_columns(found: DataFrame) -> DataFrame:
    """Counts and the digest of the base spans, and all spans as one string."""
    base = F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        F.col("id").alias("doc_id"), *[count(kind).alias(f"n_{kind}") for kind in KINDS[:4]],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
    )
