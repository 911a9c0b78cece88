"""SentencePiece encoding and decoding with a table of the last token of every prefix.

For a merge-based vocabulary the encoding of a text is known as soon as the last token of each of
its prefixes is: it is the one piece that ends there, found by an automaton, which fits the last
token of the prefix before it. Two tokens fit if merging their characters alone gives the two back.
The ids are then read off backwards.

Texts are cut where no piece can reach across: before a run of blanks, and between characters that
no chain of pieces connects, such as letters and punctuation. The ids of a unit are remembered up
to a bound. The mark of a blank and a blank are the same to the model; here both are a blank.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import in_tasks, narrow

BLANK = "▁"
# Groups of characters with a pattern of their own; the others are one group.
GROUPS = 8
# Bytes of texts encoded at a time: their ids and decoded texts are held beside them.
SLICE = 1 << 20
# Bounds of what a worker remembers: some 13 MB of units, in two halves, twice that of pairs, and steps of the automaton.
MEMO_UNITS = 60_000
MEMO_LENGTH = 64
MEMO_PAIRS = 500_000
MEMO_STEPS = 200_000


class Token(dict):
    """A piece, or a character without one; it maps the numbers of pieces to whether they may follow it."""

    __slots__ = ("codec", "text", "size", "ids")

    def __init__(self, codec: Codec, text: str, ids: list[int]):
        self.codec, self.text, self.size = codec, text, len(text)
        self.ids = b"".join(i.to_bytes(4, "little") for i in ids)

    def __missing__(self, number: int) -> bool:
        return self.codec.fit(self, number)


class Start(dict):
    """What stands before a unit: every piece may follow it."""

    def __missing__(self, number: int) -> bool:
        return True


class Node(dict):
    """The longest end of a prefix that begins a piece: next nodes by character, and the pieces that end here."""

    __slots__ = ("codec", "name", "ends")

    def __init__(self, codec: Codec, name: str):
        self.codec, self.name = codec, name
        self.ends = tuple(codec.entry(end) for i in range(len(name)) if (end := name[i:]) in codec.entries)  # the longest first

    def __missing__(self, char: str) -> Node:
        return self.codec.step(self, char)


class Units(dict):
    """Ids of the units seen lately; when a half is full, the older half goes."""

    __slots__ = ("codec", "older")

    def __init__(self, codec: Codec):
        self.codec, self.older = codec, {}

    def __missing__(self, unit: str) -> bytes:
        ids = self.older.get(unit)
        if ids is None:
            ids = self.codec.unit_ids(unit)
        if len(unit) <= MEMO_LENGTH:
            if len(self) >= MEMO_UNITS // 2:
                self.older = dict(self)
                self.clear()
            self[unit] = ids
        return ids


class Codec:
    """Encoder and decoder over the pieces and scores of a model file."""

    def __init__(self, model_file: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        size = model.get_piece_size()
        self.pieces = [model.id_to_piece(i).replace(BLANK, " ") for i in range(size)]
        self.begin, self.end = model.bos_id(), model.eos_id()
        special = {i for i in range(size) if model.is_control(i) or model.is_unknown(i)}
        in_bytes = {i for i in range(size) if model.is_byte(i)}
        self.byte_ids = {int(self.pieces[i][3:5], 16): i for i in in_bytes}
        self.ids = {p: i for i, p in enumerate(self.pieces) if i not in special and i not in in_bytes}
        self.scores = {p: model.get_score(i) for p, i in self.ids.items()}
        # pieces as bytes; control tokens decode to nothing
        self.raw = [
            b"" if i in special else bytes([int(p[3:5], 16)]) if i in in_bytes else p.encode()
            for i, p in enumerate(self.pieces)
        ]
        if special - {self.begin, self.end}:
            self.raw[model.unk_id()] = " ⁇ ".encode()
        # a piece that merging never makes is never used
        self.entries: dict[str, tuple[int, int, Token] | None] = {p: None for p in self.ids if self.merged(list(p)) == [p]}
        self.nodes: dict[str, Node | None] = {"": None} | {p[:i]: None for p in self.entries for i in range(1, len(p) + 1)}
        self.root, self.start = self.node(""), Start()
        self.known_fits = self.known_steps = 0
        self.units = Units(self)
        self.unit = re.compile(self.unit_pattern())

    def unit_pattern(self) -> str:
        """Blanks and the characters of one group after them; characters next to each other in a piece are in one group."""
        group_of: dict[str, set[str]] = {}
        for piece in self.ids:
            body = piece.lstrip(" ")
            if " " in body:
                raise ValueError(f"a piece with a blank behind another character: {piece!r}")
            if len(body) > 1:
                first, *others = sorted({id(g): g for g in (group_of.get(c, {c}) for c in body)}.values(), key=len, reverse=True)
                first.update(*others)
                for char in set().union(body, *others):
                    group_of[char] = first
        groups = sorted({id(g): g for g in group_of.values()}.values(), key=len, reverse=True)[:GROUPS]
        inside = [re.escape("".join(sorted(g))) for g in groups]
        return f" *(?:{''.join(f'[{g}]+|' for g in inside)}[^ {''.join(inside)}]+)| +"

    def merged(self, symbols: list[str]) -> list[str]:
        """The definition: join the best-scored neighbours, leftmost first, until none is a piece."""
        scores = self.scores
        while len(symbols) > 1:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                score = scores.get(symbols[i] + symbols[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def fit(self, left: Token, number: int) -> bool:
        """Whether ``left`` and a piece stay side by side when their characters are merged."""
        if self.known_fits >= MEMO_PAIRS:
            for entry in self.entries.values():
                if entry:
                    entry[2].clear()
            self.known_fits = 0
        right = self.pieces[number]
        known = left[number] = self.merged(list(left.text + right)) == [left.text, right]
        self.known_fits += 1
        return known

    def entry(self, piece: str) -> tuple[int, int, Token]:
        """How far back a piece begins, its number and its token."""
        found = self.entries[piece]
        if found is None:
            number = self.ids[piece]
            found = self.entries[piece] = (-len(piece), number, Token(self, piece, [number]))
        return found

    def node(self, name: str) -> Node:
        found = self.nodes[name]
        if found is None:
            found = self.nodes[name] = Node(self, name)
        return found

    def step(self, node: Node, char: str) -> Node:
        """The node after a character."""
        if self.known_steps >= MEMO_STEPS:
            for known in self.nodes.values():
                if known is not None:
                    known.clear()
            self.known_steps = 0
        name = node.name + char
        while name not in self.nodes:
            name = name[1:]
        after = node[char] = self.node(name)
        self.known_steps += 1
        return after

    def unit_ids(self, unit: str) -> bytes:
        """Ids of a unit; a character without a piece stands for itself, as bytes."""
        node = self.root
        last: list[dict] = [self.start]
        append = last.append
        for char in unit:
            node = node[char]
            for back, number, token in node.ends:
                if last[back][number]:
                    append(token)
                    break
            else:
                append(Token(self, char, [self.byte_ids[b] for b in char.replace(" ", BLANK).encode("utf-8", "replace")]))
        out, end = [], len(unit)
        while end:
            token = last[end]
            out.append(token.ids)
            end -= token.size
        out.reverse()
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit numbers, begin and end included."""
        whole = b""
        if text:
            whole = b"".join(map(self.units.__getitem__, self.unit.findall(" " + text.replace(BLANK, " "))))
        return self.begin.to_bytes(4, "little") + whole + self.end.to_bytes(4, "little")

    def decode(self, ids: Iterable[int]) -> str:
        """The text of any ids: pieces joined, byte pieces read as UTF-8, the first piece's blank removed.

        A byte that is not part of a valid character becomes one replacement character.
        """
        raw = self.raw
        whole = b"".join(map(raw.__getitem__, ids))
        if whole[:1] == b" " and self.pieces[next(i for i in ids if raw[i])][:1] == " ":
            whole = whole[1:]
        try:
            return whole.decode("utf-8")
        except UnicodeDecodeError:
            out, at = [], 0
            while at < len(whole):
                for size in (1, 2, 3, 4):
                    try:
                        out.append(whole[at:at + size].decode("utf-8"))
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    size = 1
                    out.append("�")
                at += size
            return "".join(out)


_CODECS: dict[str, Codec] = {}


def codec(model_file: str) -> Codec:
    """The codec of this Python worker, built once."""
    if model_file not in _CODECS:
        _CODECS[model_file] = Codec(model_file)
    return _CODECS[model_file]


def encode(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, tokens, decoded) for every row: ids as a binary of little-endian 32-bit numbers, and their text.

    Null and empty texts give the begin and end ids and an empty text. Null ids, repeated rows and
    extra columns change nothing; an empty table gives no rows. The model file must lie at the
    same path on every executor.
    """
    schema = pa.schema([("id", pa.int64()), ("tokens", pa.binary()), ("decoded", pa.string())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(model_file)
        for batch in batches:
            tokens = [coder.encode(t.as_py()) for t in batch.column("text")]
            decoded = [coder.decode(memoryview(t).cast("I")) for t in tokens]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(tokens, pa.binary()), pa.array(decoded, pa.string())], schema=schema)
            del tokens, decoded

    return in_tasks(narrow(docs, id_col, text_col), run, "id long, tokens binary, decoded string", SLICE)


def encode_digests(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of ``encode``, reduced inside the tasks."""
    schema = pa.schema([("id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(model_file)
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                tokens = coder.encode(text.as_py())
                decoded = coder.decode(memoryview(tokens).cast("I"))
                rows.append((len(tokens) // 4, hashlib.sha256(tokens).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
            columns = [pa.array([r[k] for r in rows], schema.field(k + 1).type) for k in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], schema=schema)

    return in_tasks(narrow(docs, id_col, text_col), run, "id long, n_tokens long, ids_sha256 string, decoded_sha256 string", SLICE)
