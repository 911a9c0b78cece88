"""Repeated passages by prefix-free parsing.

A rolling hash is taken at every byte; the smallest one inside each window of ``length`` bytes is
a trigger. Triggers cut a text into phrases: the phrase of a trigger is the stretch of all the
strings of ``length`` bytes that chose it. Equal strings choose the same trigger, so a string can
only repeat where the trigger's bytes do.

The dictionary holds each phrase once, with the smallest document it lies in; the parse is the
list of phrases per document. A document whose phrase is known from a smaller one loses it whole,
whatever the number of copies. What is left to compare are different phrases around one trigger:
there the dictionary's phrases are sorted twice, by their suffixes from the trigger on and by what
stands before it read backwards. A string is so many bytes before a trigger and the rest from it on;
two strings are equal if their phrases lie in one run of each order that shares as many bytes. So
corpus order is only ever computed on distinct phrases that meet in a trigger, and never on copies.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import enumerate_rows
from ..session import broadcast_if_small, written_table
from .common import SLICE, arrow_schema, in_groups, in_tasks, ship_package
from .minhash import mixed

GRAM = 16  # bytes of a trigger
CHUNK = 1 << 20  # bytes that are hashed at once
FLUSH = 1 << 23  # bytes whose phrases are reduced and sent together
BUCKET = 1 << 23  # bytes of text per bucket of triggers
# A trigger with so many different phrases in one flush, or open ones in all, is spread over tasks.
HOT_IN_FLUSH = 64
HOT_IN_ALL = 10_000
ENTRIES = 1 << 14  # phrases, or those of one trigger, that are sorted together
# What a flush knows of a phrase: nothing, that a smaller document has it, that it is one of very
# many of its trigger; and a mark that such a trigger exists.
NEW, KNOWN, CROWDED, CROWD = range(4)
BASE = 0x9E3779B97F4A7C15 | 1
LOW = np.uint64(0xFFFFFFFF)
CODES = np.random.Generator(np.random.PCG64(11)).integers(1, 1 << 63, 256, dtype=np.uint64)


class Powers:
    """Powers of the base and of its inverse modulo 2^64, prolonged when needed."""

    def __init__(self):
        self.size = 0

    def upto(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        if size > self.size:
            self.size = max(size, CHUNK + (1 << 17))
            both = []
            for base in (BASE, pow(BASE, -1, 1 << 64)):
                steps = np.full(self.size, base, np.uint64)
                steps[0] = 1
                both.append(np.cumprod(steps))
            self.up, self.down = both
        return self.up[:size], self.down[:size]


def prefix_hashes(data: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    up, down = powers.upto(len(data) + 1)
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(CODES[data] * up[:-1], out=sums[1:])
    return sums, down


def phrases(data: np.ndarray, ends: np.ndarray, length: int, powers: Powers) -> tuple[np.ndarray, ...]:
    """(trigger, phrase, first, last, chosen) of the texts in ``data``, which end at ``ends``.

    first and last are the first and the last string of a phrase, chosen is the trigger, as places in ``data``.
    """
    none = np.empty(0, np.uint64)
    strings = len(data) - length + 1
    if strings <= 0:
        return none, none, none.astype(np.int64), none.astype(np.int64), none.astype(np.int64)
    sums, down = prefix_hashes(data, powers)
    grams = (sums[GRAM:] - sums[:-GRAM]) * down[:len(data) - GRAM + 1]
    least = (mixed(grams) & ~LOW) | np.arange(len(grams), dtype=np.uint64)
    width, reach = length - GRAM + 1, 1
    while reach * 2 <= width:  # minima of windows, doubled until they cover the string
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < width:
        least = np.minimum(least[:len(least) - (width - reach)], least[width - reach:])
    inside = np.ones(strings, bool)
    crossing = (ends[:, None] + np.arange(1 - length, 0)).ravel()
    inside[crossing[(crossing >= 0) & (crossing < strings)]] = False
    starts = np.flatnonzero(inside)
    if not len(starts):
        return none, none, none.astype(np.int64), none.astype(np.int64), none.astype(np.int64)
    chosen = (least[starts] & LOW).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
    first, last = starts[new], starts[np.concatenate([new[1:], [len(starts)]]) - 1]
    phrase = mixed((sums[last + length] - sums[first]) * down[first] + (last - first).astype(np.uint64))
    return mixed(grams[chosen[new]] + np.uint64(1)), phrase, first, last, chosen[new]


def chunks(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, ends) of consecutive rows, together CHUNK bytes or one long row."""
    texts = batch.column(column).cast(pa.binary())
    if texts.null_count or not len(texts):
        texts = texts.fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + CHUNK, side="right")) - 1)
        yield row, end, data[offsets[row]:offsets[end]], offsets[row + 1:end + 1] - offsets[row]
        row = end


ENTRY = (("mark", np.uint32), ("high", np.uint32), ("low", np.uint32), ("id", np.int64), ("variant", np.int64), ("first", np.uint32), ("span", np.uint32), ("anchor", np.uint32), ("known", np.uint8))
SQUEEZED = ("id", "variant", "first", "span", "anchor", "known")


def packed(entries: dict[str, np.ndarray]) -> bytes:
    """Columns of entries as one binary; all but the hashes compressed."""
    codec, parts = pa.Codec("zstd", compression_level=1), []
    for name, kind in ENTRY:
        raw = entries[name].astype(kind).tobytes()
        parts.append(codec.compress(raw, asbytes=True) if name in SQUEEZED and raw else raw)
    head = np.array([len(entries["id"]), *map(len, parts)], np.int64).tobytes()
    return head + b"".join(parts)


def unpacked(blob: bytes) -> dict[str, np.ndarray]:
    codec, at = pa.Codec("zstd"), 8 * (len(ENTRY) + 1)
    count, *sizes = np.frombuffer(blob[:at], np.int64).tolist()
    out = {}
    for (name, kind), size in zip(ENTRY, sizes):
        part, at = blob[at:at + size], at + size
        if name in SQUEEZED and count:
            part = codec.decompress(part, count * np.dtype(kind).itemsize, asbytes=True)
        out[name] = np.frombuffer(part, kind)
    return out


def parse(texts: DataFrame, length: int, buckets: int, hot: int = HOT_IN_FLUSH) -> DataFrame:
    """(bucket, entries): the phrases of all texts, sent to the bucket of their trigger.

    Phrases known from a smaller document of the same flush are only marked, and go to any bucket.
    A trigger with very many phrases sends them by phrase and a mark of itself by trigger: the
    phrases are open for certain, and so are those that another flush sends by trigger.
    """
    schema = arrow_schema("bucket int, entries binary")

    def reduced(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        trigger, phrase, ids, variant, first, span, anchor = (np.concatenate([h[k] for h in held]) for k in range(7))
        if not len(trigger):
            return
        order = np.lexsort((ids, phrase, trigger))
        t, p, d = trigger[order], phrase[order], ids[order]
        new = np.concatenate([[True], (t[1:] != t[:-1]) | (p[1:] != p[:-1])])
        smallest = d[np.flatnonzero(new)][np.cumsum(new) - 1]
        known = np.empty(len(order), np.uint8)
        known[order] = np.where(d > smallest, KNOWN, NEW)
        starts = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
        kinds = np.add.reduceat(new.astype(np.int64), starts)
        crowds = t[starts[kinds >= hot]]
        if len(crowds):
            crowded = np.isin(trigger, crowds)
            known[crowded & (known == NEW)] = CROWDED
            mark = np.zeros(len(crowds), np.int64)
            trigger, phrase = np.concatenate([trigger, crowds]), np.concatenate([phrase, mark.astype(np.uint64)])
            ids, variant, first, span, anchor = (np.concatenate([a, mark.astype(a.dtype)]) for a in (ids, variant, first, span, anchor))
            known = np.concatenate([known, np.full(len(crowds), CROWD, np.uint8)])
        anywhere = mixed(ids.astype(np.uint64) * np.uint64(BASE) + first.astype(np.uint64))
        route = np.where(known == KNOWN, anywhere, np.where(known == CROWDED, mixed(phrase + trigger), trigger))
        bucket = (route % np.uint64(buckets)).astype(np.int64)
        columns = {
            "mark": trigger >> np.uint64(32), "high": phrase >> np.uint64(32), "low": phrase & LOW,
            "id": ids, "variant": variant, "first": first, "span": span, "anchor": anchor, "known": known,
        }
        order = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[order], np.arange(buckets + 1)) if buckets < len(order) else None
        present = np.unique(bucket)
        for b in present:
            rows = order[edges[b]:edges[b + 1]] if edges is not None else np.flatnonzero(bucket == b)
            blob = packed({name: column[rows] for name, column in columns.items()})
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([blob], pa.binary())], schema=schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, held, size = Powers(), [], 0
        for batch in batches:
            ids, variants = batch.column("id").to_numpy(zero_copy_only=False), batch.column("variant").to_numpy(zero_copy_only=False)
            for row, end, data, ends in chunks(batch, "text"):
                trigger, phrase, first, last, chosen = phrases(data, ends, length, powers)
                own = np.searchsorted(ends, first, side="right")
                begins = np.concatenate([[0], ends[:-1]])
                held.append((trigger, phrase, ids[row:end][own], variants[row:end][own], first - begins[own], last - first, chosen - first))
                size += len(data)
                if size >= FLUSH:
                    yield from reduced(held)
                    held, size = [], 0
        if held:
            yield from reduced(held)

    return in_tasks(texts, run, "bucket int, entries binary")


def dictionary(entries: DataFrame) -> DataFrame:
    """(id, variant, first, span, anchor, known, trigger) of the phrases that are settled or still open.

    known: the phrase lies in a smaller document. Otherwise the document is the smallest with it,
    and the phrase is open if its trigger has other phrases too.
    """
    schema = arrow_schema("id long, variant long, first int, span int, anchor int, known boolean, trigger long")

    def settle(table: pa.Table) -> pa.Table:
        parts = [unpacked(b.as_py()) for b in table["entries"]]
        e = {name: np.concatenate([p[name] for p in parts]) for name, _ in ENTRY}
        way = np.where(e["known"] == CROWD, NEW, e["known"])  # marks stand beside the phrases sent by trigger
        order = np.lexsort((e["id"], e["known"] == CROWD, e["low"], e["high"], e["mark"], way))
        e, way = {name: column[order] for name, column in e.items()}, way[order]
        live, crowd = way != KNOWN, e["known"] == CROWD
        same_mark = (e["mark"][1:] == e["mark"][:-1]) & (way[1:] == way[:-1]) & live[1:]
        same = same_mark & (e["high"][1:] == e["high"][:-1]) & (e["low"][1:] == e["low"][:-1]) & (crowd[1:] == crowd[:-1])
        new = np.concatenate([[True], ~same])
        smallest = e["id"][np.flatnonzero(new)][np.cumsum(new) - 1]
        known = ~live | (e["id"] > smallest)
        # triggers with more than one phrase
        mark_start = np.flatnonzero(np.concatenate([[True], ~same_mark]))
        kinds = np.add.reduceat(new.astype(np.int64), mark_start)
        kinds = np.repeat(kinds, np.diff(np.concatenate([mark_start, [len(new)]])))
        keep = ~crowd & (known | (way == CROWDED) | (kinds > 1))
        # phrases of one trigger carry one number, whichever way they came
        trigger = e["mark"].astype(np.int64)
        out = {"id": e["id"], "variant": e["variant"], "first": e["first"], "span": e["span"], "anchor": e["anchor"], "known": known, "trigger": trigger}
        return pa.Table.from_arrays([pa.array(out[f.name][keep], f.type, safe=False) for f in schema], schema=schema)

    return in_groups(entries.groupBy("bucket"), settle, "id long, variant long, first int, span int, anchor int, known boolean, trigger long")


def squeezed(texts: DataFrame) -> DataFrame:
    """(id, variant, packed): texts as compressed bytes, for the joins that shuffle them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", compression_level=3)
        for batch in batches:
            raw = [t.as_py() or b"" for t in batch.column("text").cast(pa.binary())]
            packed = [len(t).to_bytes(8, "little") + (codec.compress(t, asbytes=True) if t else b"") for t in raw]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("variant"), pa.array(packed, pa.binary())], names=["id", "variant", "packed"])

    return in_tasks(texts.select("id", "variant", "text"), run, "id long, variant long, packed binary")


def unsqueezed(packed: bytes) -> bytes:
    size = int.from_bytes(packed[:8], "little")
    return pa.Codec("zstd").decompress(packed[8:], size, asbytes=True) if size else b""


def rows_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)


def open_phrases(texts: DataFrame, asked: DataFrame, length: int) -> DataFrame:
    """(trigger, id, variant, first, anchor, bytes) of the open phrases, read off their texts."""
    schema = arrow_schema("trigger long, id long, variant long, first int, anchor int, bytes binary")
    lists = asked.groupBy("id", "variant").agg(F.collect_list(F.struct("trigger", "first", "span", "anchor")).alias("asked"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            size = 0
            rows = zip(batch.column("id").to_pylist(), batch.column("variant").to_pylist(), batch.column("packed"), batch.column("asked"))
            for doc, variant, packed, wanted in rows:
                whole = unsqueezed(packed.as_py())
                for w in wanted.as_py():
                    out.append((w["trigger"], doc, variant, w["first"], w["anchor"], whole[w["first"]:w["first"] + w["span"] + length]))
                    size += w["span"] + length
                if size >= SLICE:
                    yield rows_of(out, schema)
                    out, size = [], 0
            yield rows_of(out, schema)

    joined = squeezed(texts).join(lists, ["id", "variant"]).select("id", "variant", "packed", "asked")
    return in_tasks(joined, run, "trigger long, id long, variant long, first int, anchor int, bytes binary")


def shared_bytes(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, shared) of a matrix of bytes: its rows in byte order, and how many leading bytes each has
    in common with the row before in that order (-1 for the first)."""
    words = np.ascontiguousarray(rows).view(">u8").astype(np.uint64)
    order = np.lexsort(words.T[::-1])
    ordered = rows[order]
    differ = ordered[1:] != ordered[:-1]
    shared = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return order, np.concatenate([[-1], shared])


def repeated_in(data: np.ndarray, begins: np.ndarray, sizes: np.ndarray, anchors: np.ndarray, ids: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(entry, offset) of the strings of phrases that a phrase of a smaller document has too.

    Phrases are ``sizes`` bytes of ``data`` from ``begins`` on, with their trigger ``anchors`` bytes
    behind; equal strings have the same trigger at the same place.
    """
    width = -(-length // 8) * 8
    places = np.arange(width)
    inside = lambda at: np.where((at >= 0) & (at < sizes[:, None]), data[np.clip(begins[:, None] + at, 0, len(data) - 1)], 0).astype(np.uint8)
    after, after_shared = shared_bytes(inside(anchors[:, None] + places))
    before, before_shared = shared_bytes(inside(anchors[:, None] - 1 - places))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    left, right = np.empty(len(ids), np.int64), np.empty(len(ids), np.int64)
    for k in range(length - GRAM + 1):  # strings that start k bytes before the trigger
        rows = np.flatnonzero((anchors >= k) & (anchors - k + length <= sizes))
        if len(rows) < 2:
            continue
        left[before], right[after] = np.cumsum(before_shared < k), np.cumsum(after_shared < length - k)
        key = (left[rows] << 32) | right[rows]
        order = np.argsort(key)
        key, docs = key[order], ids[rows[order]]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        least = np.minimum.reduceat(docs, np.flatnonzero(new))[np.cumsum(new) - 1]
        hit = rows[order[docs > least]]
        found.append((hit, anchors[hit] - k))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    entry, offset = (np.concatenate([f[j] for f in found]) for j in (0, 1))
    order = np.lexsort((offset, entry))
    return entry[order], offset[order]


def repeated_strings(opened: DataFrame, length: int, parts: int) -> DataFrame:
    """(id, variant, first, size) of the stretches of open phrases that lie in a smaller document."""
    schema = arrow_schema("id long, variant long, first int, size int")

    def compare(table: pa.Table) -> pa.Table:
        blobs = table["bytes"].combine_chunks()
        offsets = np.frombuffer(blobs.buffers()[1], np.int32)[blobs.offset:blobs.offset + len(blobs) + 1].astype(np.int64)
        begins, sizes, data = offsets[:-1], np.diff(offsets), np.frombuffer(blobs.buffers()[2] or b"", np.uint8)
        trigger, ids, variant, first, anchors = (table[c].to_numpy() for c in ("trigger", "id", "variant", "first", "anchor"))
        order = np.argsort(trigger, kind="stable")
        starts = np.flatnonzero(np.concatenate([[True], trigger[order][1:] != trigger[order][:-1]]))
        stops = np.concatenate([starts[1:], [len(order)]])
        found: list[list[np.ndarray]] = [[], [], [], []]
        at = 0
        while at < len(order):  # whole triggers, together about ENTRIES phrases
            end = int(stops[min(np.searchsorted(stops, at + ENTRIES), len(stops) - 1)])
            rows = order[at:end]
            at = end
            entry, offset = repeated_in(data, begins[rows], sizes[rows], anchors[rows].astype(np.int64), ids[rows], length)
            if len(entry):
                begin = np.flatnonzero(np.concatenate([[True], (offset[1:] != offset[:-1] + 1) | (entry[1:] != entry[:-1])]))
                last = np.concatenate([begin[1:], [len(entry)]]) - 1
                e = rows[entry[begin]]
                for column, value in zip(found, (ids[e], variant[e], first[e] + offset[begin], offset[last] - offset[begin] + length)):
                    column.append(value)
        return pa.Table.from_arrays([pa.array(np.concatenate(f) if f else [], s.type, safe=False) for f, s in zip(found, schema)], schema=schema)

    grouped = opened.withColumn("part", F.pmod(F.xxhash64("trigger"), F.lit(parts))).groupBy("part")
    return in_groups(grouped, compare, "id long, variant long, first int, size int")


def crowded_strings(opened: DataFrame, length: int) -> DataFrame:
    """The same for triggers with very many open phrases: every string is a row and finds its
    smallest document by its own key, so no task holds all phrases of a trigger."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            columns: list[list] = [[], [], [], [], []]
            rows = zip(*(batch.column(c).to_pylist() for c in ("trigger", "id", "variant", "first", "bytes")))
            for trigger, doc, variant, first, raw in rows:
                sums, down = prefix_hashes(np.frombuffer(raw, np.uint8), powers)
                count = max(0, len(raw) - length + 1)
                suffix = (sums[length:length + count] - sums[:count]) * down[:count]
                for column, value in zip(columns, ([trigger] * count, suffix.view(np.int64).tolist(), [doc] * count, [variant] * count, range(first, first + count))):
                    column += value
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    schema = arrow_schema("trigger long, suffix long, id long, variant long, first int")
    strings = in_tasks(opened, run, "trigger long, suffix long, id long, variant long, first int")
    strings = written_table(strings, "crowded-strings")
    least = written_table(strings.groupBy("trigger", "suffix").agg(F.min("id").alias("least")), "crowded-least")
    hits = strings.join(least, ["trigger", "suffix"]).where("id > least")
    return hits.select("id", "variant", "first", F.lit(length).alias("size"))


def cut_texts(docs: DataFrame, ranges: DataFrame) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, kept) with the given byte ranges taken out."""
    schema = arrow_schema("id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    lists = ranges.groupBy("id", "variant").agg(F.collect_list(F.struct("first", "size")).alias("ranges"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            size = 0
            for doc, packed, own in zip(batch.column("id").to_pylist(), batch.column("packed"), batch.column("ranges")):
                whole, pieces, spans, at = unsqueezed(packed.as_py()), [], 0, -1
                kept_from = 0
                for first, end in sorted((r["first"], r["first"] + r["size"]) for r in own.as_py() or ()):
                    if first > at:
                        spans += 1
                        pieces.append(whole[kept_from:first])
                    at = max(at, end)
                    kept_from = at
                rest = b"".join([*pieces, whole[kept_from:]]) if spans else whole
                out.append((doc, len(whole), len(whole) - len(rest), spans, hashlib.sha256(rest).hexdigest(), rest))
                size += len(rest)
                if size >= SLICE:
                    yield rows_of(out, schema)
                    out, size = [], 0
            yield rows_of(out, schema)

    joined = squeezed(docs).join(lists, ["id", "variant"], "left").select("id", "packed", "ranges")
    return in_tasks(joined, run, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def repeated_passages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50,
    hot_in_flush: int = HOT_IN_FLUSH, hot_in_all: int = HOT_IN_ALL,
) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_removed, n_spans, kept_sha256, kept (bytes).

    A byte goes if it is covered by a string of ``length`` bytes that also starts in a document
    with a smaller id; strings are judged on the input and never cross documents. Null text counts
    as empty. Documents with one id are not smaller than each other. A row without id keeps its
    text and takes nothing from others. Extra columns are ignored; an empty table gives no rows.

    Exact copies are settled by their digest and are not parsed. The two bounds say from when on
    the phrases of one trigger are spread over tasks; they change no result.
    """
    ship_package(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    heads = written_table(texts.select("id", digest.alias("digest"), F.octet_length("text").cast("long").alias("size")), "heads")
    known = heads.where("id IS NOT NULL")
    # ids that stand for several texts: each text of them has a number of its own, by a sort over ranges
    several = written_table(known.groupBy("id").agg(F.min("digest").alias("low"), F.max("digest").alias("high")).where("low < high").select("id"), "several")
    unique = several.isEmpty()
    if not unique:
        kinds = known.join(broadcast_if_small(several, 2_000_000), "id", "left_semi").select("id", "digest").distinct()
        several = written_table(enumerate_rows(kinds, "id", "digest", name="variant"), "variants")
    numbered = lambda df: df.withColumn("variant", F.lit(0).cast("long")) if unique else (
        df.join(several, ["id", "digest"], "left").withColumn("variant", F.coalesce("variant", F.lit(0).cast("long")))
    )
    texts = numbered(texts if unique else texts.withColumn("digest", digest)).select("id", "variant", "text")
    firsts = known.groupBy("digest").agg(F.min("id").alias("smallest"), F.max("id").alias("largest")).where("smallest < largest")
    copies = written_table(
        numbered(known.join(firsts.select("digest", "smallest"), "digest").where("id > smallest").distinct()).select("id", "variant", "size"), "copies"
    )
    total = known.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    buckets = int(total // BUCKET + 1)

    skipped = broadcast_if_small(copies.select("id", "variant"), 2_000_000)
    originals = texts.where(F.col("id").isNotNull() & (F.octet_length("text") >= length)).join(skipped, ["id", "variant"], "left_anti")
    settled = written_table(dictionary(parse(originals, length, buckets, hot_in_flush)), "phrases")
    asked = settled.where("NOT known").select("id", "variant", "trigger", "first", "span", "anchor")
    crowds = written_table(asked.groupBy("trigger").agg(F.count("*").alias("n")).where(F.col("n") > hot_in_all).select("trigger"), "crowds")
    opened = open_phrases(texts, asked, length)
    if crowds.isEmpty():
        more = repeated_strings(opened, length, buckets)
    else:
        opened = written_table(opened, "open-phrases")
        by_trigger = opened.join(broadcast_if_small(crowds, 2_000_000), "trigger", "left_anti")
        crowded = opened.join(broadcast_if_small(crowds, 2_000_000), "trigger", "left_semi")
        more = repeated_strings(by_trigger, length, buckets).union(crowded_strings(crowded, length))
    ranges = (
        settled.where("known").select("id", "variant", "first", (F.col("span") + length).cast("int").alias("size"))
        .union(more)
        .union(copies.where(F.col("size") >= length).select("id", "variant", F.lit(0).alias("first"), F.col("size").cast("int")))
    )
    return cut_texts(texts, ranges)
