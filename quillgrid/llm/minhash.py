"""MinHash near-duplicates with circulant signatures and exact verification.

One permutation places a shingle on a circle, a second one, read from that place onwards, gives
all coordinates of the signature: coordinate k of a set is the minimum of ``pi[place + k]``. Bands
of the signature propose pairs; every link is confirmed on the full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written_table
from .common import in_tasks, narrow, small_list, without_ids
from .components import components

# Parameters: a pair at the threshold shares no band with probability (1 - 0.8^8)^64 = 8e-6.
BANDS, ROWS = 64, 8
CIRCLE = 1 << 20
SEED = 20_240_601
MEMO = 1 << 18
ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser on every element."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(text: str, width: int, memo: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; fewer words than ``width`` make one shingle."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    size = min(width, len(words))
    out = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        out = mixed(out * ODD + hashes[k:len(words) - size + 1 + k])
    return np.unique(out)


class Circle:
    """The second permutation, prolonged so that every shifted reading is one slice."""

    def __init__(self, coordinates: int = BANDS * ROWS):
        order = np.random.Generator(np.random.PCG64(SEED)).permutation(CIRCLE).astype(np.int32)
        self.readings = np.lib.stride_tricks.sliding_window_view(np.concatenate([order, order[:coordinates]]), coordinates)

    def signature(self, values: np.ndarray) -> np.ndarray:
        places = (mixed(values + ODD) >> np.uint64(44)).astype(np.int64)  # the first permutation
        low = self.readings[places[0]].copy()
        for at in range(0, len(places), 64):
            np.minimum(low, self.readings[places[at:at + 64]].min(axis=0), out=low)
        return low


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """(documents, BANDS) keys; the number of the band is part of its key."""
    parts = signatures.reshape(len(signatures), BANDS, ROWS).astype(np.uint64)
    keys = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), parts.shape[:2])
    for k in range(ROWS):
        keys = mixed(keys * ODD + parts[:, :, k])
    return keys.view(np.int64)


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """(id, n, digest, bands) per document; the digest names the shingle set."""
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("bands", pa.list_(pa.int64()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, circle = WordHashes(), Circle()
        for batch in batches:
            sizes, digests, bands = [], [], []
            known: dict[bytes, np.ndarray] = {}
            for text in batch.column("text"):
                values = shingles(text.as_py(), width, memo)
                digest = xxhash.xxh3_128_digest(values.tobytes())
                if digest not in known:
                    known[digest] = band_keys(circle.signature(values)[None])[0] if len(values) else np.empty(0, np.int64)
                sizes.append(len(values))
                digests.append(digest)
                bands.append(known[digest])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(bands, schema.field("bands").type)],
                schema=schema,
            )

    return in_tasks(docs, run, "id long, n long, digest binary, bands array<long>")


def full_sets(docs: DataFrame, width: int) -> DataFrame:
    """(id, n, members) with the whole shingle set as sorted 64-bit numbers."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for batch in batches:
            sets = [shingles(text.as_py(), width, memo) for text in batch.column("text")]
            yield pa.RecordBatch.from_pydict(
                {"id": batch.column("id"), "members": pa.array([s.tobytes() for s in sets], pa.binary())}
            )

    return in_tasks(docs, run, "id long, members binary")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets satisfy 100 * intersection >= percent * union."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                left, right = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = len(np.intersect1d(left, right, assume_unique=True))
                keep.append(100 * both >= percent * (len(left) + len(right) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("id").alias("a"), F.col("members").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("members").alias("y"))
    return in_tasks(pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y"), run, "a long, b long")


def labelled(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """``rows`` (h, rep) with the component found so far."""
    named = groups.select(F.col("id").alias("rep"), "component")
    return rows.join(named, "rep", "left").withColumn("component", F.coalesce("component", "rep"))


def open_rows(rows: DataFrame) -> DataFrame:
    """Rows (h, rep, component) of the groups h with several components, and the largest of these as ``lead``."""
    parts = rows.groupBy("h", "component").agg(F.count("*").alias("size"))
    leading = parts.groupBy("h").agg(F.max(F.struct("size", "component")).alias("top"), F.count("*").alias("parts")).where("parts > 1")
    leading = written_table(leading.select("h", F.col("top.component").alias("lead")), "leading")
    return written_table(rows.join(leading, "h"), "open")


def cross_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that may be linked, each once; rows are (h, rep, n, place, component).

    Sets of n and m members that are linked have at least ``shared`` members in common, so the
    first one of these stands no later than n - shared + 1 in the one and m - shared + 1 in the
    other. The largest component of a shingle is not paired with itself: the rest is joined with
    all, so a shingle of one component, however common, costs nothing here.
    """
    opened = open_rows(rows)
    side = lambda df, s: df.select("h", *[F.col(c).alias(f"{c}_{s}") for c in ("rep", "n", "place", "component")])
    n, m = F.col("n_p"), F.col("n_q")
    shared = F.ceil((n + m) * percent / (100 + percent) - 1e-9)
    possible = (
        (F.col("component_p") != F.col("component_q")) & (n * 100 >= m * percent) & (m * 100 >= n * percent)
        & (F.col("place_p") <= n - shared + 1) & (F.col("place_q") <= m - shared + 1)
    )
    pairs = side(opened.where("component <> lead"), "p").join(side(opened, "q"), "h").where(possible)
    return pairs.select(F.greatest("rep_p", "rep_q").alias("a"), F.least("rep_p", "rep_q").alias("b")).distinct()


def pivots(rows: DataFrame, tries: int = 3) -> DataFrame:
    """Pairs (a, b) of each class with the most central classes of its buckets.

    A class is central if it shares its buckets with many: in a group of near copies that is the
    one with the fewest changes, which most others are close to.
    """
    sizes = rows.groupBy("h").agg(F.count("*").alias("m"))
    central = written_table(rows.join(written_table(sizes, "sizes"), "h").groupBy("rep").agg(F.sum("m").alias("c")), "central")
    best = rows.join(central, "rep").groupBy("h").agg(F.max(F.struct("c", (-F.col("rep")).alias("r"))).alias("p"))
    asked = rows.join(written_table(best, "pivots"), "h").where(F.col("rep") != -F.col("p.r"))
    # a class has at most BANDS buckets
    chosen = asked.groupBy("rep").agg(F.slice(F.sort_array(F.collect_set("p"), asc=False), 1, tries).alias("p"))
    pairs = chosen.select("rep", F.explode("p.r").alias("r")).select(F.col("rep").alias("x"), (-F.col("r")).alias("y"))
    return pairs.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()


COUNTERS = 1 << 21
COUNTER_SHIFT = np.uint64(64 - 21)


def frequencies(sets: DataFrame) -> np.ndarray:
    """How many sets hold the shingles of each of COUNTERS bins: a bounded table of counts."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int32)
        for batch in batches:
            held = np.frombuffer(b"".join(batch.column("members").to_pylist()), np.uint64)
            bins, n = np.unique((held >> COUNTER_SHIFT).astype(np.int32), return_counts=True)
            total[bins] += n.astype(np.int32)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bin": pa.array(held, pa.int32()), "n": pa.array(total[held], pa.int64())})

    rows = in_tasks(sets.select("members"), count, "bin int, n long").groupBy("bin").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(COUNTERS, np.int32)
    out[rows["bin"].to_numpy()] = np.minimum(rows["n"].to_numpy(), np.iinfo(np.int32).max)
    return out


def prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """(rep, n, place, h): the rarest shingles of each set, so many that two linked sets share one of them.

    Sets of n and m members with the similarity share a member among the first
    n - ceil(percent / 100 n) + 1 of either, in any one order of all members. Rare ones come first
    here: near copies are full of common shingles, and those that differ too much to be linked
    have a prefix of their own.
    """
    common = frequencies(sets)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            reps, sizes, firsts, places = [], [], [], []
            for rep, members in zip(batch.column("id").to_pylist(), batch.column("members")):
                values = np.frombuffer(members.as_py(), np.uint64)
                n = len(values)
                length = n - (percent * n + 99) // 100 + 1
                order = np.lexsort((values, common[(values >> COUNTER_SHIFT).astype(np.int64)]))
                chosen = values[order[:length]].view(np.int64)
                reps.append(np.full(len(chosen), rep))
                sizes.append(np.full(len(chosen), n))
                firsts.append(chosen)
                places.append(np.arange(1, len(chosen) + 1))
            columns = zip(("rep", "n", "place", "h"), (reps, sizes, places, firsts))
            yield pa.RecordBatch.from_pydict({name: pa.array(np.concatenate(parts), pa.int64()) for name, parts in columns})

    return in_tasks(sets.select("id", "members"), run, "rep long, n long, place long, h long")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80, tries: int = 3
) -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row of ``docs``.

    Documents are linked if 100 * |A and B| >= percent * |A or B| on their sets of ``width``-word
    shingles; a component is what links connect, named by its smallest id. Equal sets are one
    class, so copies are never paired. Each class is first compared with ``tries`` central classes
    of its buckets, which joins large groups of near copies in linear work. Classes whose buckets
    then still hold several components are compared across components, all of them that share one
    of their rarest shingles, without which no link is possible.

    Null and blank texts have no shingles and are linked with nothing. Rows that repeat an id are
    one document; a row without id gets no component and is kept. Extra columns are ignored; an
    empty table gives no rows.
    """
    texts = narrow(docs, id_col, text_col)
    drawn = written_table(sketches(texts, width), "sketches")
    known = drawn.where("id IS NOT NULL AND n > 0")
    classes = written_table(known.groupBy("digest").agg(F.min("id").alias("rep"), F.first("bands").alias("bands")), "classes")
    bands = classes.select("rep", F.explode("bands").alias("h"))
    shared = written_table(bands.groupBy("h").agg(F.count("*").alias("m")).where("m > 1").select("h"), "buckets")
    rows = written_table(bands.join(shared, "h"), "bucket-rows")
    needed = small_list(rows.select(F.col("rep").alias("id")), "needed")
    sets = written_table(full_sets(texts.join(needed, "id", "left_semi"), width), "sets")

    # rows that repeat an id link its classes without a comparison
    members = known.select("id", "digest").join(classes.select("digest", "rep"), "digest")
    links = members.groupBy("id").agg(F.min("rep").alias("b"), F.max("rep").alias("a")).where("a <> b").select("a", "b")
    links = written_table(links.union(confirmed(pivots(rows, tries), sets, percent)), "links")
    groups = components(links)
    undecided = open_rows(labelled(rows, groups)).select(F.col("rep").alias("id")).distinct()
    some = written_table(sets.join(undecided, "id", "left_semi"), "undecided")
    rest = confirmed(cross_pairs(labelled(prefixes(some, percent), groups), percent), sets, percent)
    groups = components(written_table(links.union(rest), "links"))

    named = classes.select("digest", "rep").join(groups.select(F.col("id").alias("rep"), "component"), "rep", "left")
    named = written_table(named.select("digest", F.coalesce("component", "rep").alias("component")), "named")
    base = drawn.select("id", "n", F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("digest")).alias("digest"))
    placed = base.where("digest IS NOT NULL").join(named, "digest").select("id", "n", "component")
    alone = base.where("digest IS NULL").select("id", "n", F.col("id").alias("component"))
    return placed.union(alone).select(
        "id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"),
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group of near duplicates, with all columns; the others go."""
    return without_ids(docs, id_col, near_duplicates(docs, id_col, text_col, width, percent).where("NOT kept").select("id"))
