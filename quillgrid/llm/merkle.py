"""Merkle manifest of a dataset: a hash tree per language under one root, with a proof per row.

The place of a leaf is found by rank queries, not by sorting leaves. Every task sets the bits of its
ids in words of 64 ids per group; the words of a group are merged by OR, and only words with an id in
them exist, so a sparse group is as small as its ids. A directory holds, for each word, how many leaves of its
group come before it (running counts of the words, dealt by ranges); the place of a leaf is that
count plus the set bits below its own. Ids that several rows hold cannot be told apart by bits: only
these rows are numbered, by (id, leaf).

The tree is reduced by slot arrays: 1024 consecutive nodes of a group are one row, of which a task
computes up to ten levels. The roots of these arrays are the next round's nodes, so a group of any
size takes a few rounds of equal, small tasks. Proofs are handed down the same rounds.

Null values are ``-``; a null language is a group of its own and comes first; rows without id come
first in their group. Rows that share an id are leaves of their own, in the order of their digests. An
empty table gives an empty result; other columns take no part.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordering import enumerate_rows
from ..session import broadcast_if_small, constant_frame, written_table
from .common import per_batch

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SLOT_BITS = 10
WORD_BITS = 6
NO_ID = -(1 << 60)  # the word of rows without id, before every other
DIRECTORY_BROADCAST = 1_000_000  # rows of about 40 bytes
GROUPS_BROADCAST = 100_000

MANIFEST_SQL = """
    WITH RECURSIVE
    rows AS (
        SELECT doc_id, coalesce('=' || lang, '') AS tree, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos,
               coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
               || coalesce(strlen(lang) || ':' || lang, '-') AS head,
               coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS size,
               coalesce(strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1), '-') AS more,
               coalesce(strlen(text) || ':' || text, '-') AS tail,
               list_reduce(
                   list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, len(CAST(doc_id AS VARCHAR)) + 1), lambda i: CAST(ascii(CAST(doc_id AS VARCHAR)[i]) AS BIGINT))),
                   lambda crc, byte: list_reduce(
                       list_prepend(xor(crc, byte), [CAST(0 AS BIGINT) FOR k IN range(8)]),
                       lambda c, zero: xor(c >> 1, (c & 1) * 3988292384)
                   )
               ) AS crc
        FROM documents
    ),
    leaves AS (
        SELECT doc_id, tree, pos, sha256(head || size || tail) AS leaf,
               CASE WHEN xor(crc, 4294967295) % 7 = 0 THEN sha256(head || more || tail) ELSE sha256(head || size || tail) END AS given
        FROM rows
    ),
    nodes AS (
        SELECT tree, 0 AS level, pos, leaf AS node, count(*) OVER (PARTITION BY tree) AS total FROM leaves
        UNION ALL
        SELECT tree, level + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), (max(total) + 1) // 2
        FROM nodes WHERE total > 1 GROUP BY tree, level, pos // 2
    ),
    subroots AS (SELECT tree, node AS subroot, row_number() OVER (ORDER BY tree) - 1 AS place FROM nodes WHERE total = 1),
    tops AS (
        SELECT 0 AS level, place AS pos, subroot AS node, count(*) OVER () AS total FROM subroots
        UNION ALL
        SELECT level + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), (max(total) + 1) // 2
        FROM tops WHERE total > 1 GROUP BY level, pos // 2
    ),
    steps AS (
        SELECT doc_id, n.level, l.pos >> n.level AS at, node AS sibling FROM leaves l JOIN nodes n
        ON n.tree = l.tree AND n.pos = xor(l.pos >> n.level, CAST(1 AS BIGINT)) WHERE total > 1
        UNION ALL
        SELECT doc_id, 1000 + t.level, s.place >> t.level, t.node FROM leaves JOIN subroots s USING (tree) JOIN tops t
        ON t.pos = xor(s.place >> t.level, CAST(1 AS BIGINT)) WHERE total > 1
    ),
    proofs AS (SELECT doc_id, sha256(string_agg(sibling, '' ORDER BY level)) AS proof_sha256 FROM steps GROUP BY doc_id),
    heights AS (SELECT tree, max(level) AS height FROM nodes GROUP BY tree),
    folds AS (
        SELECT doc_id, l.tree, 0 AS level, pos, given AS node FROM leaves l
        UNION ALL
        SELECT f.doc_id, f.tree, f.level + 1, f.pos // 2,
               CASE WHEN n.node IS NULL THEN sha256(f.node) WHEN n.pos < f.pos THEN sha256(n.node || f.node) ELSE sha256(f.node || n.node) END
        FROM folds f JOIN heights h ON h.tree = f.tree AND f.level < h.height
        LEFT JOIN nodes n ON n.tree = f.tree AND n.level = f.level AND n.pos = xor(f.pos, CAST(1 AS BIGINT))
    ),
    top_folds AS (
        SELECT doc_id, 0 AS level, place AS pos, node FROM folds f JOIN heights h ON h.tree = f.tree AND level = height JOIN subroots s ON s.tree = f.tree
        UNION ALL
        SELECT f.doc_id, f.level + 1, f.pos // 2,
               CASE WHEN t.node IS NULL THEN sha256(f.node) WHEN t.pos < f.pos THEN sha256(t.node || f.node) ELSE sha256(f.node || t.node) END
        FROM top_folds f JOIN (SELECT max(level) AS height FROM tops) ON f.level < height
        LEFT JOIN tops t ON t.level = f.level AND t.pos = xor(f.pos, CAST(1 AS BIGINT))
    ),
    root AS (SELECT level AS height, node AS root FROM tops WHERE total = 1)
    SELECT doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, t.node AS folded_root, t.node = root AS verified
    FROM leaves JOIN subroots USING (tree) CROSS JOIN root LEFT JOIN proofs USING (doc_id)
    JOIN top_folds t USING (doc_id) WHERE t.level = height
"""


def encoded(value: Column) -> Column:
    """Byte count, colon, value; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_rows(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """(tree, id, word, bit, leaf, forged, row): the leaf of each row and, where ``tampered`` holds and
    n_chars is not null, the leaf of the row with one character more."""
    columns = {name: F.col(f"`{name}`") for name in FIELDS}
    digest = lambda changed: F.unhex(F.sha2(F.concat(*[encoded({**columns, **changed}[name]) for name in FIELDS]), 256))
    more = (columns["n_chars"].cast("decimal(20,0)") + 1).cast("string")
    forged = F.when(F.coalesce(tampered, F.lit(False)), digest({"n_chars": more})) if tampered is not None else F.lit(None).cast("binary")
    identity = columns["doc_id"].cast("long")
    return docs.select(
        F.coalesce(F.concat(F.lit("="), columns["lang"]), F.lit("")).alias("tree"),
        identity.alias("id"),
        F.coalesce(F.shiftright(identity, WORD_BITS), F.lit(NO_ID)).alias("word"),
        F.coalesce(F.call_function("shiftleft", F.lit(1).cast("long"), identity.bitwiseAND(63).cast("int")), F.lit(0)).cast("long").alias("bit"),
        digest({}).alias("leaf"), forged.alias("forged"), F.monotonically_increasing_id().alias("row"),
    )


@dataclass(frozen=True)
class RankIndex:
    """directory(tree, word, bits, leaves, before) and sizes(tree, total)."""

    directory: DataFrame
    sizes: DataFrame


def rank_index(leaves: DataFrame) -> RankIndex:
    """Merge the bitmaps of all tasks and count, for every word, the leaves of its tree before it."""
    words = written_table(leaves.groupBy("tree", "word").agg(F.bit_or("bit").alias("bits"), F.count("*").alias("leaves")), "words")
    ranges = written_table(words.repartitionByRange("tree", "word").withColumn("part", F.spark_partition_id()), "word-ranges")
    earlier = lambda *keys: Window.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, -1)
    parts = ranges.groupBy("tree", "part").agg(F.sum("leaves").alias("size"))
    # as many rows as there are trees and ranges
    offsets = written_table(parts.withColumn("offset", F.coalesce(F.sum("size").over(earlier("tree", "part")), F.lit(0))), "offsets")
    within = ranges.withColumn("inside", F.coalesce(F.sum("leaves").over(earlier("tree", "part", "word")), F.lit(0)))
    directory = within.join(broadcast_if_small(offsets, GROUPS_BROADCAST), ["tree", "part"]).select(
        "tree", "word", "bits", "leaves", (F.col("inside") + F.col("offset")).alias("before")
    )
    sizes = written_table(offsets.groupBy("tree").agg(F.sum("size").alias("total")), "tree-sizes")
    return RankIndex(written_table(directory, "directory"), sizes)


def ranked(leaves: DataFrame, index: RankIndex) -> DataFrame:
    """The leaves with their ``position`` in their tree."""
    directory = broadcast_if_small(index.directory, DIRECTORY_BROADCAST)
    found = leaves.join(directory, ["tree", "word"])
    columns = ["tree", "id", "leaf", "forged"]
    alone = F.col("leaves") == F.greatest(F.bit_count("bits"), F.lit(1))
    lower = F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("long"), F.col("id").bitwiseAND(63).cast("int")))
    smaller = F.coalesce(F.bit_count(F.col("bits").bitwiseAND(lower)), F.lit(0))
    plain = found.where(alone).select(*columns, (F.col("before") + smaller).alias("position"))
    if index.directory.where(~alone).isEmpty():
        return plain
    # words in which rows share an id: these rows alone are numbered, and a word's numbers are consecutive
    numbered = enumerate_rows(found.where(~alone), "tree", "id", "leaf", "row", name="at")
    numbered = written_table(numbered, "shared-ids")
    first = written_table(numbered.groupBy("tree", "word").agg(F.min("at").alias("first_at")), "first-shared")
    shared = numbered.join(broadcast_if_small(first, DIRECTORY_BROADCAST), ["tree", "word"])
    return plain.unionByName(shared.select(*columns, (F.col("before") + F.col("at") - F.col("first_at")).alias("position")))


def slot_arrays(nodes: DataFrame, sizes: DataFrame, *payload: str) -> DataFrame:
    """Nodes (tree, position, node ...) as rows of 1024 slots: (tree, block, total, slots), written."""
    slot = F.struct(F.col("position").bitwiseAND((1 << SLOT_BITS) - 1).alias("slot"), "node", *payload)
    arrays = nodes.groupBy("tree", F.shiftright("position", SLOT_BITS).alias("block")).agg(F.collect_list(slot).alias("slots"))
    return written_table(arrays.join(broadcast_if_small(sizes, GROUPS_BROADCAST), "tree"), "slot-arrays")


def joined_digest(*digests: str) -> str:
    return sha256("".join(digests).encode()).hexdigest()


def in_slots(slots: list[dict]) -> list[dict]:
    placed = [None] * len(slots)
    for entry in slots:
        placed[entry["slot"]] = entry
    return placed


def tree_levels(slots: list[dict], total: int) -> list[list[str]]:
    """The levels above one array, from its own nodes to the node that stands for it.

    ``total`` nodes of the whole tree tell how many levels are left; an array at the end of a level
    with one node is hashed alone, like any last run.
    """
    levels = [[entry["node"].hex() for entry in in_slots(slots)]]
    for _ in range(min(SLOT_BITS, (total - 1).bit_length())):
        below = levels[-1]
        levels.append([joined_digest(*below[i:i + 2]) for i in range(0, len(below), 2)])
    return levels


def siblings(levels: list[list[str]], place: int) -> str:
    """The path of one slot: per level L or R (side of the sibling) and its digest, or N without one."""
    path = []
    for level in levels[:-1]:
        other = place ^ 1
        path.append("N" if other >= len(level) else ("L" if other < place else "R") + level[other])
        place >>= 1
    return "".join(path)


def steps(path: str):
    """(side, digest) of every entry of a path."""
    at = 0
    while at < len(path):
        width = 1 if path[at] == "N" else 65
        yield path[at], path[at + 1:at + width]
        at += width


def folded(leaf: str, path: str) -> str:
    for side, digest in steps(path):
        leaf = joined_digest(digest, leaf) if side == "L" else joined_digest(leaf, digest)
    return leaf


def reduced(arrays: DataFrame) -> DataFrame:
    """(tree, position, total, node): one node per array, with the number of nodes at its level."""

    def reduce(rows):
        nodes = [bytes.fromhex(tree_levels(slots, total)[-1][0]) for slots, total in zip(rows["slots"], rows["total"])]
        return {"tree": rows["tree"], "position": rows["block"], "total": [-(-t >> SLOT_BITS) for t in rows["total"]], "node": nodes}

    return written_table(per_batch(arrays, "tree string, position long, total long, node binary", reduce), "nodes")


def climbed(arrays: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """All rounds of slot arrays, and the root (tree, node) of every tree."""
    rounds, roots = [], []
    while True:
        rounds.append(arrays)
        nodes = reduced(arrays)
        roots.append(nodes.where("total = 1").select("tree", "node"))
        nodes = nodes.where("total > 1")
        if nodes.isEmpty():
            break
        sizes = nodes.select("tree", "total").distinct()
        arrays = slot_arrays(nodes.drop("total"), written_table(sizes, "tree-sizes"))
    tops = roots[0]
    for more in roots[1:]:
        tops = tops.unionByName(more)
    return rounds, written_table(tops, "roots")


def paths_down(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """The first round's arrays with ``path``, the siblings above their own levels.

    ``above`` (tree, path) is what lies over the root of each tree.
    """

    def hand_down(rows):
        out = {"tree": [], "block": [], "path": []}
        for tree, block, total, slots, path in zip(*(rows[c] for c in ("tree", "block", "total", "slots", "path"))):
            levels = tree_levels(slots, total)
            for place in range(len(slots)):
                out["tree"].append(tree)
                out["block"].append((block << SLOT_BITS) + place)
                out["path"].append(siblings(levels, place) + path)
        return out

    top = broadcast_if_small(above, GROUPS_BROADCAST)
    arrays = None
    for depth in range(len(rounds) - 1, -1, -1):
        # a tree of one array ends here; the arrays of larger ones were slots of the round above
        ends = F.col("total") <= 1 << SLOT_BITS
        under = rounds[depth].where(ends).join(top, "tree")
        if arrays is not None:
            handed = written_table(per_batch(arrays, "tree string, block long, path string", hand_down), "paths")
            under = under.unionByName(rounds[depth].where(~ends).join(handed, ["tree", "block"]).select(*under.columns))
        arrays = under
    return arrays


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """(id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row.

    ``tampered`` marks rows whose root is folded again from a leaf with one character more.
    """
    spark = docs.sparkSession
    leaves = written_table(leaf_rows(docs, tampered), "leaves")
    schema = "id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    if leaves.isEmpty():
        return spark.createDataFrame([], schema)
    index = rank_index(leaves)
    positions = ranked(leaves, index).withColumnRenamed("leaf", "node")
    rounds, subroots = climbed(slot_arrays(positions, index.sizes, "id", "forged"))
    # the roots of the trees are the leaves of one more tree
    numbered = enumerate_rows(subroots, "tree", name="position").withColumnRenamed("tree", "group")
    trees = subroots.count()
    whole = constant_frame(spark, [("", trees)], "tree string, total long")
    top_rounds, tops = climbed(slot_arrays(numbered.withColumn("tree", F.lit("")), whole, "group"))
    root = tops.first()["node"].hex()

    def over_groups(rows):
        out = {"tree": [], "path": [], "subroot": []}
        for total, slots, path in zip(rows["total"], rows["slots"], rows["path"]):
            levels = tree_levels(slots, total)
            for place, entry in enumerate(in_slots(slots)):
                out["tree"].append(entry["group"])
                out["path"].append(siblings(levels, place) + path)
                out["subroot"].append(levels[0][place])
        return out

    top_arrays = paths_down(top_rounds, constant_frame(spark, [("", "")], "tree string, path string"))
    above = written_table(per_batch(top_arrays, "tree string, path string, subroot string", over_groups), "above")
    arrays = paths_down(rounds, above.select("tree", "path")).join(broadcast_if_small(above.select("tree", "subroot"), GROUPS_BROADCAST), "tree")

    def prove(rows):
        out = {name: [] for name in ("id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")}
        for total, slots, path, subroot in zip(*(rows[c] for c in ("total", "slots", "path", "subroot"))):
            levels = tree_levels(slots, total)
            for place, entry in enumerate(in_slots(slots)):
                whole_path = siblings(levels, place) + path
                leaf = levels[0][place]
                again = folded(entry["forged"].hex() if entry["forged"] else leaf, whole_path)
                proof = joined_digest(*(digest for _, digest in steps(whole_path)))
                for name, value in zip(out, (entry["id"], leaf, subroot, root, proof, again, again == root)):
                    out[name].append(value)
        return out

    return per_batch(arrays, schema, prove)
