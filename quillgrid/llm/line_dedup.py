"""Frequent lines: which lines of which documents go, as compressed bitmaps instead of texts.

A line's key is the line without white space ``[\\x20\\x09-\\x0D]`` at its ends, A-Z lower-cased. Keys of
at least ``least_chars`` code points that at least ``least_docs`` documents hold keep their lines in
the document with the largest id only.

Each long line becomes two 64-bit hashes of its key, the document and its position. These rows
are dealt by ranges of (hash, document) and sorted by (hash, document, position) inside a range, so a
line that a third of all documents hold is many ranges, and never one task. The first row of each
(hash, document) in that order counts the document; the counts of a hash are added up over its ranges.
The positions of dropped lines are then joined by bits into words of 64 lines, and only words in which
a line goes are stored. Texts are read once more to apply the bitmaps.

Rows without text hold one empty line. Rows that share an id are one document, and rows without id
are one document before all others; rows that share an id keep bitmaps of their own, by a hash of
their text. An empty table gives an empty result, and other columns take no part whatever their names.
Keys are told apart by 128 bits of hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import broadcast_if_small, written_table
from .common import narrow

SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_CHARS, LEAST_DOCS = 40, 5
FREQUENT_BROADCAST = 500_000  # rows of 32 bytes
KEY = ["hash_1", "hash_2"]

LINES_SQL = r"""
    WITH lines AS (
        SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
        FROM documents
    ),
    keyed AS (
        SELECT doc_id, pos, line,
               translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
        FROM lines
    ),
    frequent AS (
        SELECT key, max(doc_id) AS last_doc FROM keyed WHERE length(key) >= 40
        GROUP BY key HAVING count(DISTINCT doc_id) >= 5
    ),
    judged AS (
        SELECT doc_id, pos, line, last_doc IS NOT NULL AND doc_id <> last_doc AS dropped
        FROM keyed LEFT JOIN frequent USING (key)
    )
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
    FROM judged GROUP BY doc_id
"""


def line_key(line: Column) -> Column:
    bare = F.btrim(line, F.lit(SPACE))
    ascii_only = F.octet_length(bare) == F.length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def text_lines(text: Column) -> Column:
    return F.split(text, "\n")


def text_version(text: Column) -> Column:
    """Tells rows of one id apart; rows with equal id and text share all decisions."""
    return F.xxhash64(text)


def hashed_lines(docs: DataFrame, id_col: str, text_col: str, least_chars: int) -> DataFrame:
    """(hash_1, hash_2, id, version, pos) of every line with a key of at least ``least_chars`` code points."""
    texts = narrow(docs, id_col, text_col)
    lines = texts.select("id", text_version(F.col("text")).alias("version"), F.posexplode(text_lines(F.col("text"))).alias("pos", "line"))
    long = lines.where(F.length(F.btrim("line", F.lit(SPACE))) >= least_chars).withColumn("key", line_key(F.col("line")))
    return long.select(F.xxhash64("key").alias("hash_1"), F.xxhash64(F.lit(1), "key").alias("hash_2"), "id", "version", "pos")


def frequent_lines(lines: DataFrame, least_docs: int) -> DataFrame:
    """(hash_1, hash_2, last_id) of the keys in at least ``least_docs`` documents.

    Window and aggregate find the ranges of (hash, id) as they need them: nothing is dealt again
    but one row per hash and range.
    """
    ordered = lines.repartitionByRange(*KEY, "id").sortWithinPartitions(*KEY, "id", "version", "pos")
    arrival = F.row_number().over(Window.partitionBy(*KEY, "id").orderBy("version", "pos"))
    firsts = ordered.withColumn("arrival", arrival).where("arrival = 1")
    counted = firsts.groupBy(*KEY).agg(F.count("*").alias("docs"), F.max("id").alias("last_id"))
    return counted.where(F.col("docs") >= least_docs).select(*KEY, "last_id")


def drop_bitmaps(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS
) -> DataFrame:
    """(id, version, n_dropped, words) of each document that loses a line.

    ``words`` lists (word, bits) by word: bit b of word w is set if line 64 * w + b goes. Words
    without such a line are left out, as are documents that keep all lines.
    """
    lines = written_table(hashed_lines(docs, id_col, text_col, least_chars), "lines")
    frequent = broadcast_if_small(written_table(frequent_lines(lines, least_docs), "frequent-lines"), FREQUENT_BROADCAST)
    going = lines.join(frequent, KEY).where(~F.col("id").eqNullSafe(F.col("last_id")))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("pos") % 64)
    words = going.groupBy("id", "version", F.floor(F.col("pos") / 64).cast("int").alias("word")).agg(F.bit_or(bit).alias("bits"))
    return words.groupBy("id", "version").agg(
        F.sum(F.bit_count("bits")).alias("n_dropped"), F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("words")
    )


def line_goes(words: Column, pos: Column) -> Column:
    """Whether the bitmap drops the line at ``pos``; a document without a bitmap drops none."""
    of_word = F.filter(words, lambda w: w["word"] == F.floor(pos / 64).cast("int"))
    bits = F.try_element_at(of_word, F.lit(1))["bits"]
    return F.coalesce(F.getbit(bits, (pos % 64).cast("int")) == 1, F.lit(False))


def kept_lines(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_lines, n_dropped, kept): the texts without the lines that ``bitmaps`` drops.

    The join is by (id, text hash) with one row on the right, and both sides are plain tables, so
    adaptive execution may split rows that share id and text.
    """
    texts = narrow(docs, id_col, text_col).withColumn("version", text_version(F.col("text")))
    stored = written_table(bitmaps, "bitmaps")
    same = texts["id"].eqNullSafe(stored["id"]) & (texts["version"] == stored["version"])
    joined = texts.join(stored, same, "left").select(texts["id"], "text", "n_dropped", "words")
    lines = text_lines(F.col("text"))
    kept = F.filter(lines, lambda line, pos: ~line_goes(F.col("words"), pos))
    return joined.select(
        "id", F.size(lines).cast("long").alias("n_lines"), F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("words").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("kept"),
    )


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """:func:`kept_lines` by the bitmaps of the same table."""
    return kept_lines(docs, drop_bitmaps(docs, id_col, text_col, **limits), id_col, text_col)
