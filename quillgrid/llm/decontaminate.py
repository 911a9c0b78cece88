"""Benchmark decontamination by template canonicalisation, in DataFrame functions only.

Numbers, names and units become typed placeholders, so a question whose values were replaced
keeps its template. Windows of the templates are joined by hash. On every alignment of a document
with an item the slots must agree: one value of the item always stands for one value of the
document. Windows without an agreeing alignment do not count.

Each text is read in three ways that have the same words at the same places: with its names as
placeholders, with every word in lower case, and with a capitalised word at the start of a
sentence also a name if the text has it as a name elsewhere. Windows of any two readings may meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_if_small, written_table
from .common import small_list, without_ids

# Measuring words that follow a number.
UNITS = (
    "km m cm mm kg g mg lb lbs oz l ml h hr hrs hour hours min mins minute minutes s sec second seconds day days week "
    "weeks month months year years mph kmh dollar dollars euro euros cent cents percent degrees mile miles feet foot inch "
    "inches meter meters metre metres gram grams kilogram kilograms litre litres liter liters hz khz mhz ghz kb mb gb tb kw mw"
).split()
MARK = ""
WINDOW = 8
LEAST_LITERAL = 4
LEAST_WINDOWS = 2
NAMED, FOLDED, COMPLETED = 0, 1, 2

# The steps that mark a text, as (pattern, replacement); group references are written {1}.
NAMES = (r"([\p{L},;] )(\p{Lu})", "{1}" + MARK + "s{2}")
JOINED = (r"([0-9])[.,:/]([0-9])", "{1}_{2}")
SPLIT = (r"[^\p{L}\p{N}_" + MARK + "]+", "  ")
NUMBERS = (r" ([0-9_]+) ", " " + MARK + "n{1} ")
MEASURES = ("(" + MARK + r"n[0-9_]+)  (" + "|".join(UNITS) + ") ", "{1}  " + MARK + "u{2} ")
BARE = (MARK + r"([snu])[^ ]*", MARK + "{1}")
# For the other readings: capitalised words that NAMES has left, and units in spite of that mark.
STARTS = (r"(?<![\p{L}\p{N}_" + MARK + r"])(\p{Lu})", MARK + "c{1}")
START_MEASURES = ("(" + MARK + r"n[0-9_]+)  (?:" + MARK + "c)?(" + "|".join(UNITS) + ") ", "{1}  " + MARK + "u{2} ")


def replaced(text: Column, step: tuple[str, str]) -> Column:
    return F.regexp_replace(text, step[0], step[1].replace("{", "$").replace("}", ""))


def marked(text: Column) -> Column:
    """Lower-cased words between two blanks; placeholders keep their value behind a mark, and so do
    capitalised words that are no names."""
    digits = text.rlike("[0-9]")
    named = replaced(replaced(F.replace(text, F.lit(MARK), F.lit(" ")), NAMES), STARTS)
    joined = F.when(digits, replaced(named, JOINED)).otherwise(named)
    words = F.concat(F.lit(" "), replaced(F.lower(joined), SPLIT), F.lit(" "))
    return F.when(digits, replaced(replaced(words, NUMBERS), START_MEASURES)).otherwise(words)


def token_array(text: Column) -> Column:
    return F.split(F.trim(text), " +")


def without(text: Column, kind: str) -> Column:
    return F.replace(text, F.lit(MARK + kind), F.lit(""))


def readings(rows: DataFrame, text_col: str) -> DataFrame:
    """``rows`` with (reading, tokens) for each reading in place of the text; readings that change nothing are left out."""
    name, start = MARK + "s", MARK + "c"
    found = rows.withColumn("__m", marked(F.col(text_col))).drop(text_col)
    has_name = F.col("__m").contains(name)
    kept = rows.columns[:]
    kept.remove(text_col)
    spoken = lambda kind: F.transform(
        F.filter(token_array(F.col("__m")), lambda w: w.startswith(kind)), lambda w: F.substring(w, 3, 1 << 30)
    )
    found = found.withColumn("__both", F.when(has_name & F.col("__m").contains(start), F.array_intersect(spoken(start), spoken(name))))
    completed = F.transform(
        token_array(F.col("__m")),
        lambda w: F.when(
            w.startswith(start),
            F.when(F.array_contains("__both", F.substring(w, 3, 1 << 30)), F.concat(F.lit(name), F.substring(w, 3, 1 << 30)))
            .otherwise(F.substring(w, 3, 1 << 30)),
        ).otherwise(w),
    )
    each = [
        (NAMED, token_array(without(F.col("__m"), "c"))),
        (FOLDED, F.when(has_name, token_array(without(without(F.col("__m"), "c"), "s")))),
        (COMPLETED, F.when(F.size("__both") > 0, completed)),
    ]
    read = F.array(*[F.struct(F.lit(k).alias("reading"), tokens.alias("tokens")) for k, tokens in each])
    return found.select(*kept, F.explode(read).alias("r")).select(*kept, "r.*").where("tokens IS NOT NULL")


def bare(tokens: Column) -> Column:
    """The template of tokens: a placeholder is its mark and kind."""
    return F.transform(tokens, lambda w: F.when(w.startswith(MARK), F.substring(w, 1, 2)).otherwise(w))


def word_hashes(template: Column) -> Column:
    return F.transform(template, lambda w: F.xxhash64(w))


def windows(tokens: Column) -> Column:
    """Hashes of all windows of a template. The array is bound once, not once per window."""
    words = F.array(word_hashes(bare(tokens)))

    def hashed(each_word: Column) -> Column:
        places = F.sequence(F.lit(1), F.size(each_word) - (WINDOW - 1))
        each = F.transform(places, lambda i: F.xxhash64(F.slice(each_word, i, WINDOW)))
        return F.when(F.size(each_word) >= WINDOW, each)

    return F.element_at(F.transform(words, hashed), 1)


def item_windows(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(h, item_id, reading, place, values, template, total_named, total): windows with enough literal words."""
    rows = benchmark.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("item_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    items = readings(rows, "text").withColumn("t", bare(F.col("tokens")))
    items = written_table(items.where(F.size("t") >= WINDOW), "items")
    place = F.explode(F.sequence(F.lit(1), F.size("t") - (WINDOW - 1)))
    each = items.select("item_id", "reading", "tokens", "t", place.alias("place")).select(
        "item_id", "reading", "place", F.slice("tokens", F.col("place"), WINDOW).alias("values"), F.slice("t", F.col("place"), WINDOW).alias("template")
    )
    literal = F.size(F.filter("template", lambda w: ~w.startswith(MARK)))
    kept = each.where(literal >= LEAST_LITERAL).groupBy("item_id", "place", "values", "template").agg(F.min("reading").alias("reading"))
    kept = kept.withColumn("h", F.xxhash64(word_hashes(F.col("template"))))
    totals = kept.groupBy("item_id").agg(
        F.countDistinct("place").alias("total"), F.count(F.when(F.col("reading") == NAMED, 1)).alias("total_named")
    )
    return written_table(kept.join(totals, "item_id"), "item-windows")


def agreeing(exact: DataFrame, total: str) -> DataFrame:
    """The (id, item_id) pairs of equal windows with enough of them on alignments whose slots agree."""
    slots = exact.select("id", "item_id", "shift", F.explode(F.arrays_zip("values", "seen")).alias("s")).where(F.col("s.values").startswith(MARK))
    clashes = slots.groupBy("id", "item_id", "shift", "s.values").agg(F.countDistinct("s.seen").alias("kinds"))
    per_alignment = clashes.groupBy("id", "item_id", "shift").agg(F.count("*").alias("slots"), F.max("kinds").alias("kinds"))
    return (
        exact.join(per_alignment, ["id", "item_id", "shift"], "left").where("coalesce(kinds, 1) = 1")
        .groupBy("id", "item_id")
        .agg(
            F.countDistinct("place").alias("n_windows"), F.max(total).alias("n_item_windows"),
            F.coalesce(F.max("slots"), F.lit(0)).cast("long").alias("n_slots"),
        )
        .where(F.col("n_windows") >= F.least(F.lit(LEAST_WINDOWS), F.col("n_item_windows")))
    )


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text: str = "text", broadcast_rows: int = 2_000_000,
) -> DataFrame:
    """(id, item_id, n_windows, n_item_windows, n_slots): a row per document and item it holds.

    A document holds an item if at least two windows of eight template words, or all if there is
    only one, lie on alignments whose slots agree. The counts are those of the windows with names
    as placeholders where these suffice, else those of all readings together. Windows with fewer
    than four literal words are left out, so items of numbers alone and items under eight words are
    never found. A name that both texts have only at starts of sentences and that was replaced is
    a different word. Null and empty texts hold nothing; rows without id are not reported; rows that
    repeat an id are one document; extra columns are ignored; an empty table on either side gives
    no rows.
    """
    items = item_windows(benchmark, item_col, item_text)
    texts = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    hashed = readings(texts.where("text IS NOT NULL"), "text").select("id", "reading", F.posexplode(windows(F.col("tokens"))).alias("at", "h"))
    keys = broadcast_if_small(items.select("h", "item_id", "place", F.col("reading").alias("item_reading")), broadcast_rows)
    found = written_table(hashed.join(keys, "h").select("id", "reading", (F.col("at") + 1).alias("at"), "item_id", "place", "item_reading"), "found")

    # the values of the few documents with hits, window by window
    wanted = small_list(found.select("id"), "wanted")
    held = readings(texts.join(wanted, "id", "left_semi").where("text IS NOT NULL"), "text")
    places = found.groupBy("id", "reading").agg(F.collect_set(F.struct("at", "item_id", "place", "item_reading")).alias("hits"))
    cut = held.join(places, ["id", "reading"]).select(
        "id", "reading",
        F.explode(F.transform("hits", lambda m: F.struct(
            m["item_id"].alias("item_id"), m["place"].alias("place"), m["item_reading"].alias("item_reading"),
            (m["at"] - m["place"]).alias("shift"), F.slice("tokens", m["at"], WINDOW).alias("seen"),
        ))).alias("m"),
    ).select("id", F.col("reading").alias("doc_reading"), "m.*").withColumnRenamed("item_reading", "reading")
    pairs = cut.join(items.select("item_id", "place", "reading", "values", "template", "total_named", "total"), ["item_id", "place", "reading"])
    exact = written_table(
        pairs.where(bare(F.col("seen")) == F.col("template"))
        .select("id", "item_id", "doc_reading", "reading", "shift", "place", "values", "seen", "total_named", "total"), "aligned",
    )
    by_names = agreeing(exact.where((F.col("doc_reading") == NAMED) & (F.col("reading") == NAMED)), "total_named")
    by_any = agreeing(exact, "total")
    pair = ["id", "item_id"]
    counts = ("n_windows", "n_item_windows", "n_slots")
    both = by_any.select(*pair, F.struct(*counts).alias("any")).join(by_names.select(*pair, F.struct(*counts).alias("names")), pair, "full")
    return both.select(*pair, F.coalesce("names", "any").alias("c")).select(*pair, "c.*")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no item, with all columns; rows without id stay."""
    return without_ids(docs, id_col, contaminated(docs, benchmark, id_col, text_col).select("id"))


def _sql(step: tuple[str, str], text: str) -> str:
    pattern, by = step[0].replace("'", "''"), step[1].replace("{", "\\").replace("}", "")
    return f"regexp_replace({text}, '{pattern}', '{by}', 'g')"


def _marked_sql(text: str) -> str:
    """The same steps as DuckDB SQL; those for digits change nothing in a text without any."""
    words = _sql(SPLIT, f"lower({_sql(JOINED, _sql(NAMES, f"replace({text}, '{MARK}', ' ')"))})")
    return _sql(MEASURES, _sql(NUMBERS, f"' ' || {words} || ' '"))


CONTAMINATED_SQL = rf"""
    WITH d AS (SELECT doc_id, regexp_split_to_array(trim({_marked_sql("text")}), ' +') AS v FROM documents WHERE text IS NOT NULL),
    b AS (SELECT item_id, regexp_split_to_array(trim({_marked_sql("text")}), ' +') AS v FROM benchmark),
    dw AS (SELECT doc_id, v, unnest(range(1, len(v) - {WINDOW - 2})) AS pos FROM d),
    dh AS (SELECT doc_id, pos, v[pos:pos + {WINDOW - 1}] AS seen FROM dw),
    dt AS (SELECT *, list_transform(seen, lambda x: {_sql(BARE, "x")}) AS template FROM dh),
    bw AS (SELECT item_id, v, unnest(range(1, len(v) - {WINDOW - 2})) AS place FROM b),
    bh AS (SELECT item_id, place, v[place:place + {WINDOW - 1}] AS vals FROM bw),
    bt AS (SELECT *, list_transform(vals, lambda x: {_sql(BARE, "x")}) AS template FROM bh),
    bk AS (SELECT *, count(*) OVER (PARTITION BY item_id) AS total FROM bt
           WHERE len(list_filter(template, lambda x: NOT starts_with(x, '{MARK}'))) >= {LEAST_LITERAL}),
    m AS (SELECT DISTINCT doc_id, item_id, pos - place AS shift, place, vals, seen, total FROM dt JOIN bk USING (template)),
    s AS (SELECT doc_id, item_id, shift, unnest(vals) AS val, unnest(seen) AS got FROM m),
    c AS (SELECT doc_id, item_id, shift, val, count(DISTINCT got) AS kinds FROM s WHERE starts_with(val, '{MARK}') GROUP BY ALL),
    a AS (SELECT doc_id, item_id, shift, count(*) AS slots, max(kinds) AS kinds FROM c GROUP BY ALL)
    SELECT doc_id, item_id, count(DISTINCT place) AS n_windows, max(total) AS n_item_windows,
           coalesce(max(slots), 0)::BIGINT AS n_slots
    FROM m LEFT JOIN a USING (doc_id, item_id, shift)
    WHERE coalesce(kinds, 1) = 1
    GROUP BY doc_id, item_id
    HAVING count(DISTINCT place) >= least({LEAST_WINDOWS}, max(total))
"""
