"""Text functions as Spark columns."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import vocab


def is_kept_word(word: Column) -> Column:
    """False for the question words that carry no meaning in a search."""
    return ~word.isin(*vocab.STOPWORDS)


def singular(word: Column) -> Column:
    """Strip one plural ``s``: longer than three letters, ending in s but not in ss."""
    plural = (F.length(word) > 3) & word.endswith("s") & ~word.endswith("ss")
    return F.when(plural, F.substring(word, F.lit(1), F.length(word) - 1)).otherwise(word)


def words(text: Column) -> Column:
    """Lower-cased runs of ASCII letters and digits."""
    return F.regexp_extract_all(F.lower(text), F.lit("([a-z0-9]+)"), F.lit(1))


def tokenize(text: Column) -> Column:
    """Search tokens of a text, as an array in text order."""
    return F.transform(F.filter(words(text), is_kept_word), singular)


def token_rows(df: DataFrame, text: str, out: str = "term") -> DataFrame:
    """One row per search token, in place of the text.

    The words are exploded before they are filtered and cut, so that the per-word work runs in
    generated code; exploding a filtered array would evaluate the array several times.
    """
    rest = [c for c in df.columns if c != text]
    exploded = df.select(*rest, F.explode(words(F.col(text))).alias("__word")).where(is_kept_word(F.col("__word")))
    return exploded.select(*rest, singular(F.col("__word")).alias(out))


# Characters whose full case folding holds ASCII letters that lower-casing does not give, as in
# the German sharp s.
FOLDED = {
    c: c.casefold() for c in map(chr, range(0x80, 0x10000))
    if c.casefold() != c.lower() and re.search("[a-z0-9]", c.casefold())
}


def casefold(text: Column) -> Column:
    """Full case folding, as far as it concerns ASCII words."""
    folded = text
    for character, replacement in FOLDED.items():
        folded = F.replace(folded, F.lit(character), F.lit(replacement))
    return F.lower(F.when(text.rlike("[" + "".join(FOLDED) + "]"), folded).otherwise(text))


def normalize_question(text: Column) -> Column:
    """Case and punctuation removed, words joined by one space."""
    return F.array_join(F.regexp_extract_all(casefold(text), F.lit("([a-z0-9]+)"), F.lit(1)), " ")


def humanize_name(name: Column) -> Column:
    """``cust_nm`` -> ``customer name``."""
    glossary = F.create_map(*[F.lit(x) for pair in vocab.GLOSSARY.items() for x in pair])
    parts = F.split(name, "_")
    return F.array_join(F.transform(parts, lambda p: F.coalesce(F.try_element_at(glossary, p), p)), " ")


def trim_space(text: Column) -> Column:
    """Remove white space of any script at both ends."""
    return F.regexp_replace(text, r"(?U)\A\s+|\s+\z", "")


def clean_sql_text(raw: Column) -> Column:
    """A model's reply reduced to its SQL: no code fences, from the first SELECT or WITH on."""
    bare = trim_space(F.regexp_replace(raw, "```(?:sql)?", ""))
    start = F.regexp_instr(bare, F.lit(r"(?iU)\b(SELECT|WITH)\b"))
    from_keyword = F.when(start > 0, F.substring(bare, start, F.length(bare))).otherwise(bare)
    return trim_space(F.regexp_replace(from_keyword, r";+\z", ""))


# Keywords of statements that change data or settings.
WRITE_KEYWORDS = (
    "insert", "update", "delete", "drop", "create", "alter", "merge", "replace", "truncate",
    "pragma", "attach", "detach", "vacuum", "reindex", "grant", "revoke", "call", "exec", "execute",
)


# One left-to-right pass: a quote inside a comment, or a comment mark inside quotes, is no start.
QUOTED_OR_COMMENT = r"""'[^']*+(?:''[^']*+)*+'|"[^"]*+(?:""[^"]*+)*+"|--[^\n]*+|/\*(?s:.*?)(?:\*/|\z)"""


def blank_literals(sql: Column) -> Column:
    """SQL text with quoted parts and comments replaced, so that keywords in them do not count."""
    return F.regexp_replace(sql, QUOTED_OR_COMMENT, " ? ")


def query_log_verdict(sql: Column) -> Column:
    """``ok`` or the reason why a logged statement is not one read-only query.

    A lexical check: a write keyword counts where a statement can start (at the beginning, or
    after a bracket, as behind a WITH list), unless it is called as a function.
    """
    text = F.lower(F.regexp_replace(blank_literals(sql), r"\A[\s;]+|[\s;]+\z", ""))
    writes = r"(?:\A|[;)(])\s*(?:" + "|".join(WRITE_KEYWORDS) + r")\b(?!\s*\()"
    return (
        F.when(sql.isNull() | (text == ""), "empty")
        .when(text.contains(";"), "multiple statements")
        .when(text.rlike(writes), "write statement")
        .when(~text.rlike(r"\bselect\b"), "no select")
        .otherwise("ok")
    )


def is_numeric_type(value_type: Column) -> Column:
    return F.upper(F.coalesce(value_type, F.lit(""))).rlike("INT|REAL|NUM|FLOAT|DOUBLE")


def sql_literal(value: Column, value_type: Column) -> Column:
    """Numbers bare, everything else quoted with doubled quotes."""
    quoted = F.concat(F.lit("'"), F.replace(value.cast("string"), F.lit("'"), F.lit("''")), F.lit("'"))
    return F.when(is_numeric_type(value_type), value.cast("string")).otherwise(quoted)


def value_document(table: Column, column: Column, value: Column, aliases: Column) -> Column:
    """The sentence that describes one stored value to a text index."""
    value_text = value.cast("string")
    meaning = F.when(
        F.size(aliases) > 0,
        F.concat(F.lit("Natural language meaning: "), F.array_join(aliases, ", "), F.lit(".")),
    ).otherwise(F.concat(F.lit("Natural language value: "), value_text, F.lit(".")))
    return F.concat_ws(
        " ",
        F.concat(humanize_name(table), F.lit(" "), humanize_name(column), F.lit(".")),
        F.concat(F.lit("Database column "), table, F.lit("."), column, F.lit(".")),
        F.concat(F.lit("Stored database value: "), value_text, F.lit(".")),
        meaning,
    )


def token_estimate(text: Column) -> Column:
    """Rough prompt size: four characters make one token."""
    return F.floor(F.length(text) / 4).cast("long")


def cache_key(model: Column, prompt: Column) -> Column:
    return F.md5(F.concat(model, F.lit("::"), prompt))


def email_valid(text: Column) -> Column:
    """Does the whole string have the shape of an e-mail address (Unicode white space excluded)?"""
    return text.rlike(r"(?U)\A" + vocab.EMAIL_PATTERN + r"\z")


def json_tag(source: Column, table: Column, row: Column) -> Column:
    return F.to_json(F.struct(source.alias("source"), table.alias("table"), row.alias("row")))
