"""Language of web pages by Bayesian fusion of independent evidence.

Evidence is the text itself (byte trigram likelihoods learned from labelled documents), the
language that the markup declares, the last label of the host name, and the host. How often a
language hides behind each declaration, suffix and host is counted from the pages themselves by
grouped aggregation of their text posteriors; a host is smoothed towards its registered domain,
that one towards its suffix, and the suffix towards all pages.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_if_small, written_table
from .common import in_tasks
from .html_text import address, lines_of

BINS = 1 << 16
BLOCK = 1 << 12
ODD = np.uint32(2_654_435_761)

# Parameters: trigrams of one text depend on each other, so their sum is damped; a text of many
# trigrams counts as this many independent ones at most. The others are pseudo-counts.
DAMPING = 0.2
EFFECTIVE = 60.0
HOST_WEIGHT, DOMAIN_WEIGHT, SUFFIX_WEIGHT, CUE_WEIGHT = 5.0, 10.0, 20.0, 10.0


def trigram_bins(text: str) -> np.ndarray:
    """Bins of the byte trigrams of the lower-cased text; digits and marks count as blanks."""
    raw = np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), np.uint8)
    keep = (raw >= 97) & (raw <= 122) | (raw >= 128)
    raw = np.where(keep, raw, 32).astype(np.uint32)
    codes = raw[:-2] << np.uint32(16) | raw[1:-1] << np.uint32(8) | raw[2:]
    codes = codes[codes != 0x202020]
    return (codes * ODD) >> np.uint32(16)


def trigram_counts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """(lang, block, counts): trigram counts of all labelled texts, summed over the tasks."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                bins = trigram_bins(text.as_py())
                total = totals.setdefault(lang, np.zeros(BINS, np.int64))
                total += np.bincount(bins, minlength=BINS) if len(bins) > BINS // 8 else 0
                if len(bins) <= BINS // 8:
                    np.add.at(total, bins, 1)
        for lang, total in totals.items():
            blocks = total.reshape(-1, BLOCK)
            yield pa.RecordBatch.from_pydict({
                "lang": [lang] * len(blocks), "block": pa.array(range(len(blocks)), pa.int32()),
                "counts": pa.array([b.tolist() for b in blocks], pa.list_(pa.int64())),
            })

    labelled = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    partial = in_tasks(labelled, count, "lang string, block int, counts array<long>")
    each = partial.select("lang", "block", F.posexplode("counts").alias("place", "n")).where("n > 0")
    return each.groupBy("lang", (F.col("block") * BLOCK + F.col("place")).alias("bin")).agg(F.sum("n").alias("n"))


class TextModel:
    """log P(trigram | language) for every bin; bounded by the languages, not by the corpus."""

    def __init__(self, counts: pa.Table):
        names = np.array(counts["lang"].to_pylist(), object)
        self.languages = sorted(set(names))
        table = np.full((len(self.languages), BINS), 0.5)
        row = np.array([self.languages.index(n) for n in names], np.int64)
        table[row, counts["bin"].to_numpy()] += counts["n"].to_numpy()
        self.logs = np.log(table / table.sum(axis=1, keepdims=True)) if self.languages else table

    def likelihood(self, text: str) -> list[float]:
        """Damped log likelihood per language, 0 at the best one."""
        bins = trigram_bins(text)
        if not len(bins):
            return [0.0] * len(self.languages)
        mean = self.logs[:, bins].mean(axis=1)
        score = mean * min(EFFECTIVE, DAMPING * len(bins))
        return (score - score.max()).tolist()


def declared(page: Column) -> Column:
    """Two-letter language of the ``html`` element, in lower case; empty if there is none."""
    return F.lower(F.regexp_extract(page, r"(?i)<html[^>]*?\slang\s*=\s*[\"']?([a-zA-Z]{2})", 1))


def measured_pages(pages: DataFrame, model: TextModel) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = []
            for page in batch.column("html"):
                lines = lines_of(page.as_py())
                best = min((k for k, _ in lines), default=0)  # the article if there is one
                scores.append(model.likelihood(" ".join(t for k, t in lines if k == best)))
            columns = [batch.column(c) for c in ("id", "row", "host", "domain", "suffix", "declared")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(scores, pa.list_(pa.float64()))], names=["id", "row", "host", "domain", "suffix", "declared", "text_log"])

    return in_tasks(pages, run, "id long, row long, host string, domain string, suffix string, declared string, text_log array<double>")


def softmax(logs: Column) -> Column:
    powers = F.transform(logs, F.exp)
    total = F.aggregate(powers, F.lit(0.0), lambda a, x: a + x)
    return F.transform(powers, lambda x: x / total)


def sums(df: DataFrame, key: str, size: int, name: str) -> DataFrame:
    """Per key: summed posteriors as an array."""
    each = F.array(*[F.sum(F.col("post")[i]) for i in range(size)])
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(each.alias(name))


def smoothed(own: Column, above: Column, weight: float) -> Column:
    """(counts + weight * share of the level above) / (total + weight)."""
    counts = F.coalesce(own, F.transform(above, lambda _: F.lit(0.0)))
    total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    return F.zip_with(counts, above, lambda n, p: (n + weight * p) / (total + weight))


def identify(
    pages: DataFrame, docs: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    text_col: str = "text", lang_col: str = "lang", max_broadcast: int = 200_000,
) -> DataFrame:
    """One row per page: id, host, declared, text_language, language, probability.

    ``docs`` are labelled texts that give the text likelihoods; all of them are counted. A page's
    own posterior is taken out of the counts of its host before they judge it. Null or empty
    pages have no text evidence and are judged by the rest; null urls have no host, domain or
    suffix; a missing declaration is evidence like any other. Ties go to the language that comes
    first in the alphabet. Without labelled texts the language is null. Null ids, repeated rows
    and extra columns change nothing; an empty table gives no rows.
    """
    # languages x BINS numbers
    model = TextModel(trigram_counts(docs, text_col, lang_col).toArrow())
    size = len(model.languages)
    host, _ = address(F.col(url_col))
    labels = F.split(F.col("host"), r"\.")
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(html_col), F.col(url_col)).alias("row"), host.alias("host"),
        F.coalesce(F.col(html_col), F.lit("")).alias("html"),
    ).select(
        "id", "row", "host", "html",
        F.when(F.col("host").isNotNull(), F.array_join(F.slice(labels, F.greatest(F.lit(1), F.size(labels) - 1), 2), ".")).alias("domain"),
        F.when(F.col("host").isNotNull(), F.element_at(labels, -1)).alias("suffix"), declared(F.col("html")).alias("declared"),
    )
    if not size:
        null = F.lit(None).cast("string")
        return rows.select("id", "host", "declared", null.alias("text_language"), null.alias("language"), F.lit(0.0).alias("probability"))
    pages_log = written_table(measured_pages(rows, model).withColumn("post", softmax(F.col("text_log"))), "page-evidence")

    # one row per suffix and declaration: host names end in few labels, declarations have two letters
    totals = pages_log.agg(*[F.sum(F.col("post")[i]) for i in range(size)]).first()
    shares = [((n or 0.0) + 1.0 / size) / (sum(x or 0.0 for x in totals) + 1.0) for n in totals]
    overall = F.array(*[F.lit(p) for p in shares])
    by_suffix = sums(pages_log, "suffix", size, "suffix_n")
    by_declared = sums(pages_log, "declared", size, "declared_n")
    by_domain = sums(pages_log, "domain", size, "domain_n")
    by_host = sums(pages_log, "host", size, "host_n")
    joined = pages_log.withColumn("all_p", overall)
    for table, key in ((by_suffix, "suffix"), (by_declared, "declared"), (by_domain, "domain"), (by_host, "host")):
        joined = joined.join(broadcast_if_small(written_table(table, f"by-{key}"), max_broadcast), key, "left")

    # the page's own share leaves the counts that judge it
    without = lambda name: F.zip_with(F.col(name), F.col("post"), lambda n, p: F.greatest(n - p, F.lit(0.0)))
    prior = smoothed(without("suffix_n"), F.col("all_p"), SUFFIX_WEIGHT)
    prior = smoothed(without("domain_n"), prior, DOMAIN_WEIGHT)
    prior = smoothed(without("host_n"), prior, HOST_WEIGHT)
    cue = smoothed(without("declared_n"), F.col("all_p"), CUE_WEIGHT)
    # P(lang | declared) / P(lang) is P(declared | lang) up to a constant
    table = joined.withColumn("prior", prior).withColumn("cue", cue)
    table = table.withColumn("evidence", F.zip_with("cue", "all_p", lambda c, p: F.log(c / p)))
    table = table.withColumn("evidence", F.zip_with("evidence", "prior", lambda e, p: e + F.log(p)))
    table = table.withColumn("logs", F.zip_with("evidence", "text_log", lambda e, t: e + t))
    highest = F.array_max("logs")
    shifted = table.withColumn("final", softmax(F.transform("logs", lambda x: x - highest)))
    names = F.array(*[F.lit(x) for x in model.languages])
    best = lambda column: F.element_at(names, F.array_position(column, F.array_max(column)).cast("int"))
    return shifted.select(
        "id", "host", "declared", best(F.col("post")).alias("text_language"), best(F.col("final")).alias("language"),
        F.round(F.array_max("final"), 9).alias("probability"),
    )
