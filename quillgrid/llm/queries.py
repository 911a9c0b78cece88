"""The corpus operators applied to whole tables, with SQL where SQL can state the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import Tables
from .decontaminate import CONTAMINATED_SQL, contaminated
from .exact_dedup import exact_groups
from .hard_negatives import HARD_NEGATIVES_SQL, mine_hard_negatives
from .html_text import main_text
from .language_id import identify
from .line_dedup import LINES_SQL, dedup_lines
from .lm_score import pseudo_likelihood
from .merkle import MANIFEST_SQL, manifest
from .minhash import near_duplicates
from .pii import digest_columns, find_pii
from .repeats import repeated_passages
from .sentencepiece_codec import encode_digests
from .toxicity import toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of :class:`Tables` under ``name``."""

    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql:
            ORACLES[name] = sql
        return build

    return register


@query(
    "op8_exact_dedup",
    r"""
    WITH n AS (
        SELECT doc_id, length(coalesce(text, '')) AS chars,
               regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body
        FROM documents
    )
    SELECT doc_id,
           first_value(doc_id) OVER (PARTITION BY body ORDER BY chars DESC, doc_id) AS keep_id,
           count(*) OVER (PARTITION BY body) AS group_size,
           row_number() OVER (PARTITION BY body ORDER BY chars DESC, doc_id) = 1 AS kept,
           sha256(body) AS text_sha256
    FROM n
    """,
)
def op8_exact_dedup(t: Tables) -> DataFrame:
    groups = exact_groups(t.documents)
    return groups.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


@query("op1_semi_markov_pii")
def op1_semi_markov_pii(t: Tables) -> DataFrame:
    return digest_columns(find_pii(t.documents))


@query("op2_template_decontamination", CONTAMINATED_SQL)
def op2_template_decontamination(t: Tables) -> DataFrame:
    return contaminated(t.documents, t.benchmark).withColumnRenamed("id", "doc_id")


@query("op3_circulant_minhash")
def op3_circulant_minhash(t: Tables) -> DataFrame:
    return near_duplicates(t.documents, width=2, percent=80).withColumnRenamed("id", "doc_id")


@query("op4_prefix_free_parsing")
def op4_prefix_free_parsing(t: Tables) -> DataFrame:
    return repeated_passages(t.documents).drop("kept").withColumnRenamed("id", "doc_id")


@query("op5_language_fusion")
def op5_language_fusion(t: Tables) -> DataFrame:
    return identify(t.pages, t.documents).withColumnRenamed("id", "page_id")


@query("op6_masked_pseudo_likelihood")
def op6_masked_pseudo_likelihood(t: Tables) -> DataFrame:
    return pseudo_likelihood(t.documents).withColumnRenamed("id", "doc_id")


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query("op7_sentencepiece")
def op7_sentencepiece(t: Tables) -> DataFrame:
    return encode_digests(t.documents, piece_model()).withColumnRenamed("id", "doc_id")


@query("op9_page_differencing")
def op9_page_differencing(t: Tables) -> DataFrame:
    return main_text(t.pages).withColumnRenamed("id", "page_id")


@query("op10_toxicity")
def op10_toxicity(t: Tables) -> DataFrame:
    return toxicity(t.documents, t.labels).withColumnRenamed("id", "doc_id")


@query("op11_merkle_manifest", MANIFEST_SQL)
def op11_merkle_manifest(t: Tables) -> DataFrame:
    """Every row whose id has a checksum divisible by seven is tampered with."""
    return manifest(t.documents, F.crc32(F.col("doc_id").cast("string")) % 7 == 0).withColumnRenamed("id", "doc_id")


@query("op12_line_dedup", LINES_SQL)
def op12_line_dedup(t: Tables) -> DataFrame:
    return dedup_lines(t.documents).select(
        F.col("id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256")
    )


@query("op13_hard_negatives", HARD_NEGATIVES_SQL)
def op13_hard_negatives(t: Tables) -> DataFrame:
    """A seventh of the labels is wrong before the search."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(t.embeddings.withColumn("label", label), vector_col="embedding")
