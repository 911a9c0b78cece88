"""SQL fragments that several checks share."""

from __future__ import annotations

from ..functions import vocab
from ..functions.text import FOLDED

STOP_LIST = ", ".join(f"'{w}'" for w in vocab.STOPWORDS)
GLOSSARY_MAP = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in vocab.GLOSSARY.items()) + "}"


def words(text: str) -> str:
    return f"regexp_extract_all(lower({text}), '[a-z0-9]+')"


def folded_words(text: str) -> str:
    folded = text
    for character, replacement in FOLDED.items():
        folded = f"replace({folded}, '{character}', '{replacement}')"
    return words(folded)


def tokens(text: str) -> str:
    kept = f"list_filter({words(text)}, lambda w: w NOT IN ({STOP_LIST}))"
    singular = "CASE WHEN length(w) > 3 AND w LIKE '%s' AND w NOT LIKE '%ss' THEN left(w, length(w) - 1) ELSE w END"
    return f"list_transform({kept}, lambda w: {singular})"


def humanize(name: str) -> str:
    return f"array_to_string(list_transform(string_split({name}, '_'), lambda p: coalesce({GLOSSARY_MAP}[p], p)), ' ')"


def bm25(corpus: str, queries: str) -> str:
    """CTEs ending in ``scores(query_id, item_id, score)`` over corpus(item_id, text), queries(query_id, text)."""
    return f"""
corpus AS ({corpus}), asked AS ({queries}),
doc_tokens AS (SELECT item_id, {tokens('text')} AS toks FROM corpus),
stats AS (SELECT count(*) AS n, sum(len(toks)) / count(*) AS avgdl FROM doc_tokens),
postings AS (SELECT item_id, length, term, count(*) AS tf
             FROM (SELECT item_id, len(toks) AS length, unnest(toks) AS term FROM doc_tokens) GROUP BY ALL),
raw AS (SELECT term, count(*) AS df, sum(tf) AS cf,
        ln((SELECT n FROM stats) - count(*) + 0.5) - ln(count(*) + 0.5) AS raw_idf FROM postings GROUP BY term),
terms AS (SELECT *, CASE WHEN raw_idf < 0 THEN {vocab.BM25_EPSILON} * (SELECT avg(raw_idf) FROM raw) ELSE raw_idf END AS idf FROM raw),
query_terms AS (SELECT query_id, term, count(*) AS times
                FROM (SELECT query_id, unnest({tokens('text')}) AS term FROM asked) GROUP BY ALL),
scores AS (SELECT query_id, item_id, round(sum(times * idf * tf * ({vocab.BM25_K1} + 1)
             / (tf + {vocab.BM25_K1} * (1 - {vocab.BM25_B} + {vocab.BM25_B} * length / (SELECT avgdl FROM stats)))), 6) AS score
           FROM query_terms JOIN terms USING (term) JOIN postings USING (term) GROUP BY query_id, item_id)"""


def distances(corpus: str, queries: str, condition: str = "true") -> str:
    """CTEs ending in ``dist(query_id, item_id, distance, rank)`` over every pair."""
    return f"""
vec AS (SELECT item_id, CAST(vector AS DOUBLE[]) AS v FROM ({corpus})),
qvec AS (SELECT query_id, CAST(vector AS DOUBLE[]) AS v FROM ({queries})),
pairs AS (SELECT query_id, item_id,
          round(list_sum(list_transform(list_zip(q.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), 6) AS distance
          FROM qvec q, vec c WHERE {condition}),
dist AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, item_id) AS rank FROM pairs)"""
