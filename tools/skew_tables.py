"""Copies of the tables in which one key, text or vector holds a third of all rows.

    python tools/skew_tables.py <source folder> <target folder>
"""

from __future__ import annotations

import os
import sys

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
# The first row's value of these columns is given to every third row.
HOT = {
    "customer": ["c_nationkey", "c_mktsegment"],
    "orders": ["o_custkey"],
    "lineitem": ["l_partkey", "l_orderkey"],
    "events": ["user_id"],
    "documents": ["text", "lang", "source"],
    "embeddings": ["embedding", "label"],
    "conversations": ["text"],
}


def write_skewed(source: str, target: str) -> None:
    os.makedirs(target, exist_ok=True)
    connection = duckdb.connect()
    for table in TABLES:
        hot = ", ".join(f"CASE WHEN n % 3 = 0 THEN first({c}) OVER (ORDER BY n) ELSE {c} END AS {c}" for c in HOT.get(table, []))
        replaced = f"REPLACE ({hot})" if hot else ""
        connection.execute(
            f"COPY (SELECT * EXCLUDE (n) FROM (SELECT * {replaced} FROM "
            f"(SELECT *, row_number() OVER () AS n FROM '{source}/{table}.parquet'))) TO '{target}/{table}.parquet' (FORMAT parquet)"
        )


if __name__ == "__main__":
    write_skewed(sys.argv[1], sys.argv[2])
