"""Compare every registered query with its SQL in DuckDB.

    python tools/check_oracle.py [folder] [name ...]
"""

from __future__ import annotations

import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quillgrid.plans import ORACLES, QUERIES  # noqa: E402
from quillgrid.session import build_session  # noqa: E402
from quillgrid.sources.tables import TABLES  # noqa: E402

FAMILY = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
    "DATE": "date", "FLOAT": "float",
}


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float) and (math.isnan(value) or value == 0):
        return "nan" if math.isnan(value) else 0.0
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr(tuple(plain(row[i]) for i in order)) for row in rows)


def compare(spark, folder, name, connection):
    """An error text, or None if columns, types and rows are the same."""
    frame = QUERIES[name](spark, folder)
    types = dict(frame.dtypes)
    got = frame.collect()
    result = connection.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    expected = result.fetchall()
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} against {sorted(names)}"
    wrong = {c: (types[c], kinds[c]) for c in names if FAMILY.get(kinds[c], kinds[c].lower()) != types[c]}
    mine, theirs = rows_of(frame.columns, got), rows_of(names, expected)
    if mine != theirs:
        only = [r for r in mine if r not in set(theirs)][:3], [r for r in theirs if r not in set(mine)][:3]
        return f"rows {len(mine)} against {len(theirs)}; ours only {only[0]}; theirs only {only[1]}"
    return f"types {wrong}" if wrong else None


def connect(folder):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def main():
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(QUERIES)
    spark = build_session("check", os.environ.get("TEST_MASTER", "local[8]"), **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    bad = 0
    for name in chosen:
        start = time.time()
        try:
            error = compare(spark, folder, name, connection) if name in ORACLES else f"no SQL, {QUERIES[name](spark, folder).count()} rows"
        except Exception as problem:
            error = f"{type(problem).__name__}: {str(problem)[:1500]}"
        bad += error is not None
        print(f"{'ok ' if error is None else 'BAD'} {name} {time.time() - start:.1f}s {error or ''}", flush=True)
    print(f"{len(chosen)} queries, {bad} not equal")


if __name__ == "__main__":
    main()
