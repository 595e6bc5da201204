"""Compare every registered query with its oracle: ``python tests/oracle_check.py [sf_dir] [query ...]``."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


DUCK_TYPES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "date": "DATE", "boolean": "BOOLEAN",
}


def _canonical(value):
    return "NaN" if isinstance(value, float) and math.isnan(value) else value


def _bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(_canonical(r[i]) for i in order) for r in rows)


def compare(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both give the same columns, types and rows, else what differs first."""
    types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    if types != (own := {name: DUCK_TYPES[t] for name, t in df.dtypes}):
        return f"columns {sorted(own.items() - types.items())} vs oracle {sorted(types.items() - own.items())}"
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = _bag(names, cursor.fetchall())
    actual = _bag(df.columns, df.collect())
    if actual == expected:
        return None
    extra, lacking = list((actual - expected).items())[:2], list((expected - actual).items())[:2]
    return f"rows {actual.total()} vs oracle {expected.total()}; only here {extra}; only oracle {lacking}"


def main() -> int:
    import __spark_entry__ as contract
    from bench import session

    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    spark = session("oracle-check", 8)
    con = duck_connection(sf_dir)
    oracles = contract.oracle_sql()
    failed = 0
    for name, query in contract.queries().items():
        if args[1:] and name not in args[1:]:
            continue
        start = time.perf_counter()
        if name in oracles:
            problem = compare(query(spark, sf_dir), con, oracles[name])
        else:
            problem = f"(rows only: {query(spark, sf_dir).count()})"
        failed += bool(problem and name in oracles)
        print(f"{'OK  ' if problem is None else 'DIFF'} {name} {time.perf_counter() - start:.1f}s {problem or ''}"[:1500], flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
