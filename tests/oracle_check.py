"""Compare registered queries with their SQL on the given tables: ``python tests/oracle_check.py [sf] [name…]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(directory: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{directory}/{name}.parquet')")
    return con


def normal(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return value + 0.0
    return value


def sorted_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(normal(row[i]) for i in order) for row in rows], key=repr)


def compare(spark_df, con, sql: str) -> list[str]:
    """Differences in columns, types, row count or values; empty when equal."""
    problems = []
    got = [tuple(r) for r in spark_df.collect()]
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    kinds = {c[0]: str(c[1]).lower() for c in result.description}
    want = result.fetchall()
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} != {sorted(names)}"]
    spark_kinds = {"bigint": "bigint", "int": "integer", "double": "double", "string": "varchar", "boolean": "boolean"}
    for name, kind in spark_df.dtypes:
        if spark_kinds.get(kind, kind) != kinds[name]:
            problems.append(f"type of {name}: {kind} != {kinds[name]}")
    if len(got) != len(want):
        problems.append(f"{len(got)} rows != {len(want)} rows")
    a, b = sorted_rows(spark_df.columns, got), sorted_rows(names, want)
    differing = [(x, y) for x, y in zip(a, b) if x != y]
    if differing:
        problems.append(f"{len(differing)} differing rows, first: {differing[0]}")
    return problems


def main() -> None:
    from tests.conftest import build_session

    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    directory = f"/root/testdata/sf{sf}"
    wanted = sys.argv[2:] or list(entry.queries())
    spark, con = build_session(), connect(directory)
    bad = 0
    for name in wanted:
        started = time.time()
        try:
            df = entry.queries()[name](spark, directory)
            if name in entry.oracle_sql():
                problems = compare(df, con, entry.oracle_sql()[name])
                state = "ok" if not problems else "DIFF " + "; ".join(problems)
            else:
                problems, state = [], f"rows-only {df.count()}"
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            problems, state = [str(error)], "ERROR " + str(error)[:600]
        bad += bool(problems)
        print(f"{name:32s} {time.time() - started:6.2f}s {state}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
