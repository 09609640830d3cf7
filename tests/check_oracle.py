"""Runs registered queries against DuckDB: ``python tests/check_oracle.py [sf dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(cell(r[i]) for i in order) for r in rows), key=lambda r: tuple(str(c) for c in r)
    )


SIMPLE = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}


def compare(spark, con, sf_dir, name, build, sql):
    """None if both sides agree, else what differs."""
    df = build(spark, sf_dir)
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    got = con.execute(sql)
    described = {d[0]: str(d[1]) for d in got.description}
    theirs = rows_of(list(described), got.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} / {theirs[0]}"
    for column, kind in df.dtypes:
        if SIMPLE.get(kind, kind) != described[column]:
            return f"type of {column}: {kind} / {described[column]}"
    if len(mine[1]) != len(theirs[1]):
        return f"{len(mine[1])} / {len(theirs[1])} rows"
    for a, b in zip(mine[1], theirs[1]):
        if a != b:
            return f"{a} / {b}"
    return None


def main() -> None:
    import __spark_entry__ as entry
    from tests.conftest import make_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark, con = make_session(), connect(sf_dir)
    oracles, bad = entry.oracle_sql(), 0
    for name, build in entry.queries().items():
        if wanted and name not in wanted:
            continue
        begun = time.time()
        try:
            if name in oracles:
                problem = compare(spark, con, sf_dir, name, build, oracles[name])
            else:
                problem = f"no oracle, {build(spark, sf_dir).count()} rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - begun:.2f}s {problem or ''}", flush=True)
    print(f"{bad} bad")
    spark.stop()


if __name__ == "__main__":
    main()
