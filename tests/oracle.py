"""Runs queries beside their SQL on the same tables and compares the rows as multisets."""

from __future__ import annotations

import decimal
import math
import sys
import time

import duckdb

from quadrata.workload.all import REGISTRY, TABLES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return con


def _cell(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(spark, con, folder: str, name: str, registry=REGISTRY) -> list[str]:
    """Empty if the query and its SQL agree."""
    q = registry[name]
    df = q.run(spark, folder)
    got = [tuple(r) for r in df.collect()]
    if q.oracle is None:
        return [] if got else ["no rows"]
    relation = con.sql(q.oracle)
    want = relation.fetchall()
    if sorted(df.columns) != sorted(relation.columns):
        return [f"columns {sorted(df.columns)} != {sorted(relation.columns)}"]
    found = []
    kinds = {c: str(t) for c, t in zip(relation.columns, relation.types)}
    names = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    for column, kind in df.dtypes:
        if names.get(kind) != kinds[column]:
            found.append(f"type of {column}: {kind} != {kinds[column]}")
    a, b = _rows(df.columns, got), _rows(relation.columns, want)
    if a != b:
        extra, lost = sorted(set(a) - set(b)), sorted(set(b) - set(a))
        found.append(f"rows {len(a)} vs {len(b)}; only spark {extra[:2]}; only sql {lost[:2]} ({len(extra)}/{len(lost)})")
    return found


if __name__ == "__main__":
    from quadrata.session import build_session

    folder, names = sys.argv[1], sys.argv[2:] or list(REGISTRY)
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name in names:
        start = time.time()
        try:
            found = differences(spark, con, folder, name)
        except Exception as error:
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - start:.1f}s", *found, sep="\n   " if found else " ", flush=True)
    print(f"{bad} of {len(names)} differ")
