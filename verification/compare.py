"""Run a query and its SQL twin side by side and compare names, rows and values."""

from __future__ import annotations

import duckdb
from pyspark.sql import DataFrame, SparkSession

from verification.oracle import ORACLE
from verification.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(value):
    if value is None or isinstance(value, (bool, int, float)):
        return value
    if hasattr(value, "asDict"):
        return tuple(_plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(_plain(v) for v in value.values())
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i].lower())
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark: SparkSession, con, name: str, sf_dir: str) -> str:
    """Empty text when both sides agree exactly, else the first difference."""
    df: DataFrame = QUERIES[name](spark, sf_dir)
    mine = _rows(df.columns, df.collect())
    rel = con.execute(ORACLE[name])
    names = [c[0] for c in rel.description]
    theirs = _rows(names, rel.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns differ: {sorted(set(df.columns) ^ set(names))}"
    if len(mine) != len(theirs):
        return f"rows: {len(mine)} against {len(theirs)}"
    if not mine:
        return "no rows"
    labels = sorted(names, key=str.lower)
    for i, label in enumerate(labels):
        kinds = [{type(r[i]).__name__ for r in side if r[i] is not None} for side in (mine, theirs)]
        if kinds[0] != kinds[1]:
            return f"types of {label} differ: {kinds}"
    bad: dict[str, int] = {}
    sample = ""
    for a, b in zip(mine, theirs):
        for label, x, y in zip(labels, a, b):
            if repr(x) != repr(y):
                bad[label] = bad.get(label, 0) + 1
                sample = sample or f"{label}: {x!r} against {y!r}"
    return f"{bad} e.g. {sample}" if bad else ""
