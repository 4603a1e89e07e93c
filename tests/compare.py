"""Comparing a Spark result with an SQL result: same columns, same rows in any order."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


_FAMILIES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP"}


def difference(result: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs, or None."""
    relation = con.sql(sql)
    ours = {name: _FAMILIES.get(kind, kind) for name, kind in result.dtypes}
    theirs = dict(zip(relation.columns, map(str, relation.types)))
    if ours != theirs:
        return f"columns {ours} against {theirs}"
    names = sorted(ours)
    got = Counter(tuple(r) for r in result.select(*names).collect())
    expected = Counter(con.sql(f"SELECT {', '.join(names)} FROM ({sql})").fetchall())
    if got == expected:
        return None
    extra, missing = got - expected, expected - got
    return (
        f"{sum(got.values())} rows against {sum(expected.values())}; {sum(extra.values())} extra such as "
        f"{list(extra)[:3]}, {sum(missing.values())} missing such as {list(missing)[:3]}"
    )
