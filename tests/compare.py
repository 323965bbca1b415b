"""Order-insensitive comparison of a Spark result with DuckDB SQL."""

from __future__ import annotations

import hashlib
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import DataFrame


def duck_result(sf_dir: str, sql: str) -> pd.DataFrame:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con.execute(sql).df()


def _canonical(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    rows = []
    for row in frame.itertuples(index=False, name=None):
        rows.append(tuple("" if pd.isna(v) else _text(v) for v in row))
    return sorted(rows)


def _text(value: object) -> str:
    if isinstance(value, float):
        return str(int(value)) if value.is_integer() else repr(value)
    return str(value)


def digest(frame: pd.DataFrame) -> str:
    return hashlib.sha256(repr(_canonical(frame)).encode()).hexdigest()


def assert_same(spark_result: DataFrame, expected: pd.DataFrame) -> None:
    actual = spark_result.toPandas()
    assert sorted(actual.columns) == sorted(expected.columns)
    assert len(actual) == len(expected)
    left, right = _canonical(actual), _canonical(expected)
    differing = [(a, b) for a, b in zip(left, right) if a != b]
    assert not differing, f"{len(differing)} of {len(left)} rows differ: {differing[:3]}"
