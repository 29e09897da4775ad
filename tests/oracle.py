"""Order-insensitive comparison of a Spark result with SQL run by DuckDB."""

from __future__ import annotations

import glob
import math
import os

import duckdb

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


def connect(sf_dir: str = SF_DIR):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        return repr(float(value))
    return str(value)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(df, sql, con):
    """Raise with the first differences; return the number of rows."""
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    expected = normal(columns, result.fetchall())
    actual = normal(df.columns, df.collect())
    assert sorted(columns) == sorted(df.columns), (sorted(columns), sorted(df.columns))
    if actual != expected:
        extra, missing = set(actual) - set(expected), set(expected) - set(actual)
        raise AssertionError(
            f"spark {len(actual)} rows, sql {len(expected)}; "
            f"only spark {sorted(extra)[:2]}; only sql {sorted(missing)[:2]}"
        )
    return len(actual)
