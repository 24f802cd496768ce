"""DuckDB beside Spark: the same rows, whatever the order of rows and columns."""

from __future__ import annotations

import duckdb
import pandas as pd

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def value(x):
    if isinstance(x, (list, tuple)) or getattr(x, "ndim", 0):
        return [value(y) for y in list(x)]
    if x is None or pd.isna(x):
        return None
    x = x.item() if hasattr(x, "item") else x
    return round(x, 6) if isinstance(x, float) else x


def rows(df: pd.DataFrame) -> list[str]:
    df = df[sorted(df.columns)]
    flat = ([float(v) if isinstance(v, int) and not isinstance(v, bool) else v for v in map(value, r)] for r in df.itertuples(index=False, name=None))
    return sorted(map(repr, flat))


def connect(sf_dir: str = SF) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def check(spark, con, query, sql: str) -> None:
    got = query(spark, SF).toPandas()
    want = con.execute(sql).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
