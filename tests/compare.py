"""Compare a Spark result with DuckDB's answer on the same Parquet tables."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def rows_of(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def difference(spark_df, con, sql: str) -> str:
    """Empty if both give the same columns and the same rows."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = rows_of(names, result.fetchall())
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    actual = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if actual == expected:
        return ""
    return (
        f"{sum(actual.values())} rows != {sum(expected.values())}; "
        f"only here: {list((actual - expected).items())[:3]}; "
        f"only in SQL: {list((expected - actual).items())[:3]}"
    )
