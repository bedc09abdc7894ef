"""Compare query results with SQL results as bags of rows."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{Path(sf_dir) / name}.parquet')")
    return con


def _bag(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(row[i] for i in order) for row in rows)


def differences(spark_df, con, sql: str) -> list[str]:
    """What differs: column names, column types or rows. Empty if nothing does."""
    oracle = con.execute(sql)
    names = [d[0] for d in oracle.description]
    types = {d[0]: str(d[1]) for d in oracle.description}
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} != {sorted(names)}"]
    spark_types = {"string": "VARCHAR", "int": "INTEGER"}
    found = [
        f"type of {name}: {dtype} != {types[name]}"
        for name, dtype in spark_df.dtypes
        if spark_types.get(dtype, dtype.upper()) != types[name]
    ]
    expected = _bag(names, oracle.fetchall())
    actual = _bag(spark_df.columns, spark_df.collect())
    if expected != actual:
        missing, extra = expected - actual, actual - expected
        found.append(
            f"rows: {missing.total()} missing such as {list(missing)[:2]}, "
            f"{extra.total()} extra such as {list(extra)[:2]}"
        )
    return found
