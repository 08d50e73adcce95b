"""Run a registered query on Spark and its SQL on DuckDB and compare them as multisets."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _canonical(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    rows = []
    for row in df.itertuples(index=False, name=None):
        rows.append(tuple(_text(v) for v in row))
    return sorted(rows)


def _text(value) -> str:
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return "NULL"
    if isinstance(value, float):
        return repr(value + 0.0)      # -0.0 reads as 0.0
    return str(value)


def differences(spark_table, duck_table) -> list[str]:
    """Problems found: columns, types, row count, first unequal rows. Arrow tables in."""
    names = sorted(spark_table.column_names)
    if names != sorted(duck_table.column_names):
        return [f"columns {names} != {sorted(duck_table.column_names)}"]
    found = []
    for name in names:
        a, b = (str(t.schema.field(name).type).replace("large_", "").replace("timestamp[us, tz=UTC]", "timestamp[us]")
                for t in (spark_table, duck_table))
        if a != b:
            found.append(f"type of {name}: {a} != {b}")
    if spark_table.num_rows != duck_table.num_rows:
        return [*found, f"rows {spark_table.num_rows} != {duck_table.num_rows}"]
    left = _canonical(_frame(spark_table))
    right = _canonical(_frame(duck_table))
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    if wrong:
        found.append(f"{len(wrong)} rows differ, first: {wrong[0]}")
    return found


def _frame(table) -> pd.DataFrame:
    return pd.DataFrame({n: table.column(n).to_pylist() for n in table.column_names}, dtype=object)
