"""Running a query next to its SQL counterpart."""

import os

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        if os.path.exists(f"{sf_dir}/{name}.parquet"):
            connection.execute(
                f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
            )
    return connection


def expected(connection: duckdb.DuckDBPyConnection, sql: str) -> pd.DataFrame:
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    return pd.DataFrame(result.fetchall(), columns=names)


def canonical(frame: pd.DataFrame) -> list[tuple]:
    """Rows in a fixed order with columns by name; numbers by value, missing as None."""

    def plain(value):
        if value is None or value is pd.NaT or value != value:
            return None
        if isinstance(value, pd.Timestamp):
            return str(value.date())
        if hasattr(value, "isoformat"):
            return value.isoformat()[:10]
        if isinstance(value, (bool, str)):
            return value
        return float(value) + 0.0

    columns = sorted(frame.columns)
    listed = [tuple(map(plain, row)) for row in frame[columns].itertuples(index=False, name=None)]
    return sorted(listed, key=lambda row: [(value is None, str(type(value)), value or 0) if not isinstance(value, str) else (False, "str", value) for value in row])


def rows_of(df) -> pd.DataFrame:
    return pd.DataFrame([tuple(row) for row in df.collect()], columns=df.columns)
