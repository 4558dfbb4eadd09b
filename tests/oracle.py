"""Compare a query with its SQL, ignoring row order."""

from __future__ import annotations

import datetime as dt
import glob
import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {Path(file).stem} AS SELECT * FROM read_parquet('{file}')")
    return con


TYPES = {
    "VARCHAR": "string",
    "INTEGER": "int",
    "BIGINT": "bigint",
    "DOUBLE": "double",
    "BOOLEAN": "boolean",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
}


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, dt.datetime) and v.tzinfo is not None:
        return v.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return v


def rows_of(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> str | None:
    """What differs, or None."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    types = {d[0]: TYPES.get(str(d[1]), str(d[1])) for d in cur.description}
    if types != dict(df.dtypes):
        return f"types {set(df.dtypes) ^ set(types.items())}"
    got = rows_of(df.columns, df.collect())
    want = rows_of(names, cur.fetchall())
    if got == want:
        return None
    return (
        f"{sum(got.values())} vs {sum(want.values())} rows; "
        f"only here {list((got - want).items())[:2]}; only in SQL {list((want - got).items())[:2]}"
    )
