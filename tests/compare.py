"""Runs a registered query and its SQL counterpart on the same tables and compares the rows."""

from __future__ import annotations

import datetime
import math
import os
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{os.path.join(sf, name)}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        # The sign of zero counts, as it does for a value hash.
        return ("-0",) if value == 0 and math.copysign(1, value) < 0 else round(value, 9)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def _bag(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


# Column types that the two engines name differently.
TYPES = {
    "string": "VARCHAR", "double": "DOUBLE", "bigint": "BIGINT", "int": "INTEGER", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def type_difference(df, con, sql) -> list:
    """Columns whose types do not agree."""
    other = {name: kind for name, kind, *_ in con.execute(f"DESCRIBE {sql}").fetchall()}
    return [(c, t, other.get(c)) for c, t in df.dtypes if TYPES.get(t) != other.get(c)]


def difference(df, con, sql) -> str | None:
    """None where columns and rows agree, else what differs."""
    got = df.collect()
    found = con.execute(sql)
    columns = [d[0] for d in found.description]
    wanted = found.fetchall()
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    left, right = _bag(got, df.columns), _bag(wanted, columns)
    if left == right:
        return None
    extra, missing = list((left - right).items())[:2], list((right - left).items())[:2]
    counts = f"{len(got)} vs {len(wanted)} rows, {sum((left - right).values())} differ"
    return f"{counts}; only here {extra}; only in SQL {missing}"
