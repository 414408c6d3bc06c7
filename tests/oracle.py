"""Compare a Spark result with the SQL twin run by DuckDB on the same files."""

from __future__ import annotations

import math
import os
from datetime import date, datetime

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(path: str):
    import duckdb

    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{os.path.join(path, table)}.parquet')")
    return db


def _plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(value, date):
        return value.isoformat()
    return repr(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


# What each engine may call the same type.
_SAME = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP", "date": "DATE",
}


def differences(df, sql, db, limit=3) -> list[str]:
    """Empty when columns, types and the multiset of rows agree."""
    found = []
    expected = db.execute(sql)
    names = [d[0] for d in expected.description]
    theirs = expected.fetchall()
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    types = {r[0]: r[1] for r in db.execute("DESCRIBE " + sql).fetchall()}
    for name, dtype in df.dtypes:
        if _SAME.get(dtype, dtype) != types[name]:
            found.append(f"type of {name}: {dtype} != {types[name]}")
    ours, theirs = _rows(df.columns, df.collect()), _rows(names, theirs)
    if len(ours) != len(theirs):
        found.append(f"{len(ours)} rows != {len(theirs)}")
    if ours != theirs:
        a, b = set(ours), set(theirs)
        found.append(f"only ours: {sorted(a - b)[:limit]}")
        found.append(f"only theirs: {sorted(b - a)[:limit]}")
    return found
