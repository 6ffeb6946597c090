"""Compare a query's rows with those an independent engine returns for its SQL."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def cell(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    return value.isoformat() if isinstance(value, date) else value


def mismatch(df, con, sql: str) -> str | None:
    """What differs, or None."""
    answer = con.execute(sql)
    names = [d[0] for d in answer.description]
    wanted = answer.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    order = sorted(names)
    ours = Counter(tuple(cell(row[c]) for c in order) for row in df.collect())
    theirs = Counter(
        tuple(cell(v) for _, v in sorted(zip(names, row), key=lambda pair: pair[0])) for row in wanted
    )
    if ours == theirs:
        return None
    return f"{order}: ours only {list((ours - theirs).items())[:3]}, theirs only {list((theirs - ours).items())[:3]}"
