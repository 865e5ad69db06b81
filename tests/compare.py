"""Compare a Spark result with its oracle row by row, without tolerance."""

from __future__ import annotations

import datetime
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return int(value) if value.is_integer() else value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def rows(names, tuples):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_plain(t[i]) for i in order) for t in tuples]
    return sorted(out, key=repr)


def differences(df, con, sql, limit: int = 3) -> list[str]:
    result = con.execute(sql)
    expected_names = [c[0] for c in result.description]
    expected = rows(expected_names, result.fetchall())
    got = rows(df.columns, df.collect())
    if sorted(df.columns) != sorted(expected_names):
        return [f"columns {sorted(set(df.columns) ^ set(expected_names))}"]
    out = []
    if len(got) != len(expected):
        out.append(f"rows {len(got)} != {len(expected)}")
    bad = [(g, e) for g, e in zip(got, expected) if g != e]
    if bad:
        out.append(f"{len(bad)} rows differ")
        out += [f"got {g}\nexp {e}" for g, e in bad[:limit]]
    return out
