"""Compare a registered query with its SQL counterpart, value by value."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.6f}"
    return str(value)


def _lines(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


_KINDS = {
    "int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
    "date": "DATE", "smallint": "SMALLINT", "tinyint": "TINYINT", "timestamp_ntz": "TIMESTAMP",
}


def differences(df, con, sql: str) -> list[str]:
    found = []
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    kinds = {row[0]: row[1] for row in described}
    for name, kind in df.dtypes:
        if kinds.get(name) != _KINDS.get(kind, kind):
            found.append(f"column {name}: {kind} and {kinds.get(name)}")
    for name in set(kinds) - set(df.columns):
        found.append(f"column {name} is missing")
    if found:
        return found
    ours = _lines(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    theirs = _lines([d[0] for d in cursor.description], cursor.fetchall())
    if len(ours) != len(theirs):
        found.append(f"{len(ours)} and {len(theirs)} rows")
    if ours != theirs:
        mine, other = set(ours) - set(theirs), set(theirs) - set(ours)
        found.append(f"only ours {len(mine)}: {sorted(mine)[:2]}; only theirs {len(other)}: {sorted(other)[:2]}")
    return found
