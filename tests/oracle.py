"""Compare a Spark result with the same query in DuckDB."""

from __future__ import annotations

import datetime
import math
from collections import Counter
from pathlib import Path

import duckdb

DUCK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "float": "FLOAT",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    return con


def _value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.10g}")
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in rows)


def differences(df, sql: str, sf_dir: str) -> list[str]:
    """What differs: column names, types, then rows. Empty means equal."""
    con = connect(sf_dir)
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want_types = {d[0]: str(d[1]) for d in cursor.description}
    expected = cursor.fetchall()
    out = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for name, kind in df.dtypes:
        if DUCK_TYPES.get(kind, kind) != want_types[name]:
            out.append(f"type of {name}: {kind} != {want_types[name]}")
    actual = _rows(df.columns, [tuple(r) for r in df.collect()])
    wanted = _rows(names, expected)
    if actual != wanted:
        missing, extra = list((wanted - actual).elements()), list((actual - wanted).elements())
        out.append(f"rows {sum(actual.values())} != {sum(wanted.values())}; missing {missing[:3]}; extra {extra[:3]}")
    if not wanted:
        out.append("no rows to compare")
    return out
