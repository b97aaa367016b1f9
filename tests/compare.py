"""Side-by-side comparison of a Spark frame with a SQL statement over the same files."""

import math
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    return con


def _value(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, (int, float)):
        if isinstance(v, float) and math.isnan(v):
            return (2, "nan")
        return (3, repr(float(v)))
    return (4, str(v))


def normal_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_value(r[i]) for i in order) for r in rows)


KINDS = {
    "TINYINT": "int",
    "INTEGER": "int",
    "BIGINT": "bigint",
    "VARCHAR": "string",
    "DOUBLE": "double",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
    "BOOLEAN": "boolean",
}


def differences(df, con, sql):
    """Texts that say how the two results differ; empty if they agree."""
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    kinds = {n: KINDS.get(str(d[1]), str(d[1])) for n, d in zip(names, found.description)}
    theirs = normal_rows(names, found.fetchall())
    ours = normal_rows(df.columns, [tuple(r) for r in df.collect()])
    out = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} vs {sorted(names)}"]
    for name, kind in df.dtypes:
        if kinds[name] != kind:
            out.append(f"type of {name}: {kind} vs {kinds[name]}")
    if len(ours) != len(theirs):
        out.append(f"rows {len(ours)} vs {len(theirs)}")
    elif ours != theirs:
        bad = [(a, b) for a, b in zip(ours, theirs) if a != b]
        out.append(f"{len(bad)} rows differ, first {bad[0]}")
    return out
