"""Compare a Spark query with the result of its SQL in DuckDB."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
TYPES = {"VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((v is None, v if v is not None else 0) for v in r))


def differences(df, con, sql: str) -> list[str]:
    """Human-readable differences in columns, types and rows; empty when equal."""
    names = sorted(df.columns)
    types = {d[0]: TYPES.get(str(d[1]), str(d[1])) for d in con.execute("DESCRIBE " + sql).fetchall()}
    if sorted(types) != names:
        return [f"columns {names} against {sorted(types)}"]
    found = [f"type of {f.name}: {f.dataType.simpleString()} against {types[f.name]}"
             for f in df.schema if f.dataType.simpleString() != types[f.name]]
    ours = _sorted([tuple(r[c] for c in names) for r in df.collect()])
    result = con.execute(sql)
    order = [d[0] for d in result.description]
    theirs = _sorted([tuple(r[order.index(c)] for c in names) for r in result.fetchall()])
    if len(ours) != len(theirs):
        return [*found, f"{len(ours)} rows against {len(theirs)}"]

    def same(a, b):
        if isinstance(a, float) and isinstance(b, float):
            return math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12)
        return a == b

    unequal = [(a, b) for a, b in zip(ours, theirs) if not all(map(same, a, b))]
    return found + [f"{a} against {b}" for a, b in unequal[:3]]
