"""Compare a query with its SQL counterpart on the same files."""

import datetime
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def normal(v):
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.10g}") + 0.0
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(normal(x) for x in v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp": "TIMESTAMP", "tinyint": "TINYINT",
}


def differences(df, con, sql: str) -> str | None:
    """None if equal, else what differs."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    types = dict(zip(names, [str(d[1]) for d in cur.description]))
    expected = rows_of(names, cur.fetchall())
    columns = df.columns
    if sorted(columns) != sorted(names):
        return f"columns {sorted(columns)} != {sorted(names)}"
    actual = rows_of(columns, [tuple(r) for r in df.collect()])
    wrong = [(c, t, types[c]) for c, t in df.dtypes if KINDS.get(t) not in (types[c], None)]
    if wrong:
        return f"types {wrong}"
    if len(actual) != len(expected):
        extra = [r for r in actual if r not in set(expected)][:2]
        missing = [r for r in expected if r not in set(actual)][:2]
        return f"{len(actual)} rows != {len(expected)}; extra {extra} missing {missing}"
    bad = [(a, e) for a, e in zip(actual, expected) if a != e]
    if bad:
        return f"{len(bad)} of {len(actual)} rows differ, first {str(bad[0][0])[:600]} != {str(bad[0][1])[:600]}"
    return None
