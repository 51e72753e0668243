"""Run a registered query and its DuckDB oracle and compare the results."""

from __future__ import annotations

import math

import duckdb

from quarry.plans.tables import TABLES


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    try:
        import decimal
        if isinstance(v, decimal.Decimal):
            return round(float(v), 6)
    except Exception:
        pass
    return v


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, [tuple(_norm(r[c]) for c in cols) for r in df.collect()]


def rows_of_duck(con, sql):
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    data = rel.fetchall()
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], [tuple(_norm(r[i]) for i in order) for r in data]


def _key(row):
    return tuple((x is None, str(type(x).__name__) if x is None else "", str(x)) for x in row)


def compare(spark_df, con, sql):
    sc, srows = rows_of_spark(spark_df)
    dc, drows = rows_of_duck(con, sql)
    if sc != dc:
        return f"columns differ: spark={sc} duck={dc}"
    if len(srows) != len(drows):
        return f"row counts differ: spark={len(srows)} duck={len(drows)}"
    a = sorted(srows, key=_key)
    b = sorted(drows, key=_key)
    for x, y in zip(a, b):
        if not _rows_equal(x, y):
            return f"first differing row: spark={x} duck={y}"
    return None


def _rows_equal(x, y):
    for a, b in zip(x, y):
        if isinstance(a, (int, float)) and isinstance(b, (int, float)) and not isinstance(a, bool):
            if a is None or b is None:
                return a is b
            if not math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-6):
                return False
        elif a != b:
            return False
    return True
