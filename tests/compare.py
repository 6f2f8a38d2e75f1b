"""Order-insensitive comparison of Spark and DuckDB results (column names, row count, values)."""

from __future__ import annotations

import datetime as dt
import decimal
import math

#: The table folder of the small tests.
SF_SMALL = "/root/testdata/sf0.001"


def canon(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return str(v)


def rows_of(cols, rows, order):
    idx = [cols.index(c) for c in order]
    out = [tuple(canon(r[i]) for i in idx) for r in rows]
    return sorted(out, key=lambda r: tuple("" if x is None else x for x in r))


def compare(spark_df, duck_con, sql):
    """Return a list of problems (empty when Spark and DuckDB agree)."""
    cols = spark_df.columns
    srows = [tuple(r) for r in spark_df.collect()]
    res = duck_con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    if sorted(cols) != sorted(dcols):
        return [f"columns differ: spark={cols} duckdb={dcols}"]
    order = sorted(cols)
    a, b = rows_of(cols, srows, order), rows_of(dcols, drows, order)
    problems = []
    if len(a) != len(b):
        problems.append(f"row count spark={len(a)} duckdb={len(b)}")
    if a != b:
        sb, sa = set(b), set(a)
        problems.append(f"values differ on {order}: spark-only={[x for x in a if x not in sb][:2]} "
                        f"duckdb-only={[x for x in b if x not in sa][:2]}")
    return problems


def register_views(con, sf_dir, tables=("events",)):
    for t in tables:
        con.execute(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
