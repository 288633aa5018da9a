"""Holds a query's rows against its SQL on the same tables."""

from __future__ import annotations

import datetime
import glob
import math
from collections import Counter


def cell(x):
    if isinstance(x, bool) or x is None:
        return x
    if isinstance(x, float) or type(x).__name__ == "Decimal":
        x = float(x)
        return "nan" if math.isnan(x) else round(x, 5) + 0.0
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None).isoformat()
    return x


def oracle(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = path.rsplit("/", 1)[1].removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def difference(spark, con, sf_dir: str, run, sql: str) -> str:
    """What differs, or an empty text."""
    df = run(spark, sf_dir)
    names = sorted(df.columns)
    mine = Counter(tuple(cell(r[n]) for n in names) for r in df.collect())
    table = con.execute(sql).to_arrow_table()
    if sorted(table.column_names) != names:
        return f"columns {names} and {sorted(table.column_names)}"
    theirs = Counter(tuple(cell(r[n]) for n in names) for r in table.to_pylist())
    if mine != theirs:
        return f"{sum(mine.values())} and {sum(theirs.values())} rows; {list((mine - theirs).items())[:2]} and {list((theirs - mine).items())[:2]}"
    return ""
