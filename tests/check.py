"""Compare registered queries with their SQL twins in DuckDB."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time

import duckdb

sys.path.insert(0, "/root/repo")
from shelfline.catalog import SQL, runnable  # noqa: E402
from shelfline.session import scratch_scope  # noqa: E402
from shelfline.views import NAMES  # noqa: E402


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return 0.0 if value == 0 else value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    body = sorted(tuple(repr(plain(r[i])) for i in order) for r in rows)
    return [names[i] for i in order], body


FAMILY = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
}


def difference(spark, folder, name, con=None) -> str | None:
    """None when equal, else what differs."""
    with scratch_scope(spark):
        df = runnable()[name](spark, folder)
        got = table(df.columns, [tuple(r) for r in df.collect()])
    if name not in SQL:
        return None if got[1] else "no rows"
    con = con or connect(folder)
    rel = con.sql(SQL[name])
    want = table(rel.columns, rel.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    kinds = {c: FAMILY.get(k, k) for c, k in df.dtypes}
    other = {c: str(k) for c, k in zip(rel.columns, rel.types)}
    if kinds != other:
        bad = {c: (kinds[c], other[c]) for c in kinds if kinds[c] != other[c]}
        return f"types {bad}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} != {len(want[1])}"
    if not got[1]:
        return "both empty"
    if got[1] != want[1]:
        odd = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
        return f"{len(odd)} rows differ, first {str(odd[0])[:600]}"
    return None


if __name__ == "__main__":
    from shelfline.session import build_session

    folder = f"/root/testdata/sf{sys.argv[1]}"
    spark = build_session(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    wanted = sys.argv[2:] or list(runnable())
    bad = 0
    for name in wanted:
        began = time.time()
        try:
            diff = difference(spark, folder, name, con)
        except Exception as error:  # noqa: BLE001
            diff = f"{type(error).__name__}: {str(error)[:700]}"
        bad += diff is not None
        print(f"{'ok ' if diff is None else 'BAD'} {time.time() - began:6.2f}s {name} {'' if name in SQL else '(rows only)'} {diff or ''}", flush=True)
    print(f"{len(wanted) - bad} of {len(wanted)} equal")
