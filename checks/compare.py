"""Run queries against their SQL in DuckDB: ``python -m checks.compare sf0.01 [name ...]``."""

import math
import os
import sys
import tempfile
import time

import duckdb

from biomesheaf.session import cohort_session

from . import catalog
from .views import TABLES

DATA = "/root/testdata"


def duck(folder):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con


def _plain(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return None
    if isinstance(x, bool):
        return x
    if hasattr(x, "item"):
        x = x.item()
    if isinstance(x, float):
        return round(x, 9)
    if type(x).__name__ == "Decimal":
        return round(float(x), 9)
    return x


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(plain, key=lambda r: tuple((x is None, str(type(x)), x) for x in r))


def compare(spark, con, folder, name):
    begin = time.time()
    df = catalog.QUERIES[name](spark, folder)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - begin
    if name not in catalog.ORACLES:
        return "rows-only", len(got[1]), took, ""
    begin = time.time()
    cur = con.execute(catalog.ORACLES[name])
    want = _rows([d[0] for d in cur.description], cur.fetchall())
    sql_took = time.time() - begin
    note = f"sql {sql_took:.1f}s"
    if got[0] != want[0]:
        return "COLUMNS", len(got[1]), took, f"{got[0]} != {want[0]}"
    if got[1] != want[1]:
        only = [r for r in got[1] if r not in set(want[1])][:2]
        lost = [r for r in want[1] if r not in set(got[1])][:2]
        return "ROWS", len(got[1]), took, f"{len(got[1])} != {len(want[1])}; spark {only} sql {lost}"
    return "ok", len(got[1]), took, note


def main(argv):
    folder = f"{DATA}/{argv[0] if argv else 'sf0.001'}"
    names = argv[1:] or list(catalog.QUERIES)
    spark = cohort_session(master=f"local[{os.environ.get('CPUS', '8')}]", shuffle_partitions=8, driver_memory="8g", scratch=tempfile.mkdtemp(prefix="scratch-"))
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(folder), 0
    for name in names:
        try:
            status, n, took, note = compare(spark, con, folder, name)
        except Exception as e:  # noqa: BLE001
            status, n, took, note = "ERROR", 0, 0, str(e)[:1500]
        bad += status not in ("ok", "rows-only")
        print(f"{status:10s} {name:32s} rows={n:<8d} {took:6.2f}s {note}", flush=True)
    print(f"{len(names) - bad}/{len(names)} agree")


if __name__ == "__main__":
    main(sys.argv[1:])
