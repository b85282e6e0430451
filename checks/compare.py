"""Run the queries and their SQL side by side: ``python -m checks.compare [names] [sf_dir]``."""

from __future__ import annotations

import datetime
import decimal
import sys
import tempfile
import time

import duckdb

from checks.oracle import ORACLE
from checks.queries import QUERIES, TABLES


def plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v) if v % 1 else int(v)
    if isinstance(v, float) and v.is_integer():
        return int(v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr(tuple(plain(r[i]) for i in order)) for r in rows)


def main() -> int:
    from hirestream.session import build_session

    names = sys.argv[1].split(",") if len(sys.argv) > 1 and sys.argv[1] else list(QUERIES)
    sf = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.01"
    spark = build_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="checks-"), "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    bad = 0
    for n in names:
        t0 = time.time()
        try:
            df = QUERIES[n](spark, sf)
            got = rows_of(df.columns, df.collect())
        except Exception as e:  # noqa: BLE001
            print(f"{n:30s} SPARK FAIL {str(e)[:500]}", flush=True)
            bad += 1
            continue
        t1 = time.time()
        if n not in ORACLE:
            print(f"{n:30s} rows only {len(got):6d} {t1 - t0:6.2f}s", flush=True)
            continue
        try:
            cur = con.execute(ORACLE[n])
            cols = [d[0] for d in cur.description]
            want = rows_of(cols, cur.fetchall())
        except Exception as e:  # noqa: BLE001
            print(f"{n:30s} DUCK FAIL {str(e)[:500]}", flush=True)
            bad += 1
            continue
        t2 = time.time()
        if sorted(cols) != sorted(df.columns):
            print(f"{n:30s} COLUMNS {sorted(set(cols) ^ set(df.columns))}", flush=True)
            bad += 1
        elif got != want:
            bad += 1
            print(f"{n:30s} DIFF {len(got)} vs {len(want)}", flush=True)
            only_g, only_w = sorted(set(got) - set(want)), sorted(set(want) - set(got))
            print("   columns", sorted(cols))
            for x in only_g[:2]:
                print("   spark", x[:700])
            for x in only_w[:2]:
                print("   duck ", x[:700])
        else:
            print(f"{n:30s} ok {len(got):6d} spark {t1 - t0:6.2f}s duck {t2 - t1:5.2f}s", flush=True)
    print("bad", bad)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
