"""Runs registered queries on Spark and their SQL on DuckDB and compares the rows.

python -m checks.compare [folder] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def canon(v):
    if v is None:
        return ""
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(int(v)) if v == int(v) else f"{v:.6f}".rstrip("0")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(" ")
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(canon(x) for x in v) + "]"
    return str(v)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted([tuple(canon(r[i]) for i in order) for r in rows])


def session():
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(argv):
    import duckdb

    from . import oracle, registry

    sf = argv[0] if argv else "/root/testdata/sf0.01"
    queries, sqls = registry.queries(), oracle.build()
    names = argv[1:] or list(queries)
    spark = session()
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    bad = []
    for name in names:
        try:
            t0 = time.time()
            df = queries[name](spark, sf)
            got = [tuple(r) for r in df.collect()]
            t1 = time.time()
            if name not in sqls:
                print(f"ROWS {name} {len(got)} spark={t1 - t0:.1f}s", flush=True)
                continue
            cur = con.execute(sqls[name])
            cols = [c[0] for c in cur.description]
            types = dict(zip(cols, [str(c[1]) for c in cur.description]))
            want = cur.fetchall()
            t2 = time.time()
            note = ""
            if sorted(cols) != sorted(df.columns):
                note = f"columns {sorted(set(cols) ^ set(df.columns))}"
            else:
                a, b = rows_of(df.columns, got), rows_of(cols, want)
                if a != b:
                    x = [r for r in set(a) - set(b)]
                    y = [r for r in set(b) - set(a)]
                    note = f"rows differ {len(x)}/{len(y)} spark={min(x, default=None)} sql={min(y, default=None)}"
            print(f"{'FAIL' if note else 'ok'} {name} {len(got)}/{len(want)} spark={t1 - t0:.1f}s sql={t2 - t1:.1f}s {note[:900]}", flush=True)
            clash = [(c, t, types.get(c)) for c, t in df.dtypes if types.get(c) in ("HUGEINT",) or str(types.get(c)).startswith("DECIMAL")]
            if clash:
                print("  types", clash, flush=True)
            if note:
                bad.append(name)
        except Exception as e:  # noqa: BLE001
            bad.append(name)
            print(f"FAIL {name} {type(e).__name__}: {str(e)[:900]}", flush=True)
    print("failed:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
