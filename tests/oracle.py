"""Run a registered query and its SQL side by side. As a script: python tests/oracle.py SF [name ...]."""

import math
import sys
import threading
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

LIMIT = 60  # seconds per query
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(int(v))
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return f"{v:.6f}" if v != 0 else "0.000000"
    return str(v)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in data)


KIND = {"INTEGER": "int", "BIGINT": "int", "SMALLINT": "int", "HUGEINT": "HUGE", "DOUBLE": "float",
        "FLOAT": "float", "VARCHAR": "str", "BOOLEAN": "bool"}
SKIND = {"int": "int", "bigint": "int", "smallint": "int", "double": "float", "float": "float",
         "string": "str", "boolean": "bool"}


def compare(spark, con, sf_dir, name, fn, sql):
    t0 = time.time()
    df = fn(spark, sf_dir)
    got = df.collect()
    t1 = time.time()
    if sql is None:
        return "rows-only", len(got), t1 - t0, 0.0, ""
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    kinds = [(d[0], KIND.get(str(d[1]), str(d[1]))) for d in cur.description]
    t2 = time.time()
    if sorted(cols) != sorted(df.columns):
        return "COLUMNS", len(got), t1 - t0, t2 - t1, f"{sorted(df.columns)} vs {sorted(cols)}"
    skinds = {f.name: SKIND.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    bad = [(n, k, skinds[n]) for n, k in kinds if k != skinds[n]]
    a, b = rows(df.columns, got), rows(cols, want)
    if a != b:
        sa, sb = set(a), set(b)
        miss, extra = [x for x in b if x not in sa][:3], [x for x in a if x not in sb][:3]
        return "MISMATCH", len(got), t1 - t0, t2 - t1, f"{len(a)} vs {len(b)} missing {miss} extra {extra}"
    if bad:
        return "TYPES", len(got), t1 - t0, t2 - t1, str(bad)
    if not a:
        return "EMPTY", 0, t1 - t0, t2 - t1, ""
    return "ok", len(got), t1 - t0, t2 - t1, ""


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from tessella.session import build_session

    spark = build_session("local[8]", 8)
    spark.sparkContext.setLogLevel("OFF")
    sf_dir = f"/root/testdata/{sys.argv[1]}"
    con = connect(sf_dir)
    q, o = queries(), oracle_sql()
    names = [n for n in q if not sys.argv[2:] or any(n == a or (a.endswith("*") and n.startswith(a[:-1]))
                                                     or q[n].__module__.endswith("." + a) for a in sys.argv[2:])]
    bad = 0
    for n in names:
        guard = threading.Timer(LIMIT, spark.sparkContext.cancelAllJobs)
        guard.start()
        try:
            st, k, ts, td, msg = compare(spark, con, sf_dir, n, q[n], o.get(n))
        except Exception as e:  # noqa: BLE001
            st, k, ts, td, msg = "ERROR", 0, 0, 0, str(e).strip().replace("\n", " ")[:600]
        guard.cancel()
        bad += st not in ("ok", "rows-only")
        print(f"{st:10} {n:30} rows={k:<8} spark={ts:6.2f}s duck={td:5.2f}s {msg}", flush=True)
    print(f"{len(names)} queries, {bad} bad")
