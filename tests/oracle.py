"""Compare a registered query with its SQL twin on the same parquet tables.

Usage: python tests/oracle.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, float):
        return v if not math.isfinite(v) else float(f"{v:.12g}")
    if isinstance(v, int):
        return v
    if hasattr(v, "as_tuple"):
        return float(v)
    return v if isinstance(v, str) else str(v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=repr)


def spark_rows(df):
    return _rows(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    cur = con.execute(sql)
    return _rows([d[0] for d in cur.description], cur.fetchall())


def difference(spark_side, sql_side) -> str | None:
    if spark_side[0] != sql_side[0]:
        return f"columns {spark_side[0]} != {sql_side[0]}"
    a, b = spark_side[1], sql_side[1]
    if a == b:
        return None
    only_a = [r for r in a if r not in set(b)][:3]
    only_b = [r for r in b if r not in set(a)][:3]
    return f"rows {len(a)} != {len(b)}; spark only {only_a}; sql only {only_b}"


def main() -> int:
    from listloom import plans, session

    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.001"
    registry = plans.load()
    wanted = args[1:] or list(registry)
    spark = (
        session.builder("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in wanted:
        q = registry[name]
        started = time.time()
        try:
            got = spark_rows(q(spark, sf_dir))
            took = time.time() - started
            problem = difference(got, sql_rows(con, q.sql)) if q.sql else None
            state = "ok" if problem is None else "DIFF"
            print(f"{state:5} {name:28} {took:6.2f}s rows={len(got[1])} sql={time.time() - started - took:.2f}s {problem or ''}", flush=True)
        except Exception as e:  # noqa: BLE001
            state = "FAIL"
            print(f"FAIL  {name:28} {type(e).__name__}: {str(e)[:900]}", flush=True)
        failed += state != "ok"
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
