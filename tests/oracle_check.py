"""Compare registered queries with their DuckDB texts: ``python tests/oracle_check.py SF [names...]``."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(v):
        if isinstance(v, float):
            return round(v, 6)
        return v if v is None or isinstance(v, (str, bool)) else int(v) if isinstance(v, int) else str(v)

    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name: str, fn, sql: str, sf_dir: str) -> tuple[bool, str]:
    df = fn(spark, sf_dir)
    ours = rows_of(df.columns, df.collect())
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs = rows_of(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return False, f"columns {sorted(df.columns)} / {sorted(names)}"
    if ours != theirs:
        a, b = set(ours), set(theirs)
        show = f"rows {len(ours)}/{len(theirs)} only ours {len(a - b)} only theirs {len(b - a)}"
        return False, show + "".join(f"\n   - {str(x)[:700]}" for x in sorted(a - b, key=repr)[:2]) + "".join(
            f"\n   + {str(x)[:700]}" for x in sorted(b - a, key=repr)[:2])
    return True, f"{len(ours)} rows"


if __name__ == "__main__":
    import __spark_entry__ as entry
    from scholion.session import INPUT_PARTITIONS, build_session

    sf_dir = f"/root/testdata/sf{sys.argv[1]}"
    spark = build_session("oracle-check", "local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set(INPUT_PARTITIONS, "8")
    con = connect(sf_dir)
    oracles = entry.oracle_sql()
    wanted = sys.argv[2:]
    bad = 0
    for name, fn in entry.queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            if name in oracles:
                ok, note = compare(spark, con, name, fn, oracles[name], sf_dir)
            else:
                ok, note = True, f"{fn(spark, sf_dir).count()} rows, no oracle"
        except Exception as exc:
            ok, note = False, str(exc)[:1500]
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.1f}s {note}", flush=True)
    print("failures:", bad)
