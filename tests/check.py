"""Run queries against their DuckDB SQL: python tests/check.py [sf] [name-substring ...]"""

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def norm(df: pd.DataFrame) -> list[tuple]:
    def cell(v):
        if v is None or (isinstance(v, float) and v != v) or v is pd.NA or v is pd.NaT:
            return "~"
        if hasattr(v, "tolist"):
            v = v.tolist()
        if isinstance(v, bool):
            return str(v)
        if isinstance(v, float):
            return repr(v) if v != int(v) or abs(v) > 1e15 else repr(int(v))
        return str(v)
    cols = sorted(df.columns)
    return sorted(tuple(cell(v) for v in row) for row in df[cols].itertuples(index=False))


def oracle(sf_dir: str, sql: str) -> pd.DataFrame:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con.execute(sql).df()


def compare(a: pd.DataFrame, b: pd.DataFrame) -> str:
    if sorted(a.columns) != sorted(b.columns):
        return f"columns {sorted(a.columns)} vs {sorted(b.columns)}"
    x, y = norm(a), norm(b)
    if len(x) != len(y):
        return f"rows {len(x)} vs {len(y)}"
    bad = [(p, q) for p, q in zip(x, y) if p != q]
    return f"{len(bad)} rows differ, e.g. {str(bad[0][0])[:300]} | {str(bad[0][1])[:300]}" if bad else ""


def main():
    import __spark_entry__ as entry
    from tests.conftest import make_spark
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    pats = sys.argv[2:]
    spark, d, fails = make_spark(), f"/root/testdata/sf{sf}", []
    for name, fn in entry.queries().items():
        if pats and not any(p in name for p in pats):
            continue
        try:
            t0 = time.time()
            got = fn(spark, d).toPandas()
            t1 = time.time()
            sql = entry.oracle_sql().get(name)
            msg = "no oracle" if sql is None else compare(got, oracle(d, sql)) or "ok"
            t2 = time.time()
        except Exception as e:
            msg, t1, t2, got = "ERR " + str(e)[:600], time.time(), time.time(), []
        if msg not in ("ok", "no oracle"):
            fails.append(name)
        print(f"{name:34s} {len(got):8d} rows {t1 - t0:6.1f}s duck {t2 - t1:5.1f}s  {msg}", flush=True)
    print("FAILED:", fails)


if __name__ == "__main__":
    main()
