"""Run named queries beside their oracle SQL and report differences.

Usage: python tests/oracle_check.py [SF_DIR] [NAME ...]
"""
from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if hasattr(v, "tolist"):
        return [_plain(x) for x in v.tolist()]
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def compare(spark_df, con, sql: str) -> list[str]:
    got_cols, got = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    want_cols, want = _rows([d[0] for d in cur.description], cur.fetchall())
    problems = []
    if got_cols != want_cols:
        problems.append(f"columns {got_cols} vs {want_cols}")
        return problems
    if len(got) != len(want):
        problems.append(f"rows {len(got)} vs {len(want)}")
    from collections import Counter

    a, b = Counter(got), Counter(want)
    only_a, only_b = sorted((a - b).elements(), key=repr), sorted((b - a).elements(), key=repr)
    if only_a or only_b:
        problems.append(f"{len(only_a)} rows differ; e.g.\n  spark  {only_a[:2]}\n  oracle {only_b[:2]}")
    types = [t for t in zip(got_cols, (type(x).__name__ for x in got[0]), (type(x).__name__ for x in want[0]))
             if t[1] != t[2] and "NoneType" not in t] if got and want else []
    if types:
        problems.append(f"types {types}")
    if not got:
        problems.append("no rows")
    return problems


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    from bench import make_session
    from __spark_entry__ import oracle_sql, queries

    spark, con = make_session(), connect(sf_dir)
    qs, oracles = queries(), oracle_sql()
    names = args[1:] or list(qs)
    bad = 0
    for name in names:
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            if name in oracles:
                problems = compare(df, con, oracles[name])
            else:
                n = len(df.collect())
                problems = [] if n else ["no rows"]
        except Exception as e:  # report and go on with the next query
            problems = [f"{type(e).__name__}: {str(e)[:6000]}"]
        bad += bool(problems)
        kind = "oracle" if name in oracles else "rows  "
        print(f"{'FAIL' if problems else 'ok  '} {kind} {name} {time.time() - t0:.1f}s", *problems, flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return bool(bad)


if __name__ == "__main__":
    sys.exit(main())
