"""Compare a registered Spark query with its DuckDB twin.

Used by the test suite and runnable by hand:
``python tests/oracle_compare.py [sf_dir] [query ...]``.
"""

from __future__ import annotations

import datetime as dt
import decimal
import sys
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]

_TYPE_MAP = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "date": "DATE", "double": "DOUBLE",
             "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return "\0"
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return str(v)


def spark_type(t) -> str:
    s = t.simpleString()
    if s.startswith("decimal"):
        return s.upper().replace(" ", "")
    return _TYPE_MAP.get(s, s.upper())


def compare(spark, con, name: str, sf_dir: str) -> tuple[bool, str]:
    from vitrine.plans.catalog import queries
    from vitrine.plans.oracle_sql import ORACLE

    df = queries()[name](spark, sf_dir)
    s_rows = [tuple(r) for r in df.collect()]
    s_cols = df.columns
    s_types = {f.name: spark_type(f.dataType) for f in df.schema.fields}
    rel = con.sql(ORACLE[name])
    d_cols = rel.columns
    d_types = {c: str(t).replace(" ", "") for c, t in zip(rel.columns, rel.types)}
    d_rows = rel.fetchall()
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns spark={s_cols} duck={d_cols}")
        return False, "; ".join(problems)
    for c in s_cols:
        if s_types[c] != d_types[c]:
            problems.append(f"type {c}: spark={s_types[c]} duck={d_types[c]}")
    if len(s_rows) != len(d_rows):
        problems.append(f"rows spark={len(s_rows)} duck={len(d_rows)}")
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    sv = sorted(tuple(_norm(r[i]) for i in si) for r in s_rows)
    dv = sorted(tuple(_norm(r[i]) for i in di) for r in d_rows)
    if sv != dv:
        in_s, in_d = set(sv), set(dv)
        diff_s = [r for r in sv if r not in in_d][:3]
        diff_d = [r for r in dv if r not in in_s][:3]
        problems.append(f"values differ; cols={order}; spark-only={diff_s}; duck-only={diff_d}")
    return not problems, "; ".join(problems)


def main(argv: list[str]) -> int:
    from vitrine.plans.catalog import queries
    from vitrine.plans.oracle_sql import ORACLE
    from vitrine.session import get_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or [n for n in queries() if n in ORACLE]
    spark = get_session("local[8]", 8)
    con = duck_connection(sf_dir)
    bad = 0
    for n in names:
        try:
            ok, msg = compare(spark, con, n, sf_dir)
        except Exception as e:  # report and continue
            ok, msg = False, f"{type(e).__name__}: {str(e)[:800]}"
        bad += not ok
        print(("PASS " if ok else "FAIL ") + n + ("" if ok else "  " + msg), flush=True)
    missing = [n for n in queries() if n not in ORACLE]
    print(f"{len(names) - bad}/{len(names)} pass; no oracle: {missing}")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
