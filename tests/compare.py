"""Run registered queries against DuckDB on the same Parquet tables.

    python tests/compare.py SF_DIR [name ...]
"""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value) -> str:
    if value is None:
        return "\\N"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return f"{value:.9g}"
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(_cell(v) for v in value) + "]"
    if isinstance(value, dict):
        return "{" + ",".join(f"{k}:{_cell(v)}" for k, v in sorted(value.items())) + "}"
    return str(value)


def _rows(columns: list[str], rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def spark_result(df):
    return df.columns, [tuple(r) for r in df.collect()]


def duck_result(con, sql: str):
    cursor = con.execute(sql)
    return [c[0] for c in cursor.description], cursor.fetchall()


def difference(left, right) -> str | None:
    """None when equal, else a short description."""
    (lc, lr), (rc, rr) = left, right
    if sorted(lc) != sorted(rc):
        return f"columns {sorted(lc)} != {sorted(rc)}"
    a, b = _rows(lc, lr), _rows(rc, rr)
    if a == b:
        return None
    only_a = [r for r in a if r not in set(b)][:2]
    only_b = [r for r in b if r not in set(a)][:2]
    return f"rows {len(a)} vs {len(b)}\n   spark {only_a}\n   sql   {only_b}"


def main(sf_dir: str, names: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from jobweave.session import local_session

    spark = local_session(cores="8")
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connect(sf_dir), oracle_sql(), 0
    for name, fn in queries().items():
        if names and not any(name == n or (n.endswith("*") and name.startswith(n[:-1])) for n in names):
            continue
        started = time.time()
        try:
            got = spark_result(fn(spark, sf_dir))
            if name in sql:
                problem = difference(got, duck_result(con, sql[name]))
                label = "ok" if problem is None else "DIFF " + problem
            else:
                problem, label = None, "rows-only"
        except Exception as error:  # report and go on
            problem = label = "ERROR " + "".join(traceback.format_exception_only(error))[:1500]
            got = ([], [])
        bad += problem is not None
        print(f"{name:32s} {len(got[1]):7d} rows {time.time() - started:6.2f}s {label}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1].rstrip("/"), sys.argv[2:]) else 0)
