"""Compare registered Spark queries with their SQL on DuckDB.

As a script: ``python tests/oracle_check.py FOLDER [key ...]``.
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(v):
    if v is None or isinstance(v, (bool, str, int)):
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.10g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.10g}")
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    return str(v)


def kind(v) -> str:
    return {"datetime": "time", "date": "date"}.get(type(v).__name__, type(v).__name__)


def table_of(names, raw):
    order = sorted(range(len(names)), key=lambda i: names[i])
    lines = sorted((tuple(plain(r[i]) for i in order) for r in raw), key=repr)
    kinds = {names[i]: {kind(r[i]) for r in raw if r[i] is not None} for i in order}
    return [names[i] for i in order], kinds, lines


def compare(spark, con, folder, query, sql) -> str | None:
    """None when both sides agree, else what differs."""
    df = query(spark, folder)
    s_names, s_kinds, s_rows = table_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    d_names, d_kinds, d_rows = table_of([c[0] for c in result.description], result.fetchall())
    if s_names != d_names:
        return f"columns {s_names} vs {d_names}"
    if len(s_rows) != len(d_rows):
        return f"row count {len(s_rows)} vs {len(d_rows)}; first {s_rows[:2]} vs {d_rows[:2]}"
    if not s_rows:
        return "no rows on either side"
    if s_kinds != d_kinds:
        return f"types { {c: (s_kinds[c], d_kinds[c]) for c in s_names if s_kinds[c] != d_kinds[c]} }"
    bad = [(a, b) for a, b in zip(s_rows, d_rows) if a != b]
    return f"{len(bad)} of {len(s_rows)} rows differ, e.g. {bad[:3]} columns {s_names}" if bad else None


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from sluice.session import tuned_session

    folder, keys = sys.argv[1], sys.argv[2:]
    spark = tuned_session("check", "local[8]", 8, {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, failed = connect(folder), oracle_sql(), 0
    for key, fn in queries().items():
        if keys and key not in keys:
            continue
        start = time.time()
        try:
            if key in sql:
                problem = compare(spark, con, folder, fn, sql[key])
            else:
                problem = None if fn(spark, folder).count() else "no rows"
        except Exception as e:  # report and go on with the next key
            problem = f"{type(e).__name__}: {str(e)[:700]}"
        failed += problem is not None
        label = "ok" if problem is None else "FAIL"
        print(f"{label:4} {key:24} {time.time() - start:6.2f}s {'' if key in sql else 'rows-only'} {problem or ''}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main())
