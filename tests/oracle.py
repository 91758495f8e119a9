"""Run registered queries and their SQL side by side: ``python tests/oracle.py SF_DIR [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starfold.queries.aggregates import COUNTED  # noqa: E402


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in COUNTED:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return str(v)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def difference(df, con, sql: str) -> str | None:
    """What differs between a frame and the SQL's result, or None."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = rows_of(names, cursor.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(names)}"
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if not got and expected == []:
        return "no rows on either side"
    if len(got) != len(expected):
        return f"{len(got)} rows instead of {len(expected)}"
    for a, b in zip(got, expected):
        if a != b:
            return f"{a} instead of {b}"
    return None


def main() -> None:
    from starfold.queries import ORACLES, QUERIES
    from starfold.session import local_session

    sf_dir, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = local_session(cores=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            problem = difference(df, con, ORACLES[name]) if name in ORACLES else f"no SQL, {df.count()} rows"
        except Exception as e:  # noqa: BLE001 - report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} match")


if __name__ == "__main__":
    main()
