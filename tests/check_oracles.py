"""Run registered queries against their SQL oracles: ``python tests/check_oracles.py [name-prefix ...]``.

Rows are compared as bags, with columns ordered by name, as the driver does.
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb

REPO = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(REPO))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def plain(value):
    """A hashable value that still tells types apart: 1, 1.0 and Decimal('1.00') differ."""
    if isinstance(value, bool) or value is None or isinstance(value, (str, bytes)):
        return value
    if isinstance(value, int):
        return ("int", value)
    if isinstance(value, float):
        return ("float", "nan" if math.isnan(value) else value)
    if isinstance(value, Decimal):
        return ("decimal", str(value))
    if isinstance(value, (datetime, date)):
        return ("time", value.isoformat())
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    return ("other", str(value))


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(plain(row[i]) for i in order) for row in rows)


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def compare(spark, con, name, fn, sql, sf_dir):
    """Return ``(problem or None, row count)``."""
    df = fn(spark, sf_dir)
    got_cols, got = bag(df.columns, df.collect())
    total = sum(got.values())
    if sql is None:
        return None, total
    cursor = con.execute(sql)
    want_cols, want = bag([c[0] for c in cursor.description], cursor.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}", total
    if got != want:
        extra, missing = list((got - want).items())[:3], list((want - got).items())[:3]
        return f"{total} rows, oracle {sum(want.values())}; only in Spark {extra}; only in oracle {missing}", total
    return None, total


def main(prefixes, sf_dir="/root/testdata/sf0.01"):
    from __spark_entry__ import oracle_sql, queries
    from tests.conftest import make_session

    spark = make_session()
    con = connect(sf_dir)
    oracles = oracle_sql()
    bad = 0
    for name, fn in queries().items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        start = time.time()
        try:
            problem, total = compare(spark, con, name, fn, oracles.get(name), sf_dir)
        except Exception as error:  # report and go on with the next query
            problem, total = f"{type(error).__name__}: {str(error)[:1500]}", -1
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok':4} {name:36} {total:8} rows {time.time() - start:6.2f} s {problem or ''}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
