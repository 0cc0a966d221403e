"""Compare registered queries with their SQL, run by DuckDB on the same tables.

python tests/oracle.py [folder] [name …]
"""

import math
import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

SQL_TYPES = {
    "boolean": "BOOLEAN",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day).isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def compare(name, build, sql, spark, con, folder):
    """None when equal, else a description of the difference."""
    df = build(spark, folder)
    got_columns, got = df.columns, df.collect()
    result = con.execute(sql)
    want_columns = [d[0] for d in result.description]
    want = result.fetchall()
    if sorted(got_columns) != sorted(want_columns):
        return f"columns {sorted(got_columns)} != {sorted(want_columns)}", len(got)
    got_rows, want_rows = rows_of(got_columns, got), rows_of(want_columns, want)
    if got_rows == want_rows:
        ours = {f.name: SQL_TYPES.get(f.dataType.simpleString()) for f in df.schema}
        theirs = {d[0]: str(d[1]) for d in result.description}
        kinds = {c: (ours[c], theirs[c]) for c in ours if ours[c] != theirs[c]}
        return (f"types differ: {kinds}" if kinds else None), len(got)
    extra, lacking = got_rows - want_rows, want_rows - got_rows
    return (
        f"{len(got)} rows against {len(want)}; columns {sorted(got_columns)}\n   extra   {list(extra.items())[:3]}"
        f"\n   lacking {list(lacking.items())[:3]}"
    ), len(got)


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).parent.parent))
    import __spark_entry__ as entry
    from stationcast.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session("8", "oracle")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in sys.argv[2:] or oracles:
        began = time.time()
        try:
            problem, n = compare(name, queries[name], oracles[name], spark, con, folder)
        except Exception as error:
            problem, n = f"{type(error).__name__}: {str(error)[:1500]}", 0
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {n} rows {time.time() - began:.1f}s {problem or ''}", flush=True)
    print(f"{bad} differ")
    sys.exit(bad > 0)
