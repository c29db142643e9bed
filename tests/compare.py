"""Run registered queries against their SQL in DuckDB and compare types and all rows.

    python tests/compare.py [--sf 0.01] [--dir FOLDER] [--partitions N] [--no-broadcast] [name ...]
"""

from __future__ import annotations

import argparse
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

# Spark type -> DuckDB type of the same values
SAME_TYPE = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return connection


def row_key(row):
    # repr tells 1 from 1.0 and keeps every bit of a double; -0.0 counts as 0.0
    return tuple(repr(v + 0.0) if isinstance(v, float) else repr(v) for v in row)


def difference(df, connection, sql: str) -> str | None:
    """None if both results are equal, else what differs."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    expected = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    for name, kind in df.dtypes:
        if SAME_TYPE.get(kind) != kinds[name]:
            return f"type of {name}: {kind} != {kinds[name]}"
    order = sorted(names)
    picked = [names.index(n) for n in order]
    want = Counter(row_key([row[i] for i in picked]) for row in expected)
    got = Counter(row_key(list(row)) for row in df.select(*[f"`{n}`" for n in order]).collect())
    if want == got:
        return None
    missing, surplus = want - got, got - want
    return (
        f"{sum(got.values())} rows, expected {sum(want.values())}; {sum(missing.values())} missing, "
        f"e.g. {sorted(missing)[:2]}; {sum(surplus.values())} surplus, e.g. {sorted(surplus)[:2]}; columns {order}"
    )


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("names", nargs="*")
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("--dir")
    parser.add_argument("--partitions", default="8")
    parser.add_argument("--no-broadcast", action="store_true", help="plan all joins as for large tables")
    options = parser.parse_args()
    import __spark_entry__ as entry
    from saleslake.session import local_session
    from saleslake.sources.shared import scratch

    folder = options.dir or f"/root/testdata/sf{options.sf}"
    spark = local_session("compare", 8, spark__sql__shuffle__partitions=options.partitions)
    if options.no_broadcast:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    connection = duck(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in options.names or queries:
        started = time.time()
        try:
            with scratch(spark):
                df = queries[name](spark, folder)
                if name in oracles:
                    problem = difference(df, connection, oracles[name])
                    state = "ok" if problem is None else "DIFFERS " + problem
                else:
                    state = f"rows only: {len(df.collect())}"
        except Exception as error:  # report and go on with the next query
            state = f"FAILED {type(error).__name__}: {str(error)[:1500]}"
        bad += state.startswith(("DIFFERS", "FAILED"))
        print(f"{name:32s} {time.time() - started:6.2f}s {state}", flush=True)
    print(f"{bad} of {len(options.names or queries)} bad")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
