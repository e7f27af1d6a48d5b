"""Run queries on Spark and their SQL on DuckDB, and compare the results.

``python tests/oracle.py [sf_dir] [name …]`` checks all or the named queries.
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET threads = 4")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if hasattr(value, "as_tuple"):
        return ("decimal", str(value))
    return value


def _kind(value) -> str:
    return type(value).__name__


def compare(spark_df, con, sql: str) -> list[str]:
    """Differences in columns, value types and rows; empty when equal."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    problems = []
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns differ: spark {sorted(spark_df.columns)} sql {sorted(names)}"]
    order = sorted(names)
    mine = Counter(tuple(_plain(r[c]) for c in order) for r in spark_df.collect())
    index = [names.index(c) for c in order]
    theirs = Counter(tuple(_plain(r[i]) for i in index) for r in expected)
    if sum(mine.values()) != sum(theirs.values()):
        problems.append(f"rows: spark {sum(mine.values())} sql {sum(theirs.values())}")
    only_mine, only_theirs = mine - theirs, theirs - mine
    if only_mine or only_theirs:
        problems.append(
            f"{sum(only_mine.values())} rows only in spark, {sum(only_theirs.values())} only in sql; columns {order}\n"
            f"    spark {list(only_mine)[:2]}\n    sql   {list(only_theirs)[:2]}"
        )
    for i, c in enumerate(order):
        left = {_kind(r[i]) for r in mine if r[i] is not None}
        right = {_kind(r[i]) for r in theirs if r[i] is not None}
        if left != right:
            problems.append(f"column {c}: spark {left} sql {right}")
    duck = dict(zip(names, [str(d[1]) for d in con.execute(sql).description]))
    wide = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
            "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT"}
    for c, t in spark_df.dtypes:
        if wide.get(t) != duck[c]:
            problems.append(f"type of {c}: spark {t} sql {duck[c]}")
    return problems


def main(argv: list[str]) -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from dialtide.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session(
        "oracle", "local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="8", spark__driver__memory="8g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in argv[1:] or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracles:
                problems = compare(df, con, oracles[name])
                note = "sql"
            else:
                rows = df.count()
                problems, note = ([] if rows else ["no rows"]), f"{rows} rows"
        except Exception as error:  # noqa: BLE001
            problems, note = [f"{type(error).__name__}: {str(error)[:600]}"], "error"
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} ({note}, {time.time() - start:.1f}s)", *problems, sep="\n  " if problems else "")
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
