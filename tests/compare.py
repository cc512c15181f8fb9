"""Run registered queries beside their SQL twins and compare whole results."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(v):
    if hasattr(v, "asDict"):
        v = v.asDict()
    if isinstance(v, dict):
        return tuple(sorted((k, _plain(x)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else (float(f"{v:.12g}") + 0.0)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


_KINDS = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean",
          "FLOAT": "float", "TIMESTAMP": "timestamp_ntz", "SMALLINT": "smallint", "DATE": "date"}


def compare(df, con, sql: str) -> list[str]:
    """Differences between a DataFrame and a SQL result; empty when equal."""
    cursor = con.execute(sql)
    names, kinds = [d[0] for d in cursor.description], [str(d[1]) for d in cursor.description]
    expected_columns, expected = rows_of(names, cursor.fetchall())
    columns, actual = rows_of(df.columns, [tuple(r) for r in df.collect()])
    problems = []
    if columns != expected_columns:
        return [f"columns {columns} != {expected_columns}"]
    types = dict(df.dtypes)
    for n, k in zip(names, kinds):
        if k in _KINDS and types[n] != _KINDS[k] or k in ("HUGEINT",) or k.startswith("DECIMAL"):
            problems.append(f"type of {n}: spark {types[n]}, sql {k}")
    if len(actual) != len(expected):
        problems.append(f"rows {len(actual)} != {len(expected)}")
    if actual != expected:
        known, wanted = set(actual), set(expected)
        left, right = [r for r in actual if r not in wanted], [r for r in expected if r not in known]
        problems.append(f"spark only {len(left)}: {left[:3]}; sql only {len(right)}: {right[:3]}")
    return problems


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as e
    from paystrata.session import build_session
    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
                                                "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = duck(sf), e.oracle_sql(), 0
    for name, fn in e.queries().items():
        if sys.argv[1:] and not any(a in name for a in sys.argv[1:]):
            continue
        start = time.time()
        try:
            if name in sqls:
                problems = compare(fn(spark, sf), con, sqls[name])
            else:
                problems = [] if fn(spark, sf).count() else ["no rows"]
        except Exception as ex:  # report and go on
            problems = [f"{type(ex).__name__}: {str(ex)[:700]}"]
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name:28s} {time.time() - start:6.1f}s "
              f"{'' if name in sqls else '(rows only)'} {' | '.join(problems)[:1500]}", flush=True)
    print("failures:", bad)
