"""Run the registered queries against their SQL twins: ``python -m checks.compare``.

Arguments: names of queries; without names all are run.  ``SF_DIR`` names the
table folder.
"""

from __future__ import annotations

import math
import os
import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6) + 0.0)
    if isinstance(value, bool) or value is None:
        return repr(value)
    if isinstance(value, int):
        return repr(value)
    try:
        return repr(round(float(value), 6) + 0.0) if type(value).__name__ == "Decimal" else str(value)
    except ValueError:
        return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(normal(r[i]) for i in order) for r in rows)


def compare(spark, folder, names):
    import duckdb

    from checks import oracle, registry

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    failures = []
    for name in names:
        started = time.monotonic()
        try:
            frame = registry.QUERIES[name](spark, folder)
            got = rows_of(frame.columns, frame.collect())
        except Exception as problem:  # report and go on with the other queries
            failures.append(name)
            print(f"{name:26s} ERROR {type(problem).__name__}: {str(problem)[:600]}", flush=True)
            continue
        spark_time = time.monotonic() - started
        if name not in oracle.SQL:
            print(f"{name:26s} rows={len(got[1])} spark={spark_time:.1f}s (no SQL)", flush=True)
            continue
        started = time.monotonic()
        try:
            result = con.execute(oracle.SQL[name])
            wanted = rows_of([d[0] for d in result.description], result.fetchall())
        except Exception as problem:
            failures.append(name)
            print(f"{name:26s} SQL ERROR {str(problem)[:600]}", flush=True)
            continue
        duck_time = time.monotonic() - started
        same = got == wanted
        print(
            f"{name:26s} {'ok  ' if same else 'DIFF'} rows={len(got[1])}/{len(wanted[1])} "
            f"spark={spark_time:.1f}s sql={duck_time:.1f}s",
            flush=True,
        )
        if not same:
            failures.append(name)
            if got[0] != wanted[0]:
                print("   columns", got[0], wanted[0])
            else:
                a, b = set(got[1]), set(wanted[1])
                print("   only spark", [str(x)[:300] for x in sorted(a - b)[:2]], len(a - b))
                print("   only sql  ", [str(x)[:300] for x in sorted(b - a)[:2]], len(b - a))
    return failures


def session(cores: str = "8"):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("checks")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


if __name__ == "__main__":
    from checks import registry

    chosen = sys.argv[1:] or list(registry.QUERIES)
    bad = compare(session(), os.environ.get("SF_DIR", "/root/testdata/sf0.01"), chosen)
    print("failed:", bad)
    sys.exit(1 if bad else 0)
