"""Run queries beside their DuckDB SQL: python -m tests.compare [--sf DIR] [NAME...]"""

from __future__ import annotations

import datetime
import glob
import math
import os
import sys
import time

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def session(cores: int = 8):
    from pyspark.sql import SparkSession

    return (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def value(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else float(f"{x:.9g}")
    if isinstance(x, (list, tuple)):
        return tuple(value(y) for y in x)
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None).isoformat()
    if isinstance(x, datetime.date):
        return x.isoformat()
    if isinstance(x, dict):
        return tuple(sorted((k, value(v)) for k, v in x.items()))
    return int(x) if hasattr(x, "as_integer_ratio") and not isinstance(x, (float, bool)) else x


def rows(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted((tuple(value(r[i]) for i in order) for r in records), key=repr)


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if glob.glob(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
    return con


def compare(spark, sf_dir: str, query, sql: str) -> str:
    """"" if both agree, else what differs."""
    df = query(spark, sf_dir)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    cur = duck(sf_dir).execute(sql)
    want = rows([d[0] for d in cur.description], cur.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} and {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} and {len(want[1])}; {sorted(set(got[1]) - set(want[1]), key=repr)[:2]} / {sorted(set(want[1]) - set(got[1]), key=repr)[:2]}"
    bad = [(g, w) for g, w in zip(got[1], want[1], strict=True) if g != w]
    return f"{len(bad)} of {len(got[1])} rows differ: {str(bad[0])[:900]}" if bad else ""


def main(args: list[str]) -> int:
    import __spark_entry__ as entry

    sf = "/root/testdata/sf0.01"
    if args[:1] == ["--sf"]:
        sf, args = args[1], args[2:]
    spark, wrong = session(), 0
    queries, sql = entry.queries(), entry.oracle_sql()
    for name in args or queries:
        began = time.time()
        try:
            said = compare(spark, sf, queries[name], sql[name]) if name in sql else f"no SQL; {queries[name](spark, sf).count()} rows"
        except Exception as e:
            said = f"{type(e).__name__}: {str(e)[:700]}"
        wrong += bool(said) and not said.startswith("no SQL")
        print(f"{name}: {said or 'ok'} ({time.time() - began:.1f} s)", flush=True)
    return wrong


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
