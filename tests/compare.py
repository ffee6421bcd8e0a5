"""Run queries and their SQL side by side: python -m tests.compare [sf_dir] [name ...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
import __spark_entry__ as entry  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def session(cpus: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("noticeboard")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET enable_progress_bar = false")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def _kind(name: str) -> str:
    names = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "double": "DOUBLE", "decimal": "DECIMAL"}
    return names.get(name.split("(")[0], name)


def compare(spark: SparkSession, con, sf: str, name: str) -> str:
    """Empty when both sides agree, otherwise what differs."""
    df = entry.queries()[name](spark, sf)
    ours = _rows(df.columns, df.collect())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return "" if ours else "no rows"
    result = con.execute(sql)
    types = {d[0]: str(d[1]) for d in result.description}
    theirs = _rows(list(types), result.fetchall())
    if sorted(df.columns) != sorted(types):
        return f"columns {sorted(df.columns)} / {sorted(types)}"
    wrong = {c: (t, types[c]) for c, t in df.dtypes if _kind(t) != types[c].split("(")[0]}
    if wrong:
        return f"types {wrong}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} / {len(theirs)}"
    bad = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(bad)} of {len(ours)} rows differ, first: {bad[0]}"[:1500] if bad else ""


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark, con = session(), database(sf)
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, sf, name)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {error}"[:1500]
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")


if __name__ == "__main__":
    main()
