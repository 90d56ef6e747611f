"""Runs a registered query and its SQL twin, and compares rows without regard to their order."""

import math
import sys
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        if Path(f"{sf_dir}/{t}.parquet").exists():
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def plain(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else round(x, 9) + 0.0
    if isinstance(x, dict):
        return tuple(plain(v) for v in x.values())
    if hasattr(x, "asDict"):
        return tuple(plain(v) for v in x)
    if isinstance(x, (list, tuple)):
        return tuple(map(plain, x))
    return x


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted((tuple(plain(r[k]) for k in order) for r in rows), key=repr)


def compare(df, sql, sf_dir):
    """An empty string if both agree, else what differs."""
    result = connect(sf_dir).execute(sql)
    names = [d[0] for d in result.description]
    theirs = rows_of(names, result.fetchall())
    ours = rows_of(df.columns, df.collect())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} and {len(theirs)} rows; first {ours[:1]} and {theirs[:1]}"
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(wrong)} of {len(ours)} rows differ: {wrong[:2]}" if wrong else ""


def main(names):
    import time

    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "8g").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    sf = next((n for n in names if n.startswith("/")), "/root/testdata/sf0.01")
    wanted = [n for n in names if not n.startswith("/")] or list(e.queries())
    for name in wanted:
        began = time.time()
        try:
            df = e.queries()[name](spark, sf)
            sql = e.oracle_sql().get(name)
            said = (compare(df, sql, sf) or f"agrees, {df.count()} rows") if sql else f"no SQL, {df.count()} rows: {df.first()}"[:300]
        except Exception as x:  # noqa: BLE001
            said = f"FAILED {type(x).__name__}: {str(x)[:900]}"
        print(f"{name}: {said} ({time.time() - began:.1f} s)", flush=True)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
