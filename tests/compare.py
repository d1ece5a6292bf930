"""Run registered queries next to their SQL and compare the rows."""

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
import __spark_entry__ as contract  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return db


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(value):
        if isinstance(value, float):
            return "nan" if math.isnan(value) else value
        return value

    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def difference(spark, db, name, sf_dir):
    """None if equal, else a short description."""
    df = contract.queries()[name](spark, sf_dir)
    ours = rows_of(df.columns, df.collect())
    result = db.execute(contract.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    theirs = rows_of(columns, result.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} / {sorted(columns)}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} / {len(theirs)}; e.g. {ours[:2]} / {theirs[:2]}"
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(ours)} rows differ; e.g. {wrong[0]}"
    return None


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    sf_dir, names = sys.argv[1], sys.argv[2:]
    session = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    db = connect(sf_dir)
    for name in names or contract.queries():
        began = time.time()
        try:
            problem = difference(session, db, name, sf_dir)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{'OK  ' if problem is None else 'FAIL'} {name} {time.time() - began:.1f}s",
              "" if problem is None else problem[:1800], flush=True)
