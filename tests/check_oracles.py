"""Compare all (or the named) queries with their SQL: check_oracles.py FOLDER [NAME...]."""

import sys
import tempfile
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from oracle import connect, difference, spark_rows, sql_rows  # noqa: E402


def main(folder, *names):
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="fieldloom-check-"))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    oracles = entry.oracle_sql()
    failed = 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            found = spark_rows(query(spark, folder))
            middle = time.time()
            sql = oracles.get(name)
            problem = difference(found, sql_rows(connection, sql)) if sql else "no SQL"
        except Exception as error:  # report and go on with the next query
            middle, found, problem = time.time(), ((), ()), str(error)[:600]
        failed += problem not in (None, "no SQL")
        took = f"{middle - start:6.2f}s spark {time.time() - middle:6.2f}s sql"
        print(f"{name:28s} {len(found[1]):7d} rows {took} {problem or 'ok'}", flush=True)
    print("failed:", failed)
    spark.stop()


if __name__ == "__main__":
    main(*sys.argv[1:])
