"""Run named queries (default: all) against DuckDB: python -m tests.run_oracle SF_DIR [name ...]"""

import sys
import time
import traceback

from __spark_entry__ import oracle_sql, queries
from pyspark.sql import SparkSession
from tests.oracle import differences

if __name__ == "__main__":
    sf_dir, *names = sys.argv[1:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in names or queries():
        start = time.time()
        try:
            df = queries()[name](spark, sf_dir)
            sql = oracle_sql().get(name)
            problems = differences(df, sql, sf_dir) if sql else [] if df.count() else ["no rows"]
        except Exception:
            problems = [traceback.format_exc()[-1500:]]
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.1f}s", *problems, sep="\n     " if problems else " ")
    print("failed:", bad)
