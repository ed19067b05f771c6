"""Run registered queries and their SQL counterparts and compare the rows.

    python tests/compare.py [data folder] [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def database(sf_dir: str):
    import duckdb

    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def differences(spark, db, sf_dir: str, name: str, build, sql: str | None) -> tuple[int, list[str]]:
    """Rows of the query, and what differs from the SQL."""
    frame = build(spark, sf_dir)
    columns = sorted(frame.columns)
    ours = Counter(tuple(r) for r in frame.select(*columns).collect())
    total = sum(ours.values())
    if sql is None:
        return total, []
    result = db.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != columns:
        return total, [f"columns {columns} against {sorted(names)}"]
    order = [names.index(c) for c in columns]
    theirs = Counter(tuple(r[i] for i in order) for r in result.fetchall())
    problems = [f"only ours {r}" for r in list((ours - theirs))[:2]]
    problems += [f"only SQL  {r}" for r in list((theirs - ours))[:2]]
    described = db.execute(f"DESCRIBE {sql}").fetchall()
    kinds = {d[0]: d[1] for d in described}
    same = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE",
            "date": "DATE", "timestamp_ntz": "TIMESTAMP"}
    for field in frame.schema:
        kind = field.dataType.simpleString()
        if same.get(kind, kind.upper()) != kinds[field.name]:
            problems.append(f"type of {field.name}: {kind} against {kinds[field.name]}")
    return total, problems


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    db, failed = database(sf_dir), []
    oracle = entry.oracle_sql()
    for name, build in entry.queries().items():
        if args and name not in args:
            continue
        start = time.time()
        try:
            rows, problems = differences(spark, db, sf_dir, name, build, oracle.get(name))
        except Exception as error:
            rows, problems = -1, [f"{type(error).__name__}: {str(error)[:600]}"]
        print(f"{'OK  ' if not problems else 'FAIL'} {name:32s} {rows:8d} rows {time.time() - start:6.2f} s", flush=True)
        for p in problems:
            print("       ", p, flush=True)
        if problems:
            failed.append(name)
    print("failed:", failed)
    return len(failed)


if __name__ == "__main__":
    sys.exit(main())
