"""Run the registered queries against their SQL: python tests/compare.py <folder> [names...]"""

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def oracle(sql, folder):
    connection = duckdb.connect()
    for name in ("events", "part", "documents", "embeddings", "conversations"):
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')"
        )
    return connection.execute(sql)


def differences(query, sql, spark, folder):
    """None when both results hold the same rows, else a short description."""
    ours = query(spark, folder)
    expected = oracle(sql, folder)
    names = [c[0] for c in expected.description]
    if sorted(ours.columns) != sorted(names):
        return f"columns {sorted(ours.columns)} != {sorted(names)}"
    order = sorted(names)

    def texts(found):
        return sorted(tuple("NULL" if v is None else str(v) for v in row) for row in found)

    left = texts(tuple(r) for r in ours.select(*(f"`{n}`" for n in order)).collect())
    where = [names.index(n) for n in order]
    right = texts(tuple(r[i] for i in where) for r in expected.fetchall())
    if left == right:
        return None
    missing, extra = set(right) - set(left), set(left) - set(right)
    return (
        f"{len(left)} rows, expected {len(right)}; {order}; "
        f"missing {sorted(missing)[:3]}; extra {sorted(extra)[:3]}"
    )


if __name__ == "__main__":
    import tempfile

    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="compare-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    folder, chosen = sys.argv[1], sys.argv[2:]
    sqls = entry.oracle_sql()
    for name, query in entry.queries().items():
        if chosen and name not in chosen:
            continue
        began = time.time()
        try:
            if name in sqls:
                found = differences(query, sqls[name], spark, folder) or "equal"
            else:
                found = f"{query(spark, folder).count()} rows, no SQL"
        except Exception as error:  # noqa: BLE001
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{name}: {found} ({time.time() - began:.1f}s)", flush=True)
