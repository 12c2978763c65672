"""Ranks of rows in a global order, spread over many tasks."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftline.llm.workspace import Workspace

_ROW_BITS = 33  # monotonically_increasing_id keeps the partition number above


def small_table(spark: SparkSession, rows: list[tuple[int, ...]], schema: str) -> DataFrame:
    """``rows`` of whole numbers that the driver holds, handed over as one Arrow table.

    From a list of tuples Spark makes an RDD, whose rows start Python workers of another kind on the
    executors; they would stay there beside those of the operators.
    """
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema.split(","))
    names = [field.split()[0] for field in schema.split(",")]
    table = pa.table([pa.array(c, pa.int64()) for c in columns], names=names)
    return spark.createDataFrame(table).selectExpr(
        *(f"CAST({' AS '.join(field.split())}) AS {field.split()[0]}" for field in schema.split(","))
    )


def ranked(df: DataFrame, order: list[str], work: Workspace, table: str) -> DataFrame:
    """``df`` with ``rank``, from 0 along ``order``.

    Rows are range-partitioned, sorted and written; a row's rank is its place in its range plus the
    rows of the ranges before, of which there is one number per range. ``order`` should tell rows
    apart, so that ranges are balanced.
    """
    ordered = work.write(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_position", F.monotonically_increasing_id()),
        table,
    ).withColumn("_range", F.shiftright("_position", _ROW_BITS))
    counts = ordered.groupBy("_range").agg(F.count("*").alias("n"), F.min("_position").alias("p"))
    bases, total = [], 0
    for row in sorted(counts.collect()):
        bases.append((row["_range"], total - row["p"]))
        total += row["n"]
    bases = small_table(df.sparkSession, bases or [(-1, 0)], "_range long, _base long")
    return (
        ordered.join(F.broadcast(bases), "_range")
        .withColumn("rank", F.col("_position") + F.col("_base"))
        .drop("_range", "_position", "_base")
    )
