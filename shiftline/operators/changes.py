"""What changed between two states of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def row_changes(before: DataFrame | None, after: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows to insert, update and delete: ``change``, the columns of ``after``, and how many copies
    go (``n_removed``) and come (``n_added``).

    Rows equal in all columns cancel out copy by copy; NULLs are equal. Of what is left, the rows
    that went and that came under one ``key`` are paired in the order of their columns: a pair is an
    ``update`` and shows the new row; the rest is an ``insert`` or a ``delete``, which shows the old
    row. Copies are counted before they are shuffled, and only rows that differ are sorted. Without
    ``before`` there is nothing to pair: all rows are inserts.
    """
    columns = after.columns
    if before is None:
        came = after.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_added"))
        return came.select(
            F.lit("insert").alias("change"), *columns, F.lit(0).cast("bigint").alias("n_removed"), "n_added"
        )
    states = before.select(*columns, F.lit(1).alias("_old"), F.lit(0).alias("_new")).unionAll(
        after.select(*columns, F.lit(0), F.lit(1))
    )
    differing = (
        states.groupBy(*columns)
        .agg(F.sum("_old").alias("_old"), F.sum("_new").alias("_new"))
        .where("_old <> _new")
        .withColumn("_came", F.col("_new") > F.col("_old"))
        .withColumn("_copies", F.abs(F.col("_new") - F.col("_old")))
    )
    others = [c for c in columns if c not in key]
    place = Window.partitionBy(*key, "_came").orderBy(*(others or key))
    row = F.struct(*columns, "_copies")
    paired = (
        # Dealt by key once, for the numbering and for the pairs.
        differing.repartition(*(F.col(f"`{c}`") for c in key))
        .withColumn("_place", F.row_number().over(place))
        .groupBy(*key, "_place")
        .agg(
            F.max(F.when(~F.col("_came"), row)).alias("_went"),
            F.max(F.when(F.col("_came"), row)).alias("_here"),
        )
    )
    change = (
        F.when(F.col("_went").isNull(), "insert")
        .when(F.col("_here").isNull(), "delete")
        .otherwise("update")
    )
    shown = F.coalesce("_here", "_went")
    return paired.select(
        change.alias("change"),
        *(shown[c].alias(c) for c in columns),
        F.coalesce(F.col("_went")["_copies"], F.lit(0)).alias("n_removed"),
        F.coalesce(F.col("_here")["_copies"], F.lit(0)).alias("n_added"),
    )
