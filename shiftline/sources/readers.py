"""Readers for the three input tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from shiftline.operators.slots import SLOTS_PER_RECORD

# Column types of the input tables.
PRODUCTION_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("date_begin", T.StringType()),
        T.StructField("time_begin", T.StringType()),
        T.StructField("time_end", T.StringType()),
        *(
            T.StructField(f"{group}_{i}", kind)
            for i in range(1, SLOTS_PER_RECORD + 1)
            for group, kind in (
                ("begin", T.StringType()),
                ("titel", T.StringType()),
                ("moulded", T.LongType()),
                ("poured", T.LongType()),
                ("waste", T.LongType()),
            )
        ),
    ]
)
READINGS_SCHEMA = T.StructType(
    [
        T.StructField("mem_date_time", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("comp_2", T.DecimalType(18, 4)),
        T.StructField("comp_3", T.DecimalType(18, 4)),
        T.StructField("comp_5", T.DecimalType(18, 4)),
        T.StructField("water", T.DecimalType(18, 4)),
    ]
)
COMPONENT_MAP_SCHEMA = T.StructType(
    [T.StructField("Component", T.StringType()), T.StructField("ComponentID", T.LongType())]
)


def read_files(
    spark: SparkSession, path: str, schema: T.StructType, file_format: str = "parquet"
) -> DataFrame:
    """A table of files with a known schema; nothing is inferred."""
    return spark.read.schema(schema).format(file_format).load(path)


def jdbc_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options for a JDBC read in ``partitions`` parallel ranges of a numeric column.

    Rows arrive at the executors in blocks of ``fetch_size``; nothing passes through the driver.
    ``bounds`` only place the ranges: rows outside them are read too.
    """
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if partition_column is not None:
        if bounds is None:
            raise ValueError("a partitioned read needs bounds")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def query_as_table(text: str) -> str:
    """A query text, with or without a final semicolon, as a ``dbtable`` for ``jdbc_options``."""
    return f"({text.strip().removesuffix(';').rstrip()}) AS query_result"


def read_jdbc(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """A database table. The driver class must be on the classpath; secrets belong in options the
    caller adds."""
    return spark.read.format("jdbc").options(**options).load()
