"""Where bookings go."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from shiftline.operators.booking import payload_json


def write_bookings(
    bookings: DataFrame, path: str, as_of: dt.date, window_days: int = 2
) -> dict[str, int]:
    """Replace the bookings of the trailing window under ``path``, one folder per date.

    Running it again for the same ``as_of`` gives the same files' content. Dates before the window
    are left alone, so bookings computed with some days of lookback only replace dates that were
    computed from whole records. The window has no upper end: a date from its first day on that no
    longer has bookings loses its folder, also one after ``as_of``.

    Returns the number of rows written and of dates emptied. When no booking is left at all, read the
    folder with a schema.
    """
    first = as_of - dt.timedelta(days=window_days)
    written = Observation("bookings")
    (
        bookings.where(F.col("date") >= first.isoformat())
        .observe(
            written, F.count(F.lit(1)).alias("rows"), F.collect_set("date").alias("dates")
        )
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date")
        .parquet(path)
    )
    metrics = written.get
    emptied = _empty_dates(bookings, path, first, metrics["dates"])
    return {"rows": metrics["rows"], "emptied": emptied}


def _empty_dates(bookings: DataFrame, path: str, first: dt.date, booked: list[str]) -> int:
    """Delete the folders of dates from ``first`` on that were not ``booked``. Returns how many."""
    spark = bookings.sparkSession
    before = spark.read.schema(bookings.schema).parquet(path).select("date")
    in_window = F.col("date") >= first.isoformat()
    stale = before.where(in_window & ~F.col("date").isin(booked)).distinct().collect()
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for row in stale:
        files.delete(folder.suffix(f"/date={row.date}"), True)
    return len(stale)


def write_payload(bookings: DataFrame, path: str) -> None:
    """JSON lines, one booking per line, NULL written as ``""``."""
    payload_json(bookings).select("payload").write.mode("overwrite").text(path)
