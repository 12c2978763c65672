"""Tables laid out by date, so that a window reads its own dates only.

Records are filed under their own date and readings under theirs. ``file_rows`` merges late and
corrected rows into a versioned table; ``write_by_date`` lays a whole table out, in a partition
column that is not part of it, and a window does not read rows without a date.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shiftline.functions.text_time import parse_date, parse_datetime_text
from shiftline.operators.ordered import is_stored, run_folder, written
from shiftline.operators.skew import fits_broadcast
from shiftline.plans.pipeline import Sources
from shiftline.sources.versions import UNDATED, commit, current, read_version

FILED_UNDER = "filed_under"
RECORD_DATE = parse_date("date_begin")
READING_DATE = f"to_date({parse_datetime_text('mem_date_time')})"


def write_by_date(df: DataFrame, path: str, date: str) -> None:
    """Write ``df`` by ``date`` (SQL text); the dates it holds replace what was filed under them."""
    (
        df.selectExpr("*", f"{date} AS {FILED_UNDER}")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(FILED_UNDER)
        .parquet(path)
    )


def read_by_date(spark: SparkSession, path: str, first: dt.date | None = None) -> DataFrame:
    """The rows filed under ``first`` and later dates; all rows without ``first``."""
    rows = spark.read.parquet(path)
    if first is not None:
        rows = rows.where(f"{FILED_UNDER} >= DATE'{first.isoformat()}'")
    return rows.drop(FILED_UNDER)


def file_rows(
    df: DataFrame, path: str, date: str, key: str, newest: str | None = None
) -> dict[str, int | list[str]]:
    """File late and corrected rows of ``df`` by ``date`` (SQL text) beside what is there.

    A row replaces the one with its ``key``, also where that is filed under another date; of several
    rows with one key the one with the largest ``newest`` (SQL text) counts, then the largest row.
    Rows without a ``key`` are added. Only the dates that lose or get rows are written again, as one
    version: readers see all of it or nothing. Rows whose date cannot be read are filed apart.
    Returns the version, the dates written and the number of their rows.
    """
    spark = df.sparkSession
    base = current(spark, path)
    with run_folder(spark):
        late = _newest(df if is_stored(df) else written(df), key, newest)
        ids = late.where(F.col(key).isNotNull()).select(key)
        # Of what is there, the keys and the dates alone are read here.
        known = read_version(spark, path, df.schema, version=base)
        moved = written(known.join(ids, key, "left_semi").selectExpr(f"`{key}`", f"{_filed(date)} AS d"))
        filed = moved.select("d").unionAll(late.selectExpr(f"{_filed(date)} AS d"))
        dates = {r.d for r in filed.distinct().collect()}
        if not dates:
            return {"version": base.number, "dates": [], "rows": 0}
        there = read_version(spark, path, df.schema, dates=dates, version=base)
        # Whole rows are not sorted by their keys: they may be wide. A shuffle is left for many keys.
        gone = moved.select(key)
        gone = F.broadcast(gone) if fits_broadcast(gone) else gone.hint("shuffle_hash")
        rows = there.join(gone, key, "left_anti").select(*df.columns).unionAll(late)
        version, n = commit(rows, path, date, dates, base=base)
    return {"version": version.number, "dates": sorted(dates), "rows": n}


def _newest(rows: DataFrame, key: str, newest: str | None) -> DataFrame:
    """Of the written or stored ``rows`` with one ``key`` the one that counts, and all those without a key.

    Keys alone are counted first. Rows that are the only ones of their key stay where they are.
    """
    named = rows.where(F.col(key).isNotNull())
    repeated = written(named.groupBy(key).count().where("count > 1").select(key))
    if repeated.isEmpty():
        return rows
    row = F.struct(*rows.columns)
    order = F.struct(F.expr(newest), row) if newest else row
    chosen = rows.join(repeated, key, "left_semi").groupBy(key).agg(F.max_by(row, order).alias("_row"))
    once = rows.join(repeated, key, "left_anti").select(*rows.columns)
    return written(once.unionAll(chosen.select("_row.*")))


def _filed(date: str) -> str:
    return f"coalesce(date_format({date}, 'yyyy-MM-dd'), '{UNDATED}')"


def filed_sources(
    spark: SparkSession,
    production: str,
    readings: str,
    schemas: tuple[StructType, StructType],
    component_map: DataFrame,
    as_of: dt.date,
    window_days: int = 2,
    lookback_days: int = 1,
) -> Sources:
    """The sources of one window run, from tables that ``file_rows`` filed.

    Records come with those whose date cannot be read, which a report of what was skipped counts.
    ``lookback_days`` of records before the window are what ``rebook_versions`` cuts into it.
    """
    first = as_of - dt.timedelta(days=window_days + lookback_days)
    return Sources(
        read_version(spark, production, schemas[0], first, undated=True),
        read_version(spark, readings, schemas[1], first),
        component_map,
    )


def filed_dates(
    spark: SparkSession,
    production: str,
    readings: str,
    schemas: tuple[StructType, StructType],
    component_map: DataFrame,
) -> Callable[[set[str], set[str]], Sources]:
    """Loads the records and the readings of some dates from tables that ``file_rows`` filed."""

    def load(record_dates: set[str], reading_dates: set[str]) -> Sources:
        return Sources(
            read_version(spark, production, schemas[0], dates=record_dates),
            read_version(spark, readings, schemas[1], dates=reading_dates),
            component_map,
        )

    return load


def curated_sources(
    spark: SparkSession,
    production: str,
    readings: str,
    component_map: DataFrame,
    as_of: dt.date,
    window_days: int = 2,
) -> Sources:
    """The sources of one window run, read from tables that ``write_by_date`` laid out."""
    first = as_of - dt.timedelta(days=window_days)
    return Sources(
        read_by_date(spark, production, first), read_by_date(spark, readings, first), component_map
    )
