"""Booking again only the dates that late records and readings reach.

A record dated d has slots that are booked on the day before, on d, or, cut at the morning's shift
change, on the day after. A reading is counted in pieces of its own date and of the night before.
Setpoints reach further: what a date hands on fills the next booked one, so that one follows when
the last setpoints of a date have changed, until they no longer do.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftline.operators.booking import BOOKING_COLUMNS, to_booking
from shiftline.operators.changes import row_changes
from shiftline.operators.fill import last_values
from shiftline.operators.intervals import CHANNELS
from shiftline.operators.ordered import run_folder, written
from shiftline.plans.job import BOOKING_KEY, setpoint_schema
from shiftline.plans.pipeline import Sources, enriched_slots, fill_setpoints
from shiftline.sources.versions import UNDATED, Version, commit, current, read_table, read_version

Load = Callable[[set[str], set[str]], Sources]


def _shifted(dates: Iterable[str], days: Iterable[int]) -> set[str]:
    return {
        (dt.date.fromisoformat(d) + dt.timedelta(days=k)).isoformat()
        for d in dates
        if d != UNDATED
        for k in days
    }


def dirty_dates(record_dates: Iterable[str], reading_dates: Iterable[str]) -> set[str]:
    """The dates whose bookings may change when records and readings filed under these dates have."""
    return _shifted(record_dates, (-1, 0, 1)) | _shifted(reading_dates, (-1, 0))


def _booked_on(
    spark: SparkSession,
    load: Load,
    dates: set[str],
    others: set[str],
    known: DataFrame,
    line: str | None,
    options: dict,
) -> tuple[DataFrame, DataFrame]:
    """Filled slots of ``dates`` and the last setpoints of each. ``known`` has the last setpoints of the ``others``; dates that
    follow each other among all of them are filled as one.
    """
    by = [line] if line else []
    sources = load(_shifted(dates, (-1, 0, 1)), _shifted(dates, (0, 1)))
    enriched = enriched_slots(sources, dt.date.fromisoformat(min(dates)), 1, line=line, **options)
    runs, previous = [], None
    for date in sorted(dates | others):
        if date in dates:
            first = date if previous not in dates else runs[-1][1]
            runs.append((date, first))
        previous = date
    numbered = spark.createDataFrame(
        [(dt.date.fromisoformat(d), f) for d, f in runs], "production_date date, _run string"
    )
    seeds = None
    for first in sorted({f for _, f in runs}):
        earlier = known.where(F.col("production_date") < F.lit(first).cast("date"))
        seed = last_values(earlier, CHANNELS, ["production_date"], by).withColumn("_run", F.lit(first))
        seeds = seed if seeds is None else seeds.unionByName(seed)
    rows = enriched.join(F.broadcast(numbered), "production_date").withColumns(
        {c: F.col(c).cast("double") for c in CHANNELS}
    )
    filled, lasts = fill_setpoints(rows, ["_run", *by], seed=seeds)
    return filled.drop("_run"), lasts.drop("_run")


def _without(known: DataFrame, dates: set[str]) -> DataFrame:
    return known.where(~F.col("production_date").cast("string").isin(sorted(dates)))


def _changed(known: DataFrame, lasts: DataFrame, dates: set[str], by: Sequence[str]) -> set[str]:
    """The ``dates`` after which other setpoints go on than ``known`` says."""
    own = known.where(F.col("production_date").cast("string").isin(sorted(dates)))
    key = ["production_date", *by]
    differing = row_changes(own.select(*lasts.columns), lasts, key).select("production_date").distinct()
    return {row["production_date"].isoformat() for row in differing.collect()}


def rebook_dates(
    load: Load,
    path: str,
    dates: Iterable[str],
    line_id: int = 1,
    columns: Sequence[str] = BOOKING_COLUMNS,
    line: str | None = None,
    **options,
) -> dict[str, int]:
    """Book ``dates`` (``YYYY-MM-DD``) again, and those that their setpoints reach, as one version.

    ``load(record_dates, reading_dates)`` gives the sources of some dates; no others are read. ``path``
    is a table of ``rebook_versions``. The result is what booking everything again would give. Each
    step books the dates that the one before has reached; a chain of dates without readings of their
    own takes a step each. Returns the live version, the rows written, the changes of each kind and
    how many dates were computed.
    """
    spark = SparkSession.active()
    base: Version = current(spark, path)
    by = [line] if line else []
    waiting = set(dates) - {UNDATED}
    booked = {d for d in base.folders if d != UNDATED}
    counts = dict.fromkeys(("insert", "update", "delete"), 0)
    nothing = {"version": base.number, "rows": 0, **counts, "booked": 0}
    if not waiting:
        return nothing
    with run_folder(spark):
        known = read_table(spark, path, "setpoints", setpoint_schema(line), base)
        # Dates in booking order: those that had rows, and those that may get some.
        every, done = sorted(booked | waiting), {}
        while waiting:
            others = set(every) - waiting
            filled, lasts = _booked_on(spark, load, waiting, others, known, line, options)
            reached = _changed(known, lasts, waiting, by)
            known = written(_without(known, waiting).unionByName(lasts))
            done |= dict.fromkeys(waiting, filled)
            following = {every[i + 1] for i, d in enumerate(every[:-1]) if d in reached}
            waiting = following - waiting
        parts = {}
        for date, filled in done.items():
            parts.setdefault(id(filled), (filled, set()))[1].add(date)
        rows = None
        for filled, own in parts.values():
            part = filled.where(F.col("production_date").cast("string").isin(sorted(own)))
            rows = part if rows is None else rows.unionByName(part)
        rows = to_booking(rows, line_id, columns, line=line)
        before = read_version(spark, path, rows.schema, dates=done, version=base)
        changes = written(row_changes(before, rows, [c for c in BOOKING_KEY if c in columns]))
        counts |= {r["change"]: r["count"] for r in changes.groupBy("change").count().collect()}
        if not any(counts.values()):
            return nothing | {"booked": len(done)}
        touched = [r["date"] for r in changes.select("date").distinct().collect()]
        tables = {"changes": changes, "setpoints": known}
        rows = rows.where(F.col("date").isin(touched))
        version, n = commit(rows, path, "CAST(date AS DATE)", touched, tables, base)
    return {"version": version.number, "rows": n, **counts, "booked": len(done)}
