"""The booking job: read, compute, replace the trailing window."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftline.functions.calendar import THREE_SHIFTS, ShiftCalendar
from shiftline.functions.text_time import parse_date
from shiftline.operators.booking import BOOKING_COLUMNS, to_booking
from shiftline.operators.changes import row_changes
from shiftline.operators.fill import last_values
from shiftline.operators.intervals import CHANNELS
from shiftline.operators.lookup import resolve_component
from shiftline.operators.ordered import run_folder, written
from shiftline.operators.slots import REJECTED, window_start
from shiftline.plans.pipeline import Sources, bookings, enriched_slots, fill_setpoints, slot_intervals
from shiftline.sources.sinks import write_bookings
from shiftline.sources.versions import (
    UNDATED,
    commit,
    current,
    drop_staged,
    new_stage,
    read_table,
    read_version,
    staged,
)

# What tells one booking from another; its other columns may change.
BOOKING_KEY = ("date", "shift", "startTime", "endTime", "componentId", "foundryLineId")


def skipped(
    sources: Sources,
    as_of: dt.date | None = None,
    window_days: int = 2,
    strict: bool = False,
    collation: str | None = None,
    one_row_per_record: bool = True,
    calendar: ShiftCalendar = THREE_SHIFTS,
    fix_next_day_fallback: bool = False,
) -> DataFrame:
    """What the window does not book: ``reason``, ``component`` and ``n_slots``.

    ``unmapped`` names a component without an id; the other reasons name the text that could not be
    read. Records whose date cannot be read are counted whatever the window.
    """
    dated = f"{parse_date('date_begin')} >= {window_start(as_of, window_days)}"
    records = sources.production.where(f"coalesce({dated}, true)")
    slots = slot_intervals(records, one_row_per_record, calendar, fix_next_day_fallback)
    # Slots are worked out and counted once, and names are looked up afterwards, one row each.
    booked = f"production_date >= {window_start(as_of, window_days)} AND {REJECTED} IS NULL"
    counted = (
        slots.selectExpr(f"{REJECTED} AS reason", f"CASE WHEN {booked} THEN component END AS component")
        .where("reason IS NOT NULL OR component IS NOT NULL")
        .groupBy("reason", "component")
        .agg(F.count(F.lit(1)).alias("n_slots"))
    )
    counted = written(counted)
    named = resolve_component(
        counted.where("component IS NOT NULL"),
        sources.component_map,
        strict=strict,
        collation=collation,
    )
    unmapped = (
        named.where("component_id IS NULL").groupBy("component").agg(F.sum("n_slots").alias("n_slots"))
    )
    rejected = counted.where("reason IS NOT NULL")
    return unmapped.selectExpr("'unmapped' AS reason", "component", "n_slots").unionAll(rejected)


def rebook(
    sources: Sources,
    path: str,
    as_of: dt.date | None = None,
    window_days: int = 2,
    lookback_days: int = 0,
    line_id: int = 1,
    columns: Sequence[str] = BOOKING_COLUMNS,
    skipped_path: str | None = None,
    **options,
) -> dict[str, int]:
    """Compute the bookings of the trailing window and replace them under ``path``.

    ``lookback_days`` computes that many more days and books none of them: the first dates of the
    window then inherit setpoints, and morning halves of night slots, from before it. With a
    ``skipped_path`` the table of ``skipped`` is replaced there, and its counts are returned as well.
    ``as_of`` defaults to the session's current date. Intermediate tables are deleted at the end.
    """
    spark = sources.production.sparkSession
    as_of = as_of or spark.sql("SELECT current_date()").first()[0]
    days = window_days + lookback_days
    first = as_of - dt.timedelta(days=window_days) if lookback_days else None
    with run_folder(spark):
        rows: DataFrame = bookings(sources, as_of, days, line_id, columns, first=first, **options)
        result = write_bookings(rows, path, as_of, window_days)
        if skipped_path is not None:
            known = {k: v for k, v in options.items() if k not in ("fill_strategy", "stretches")}
            missed = skipped(sources, as_of, window_days, **known)
            missed.write.mode("overwrite").parquet(skipped_path)
            found = spark.read.schema(missed.schema).parquet(skipped_path)
            counts = found.selectExpr(
                "count_if(reason = 'unmapped') AS unmapped_names",
                "coalesce(sum(n_slots) FILTER (WHERE reason <> 'unmapped'), 0) AS rejected_slots",
            )
            result |= counts.first().asDict()
    return result


def setpoint_schema(line: str | None = None) -> str:
    """The table of setpoints that a version keeps: the last ones of each date, and line."""
    lines = f"`{line}` BIGINT, " if line else ""
    return f"production_date DATE, {lines}" + ", ".join(f"`{c}` DOUBLE" for c in CHANNELS)


def rebook_versions(
    sources: Sources,
    path: str,
    as_of: dt.date | None = None,
    window_days: int = 2,
    line_id: int = 1,
    columns: Sequence[str] = BOOKING_COLUMNS,
    line: str | None = None,
    fill_strategy: str = "stretches",
    **options,
) -> dict[str, int]:
    """Compute the bookings of the trailing window and commit what changed as a version of ``path``.

    Readers (``versions.read_version``) see the old window until the new one is complete. Dates whose
    bookings are the same as before are not written again; a cycle in which nothing changed commits
    nothing. The version keeps two tables: ``changes``, the rows that it inserted, updated and
    deleted, and ``setpoints``, the last setpoints of each date (and line). The first dates of a
    window inherit from these, so no lookback is needed.

    Returns the live version, the rows written and the number of changes of each kind.
    """
    spark = sources.production.sparkSession
    as_of = as_of or spark.sql("SELECT current_date()").first()[0]
    first = as_of - dt.timedelta(days=window_days)
    base = current(spark, path)
    by = [line] if line else []
    known = read_table(spark, path, "setpoints", setpoint_schema(line), base)
    earlier = known.where(F.col("production_date") < F.lit(first))
    seed = last_values(earlier, CHANNELS, ["production_date"], by)
    with run_folder(spark):
        # A slot of the night before may be cut into the window's first date.
        enriched = enriched_slots(sources, as_of, window_days + 1, line=line, **options)
        enriched = enriched.where(F.col("production_date") >= F.lit(first))
        filled, lasts = fill_setpoints(
            enriched.withColumns({c: F.col(c).cast("double") for c in CHANNELS}),
            by,
            fill_strategy,
            seed,
        )
        rows = to_booking(filled, line_id, columns, line=line)
        before = read_version(spark, path, rows.schema, first, version=base)
        if not any(d >= first.isoformat() for d in base.folders if d != UNDATED):
            before = None
        key = [c for c in BOOKING_KEY if c in columns]
        stage = new_stage(base)
        changes = staged(row_changes(before, rows, key), path, stage, "changes")
        counts = {r["change"]: r["count"] for r in changes.groupBy("change").count().collect()}
        found = {kind: counts.get(kind, 0) for kind in ("insert", "update", "delete")}
        if not counts:
            drop_staged(spark, path, stage, "changes")
            return {"version": base.number, "rows": 0, **found}
        dates = [r["date"] for r in changes.select("date").distinct().collect()]  # of the window
        tables = {"changes": None, "setpoints": earlier.unionByName(lasts)}
        touched = rows.where(F.col("date").isin(dates))
        version, n = commit(touched, path, "CAST(date AS DATE)", dates, tables, base, stage=stage)
    return {"version": version.number, "rows": n, **found}
