"""From wide records to bookings."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftline.functions import quoted
from shiftline.functions.calendar import THREE_SHIFTS, ShiftCalendar
from shiftline.functions.text_time import parse_date
from shiftline.operators.booking import BOOKING_COLUMNS, REPORT_ORDER, to_booking
from shiftline.operators.fill import fill_by_stretch, forward_fill, last_values
from shiftline.operators.intervals import (
    CHANNELS,
    REPORT_KEYS,
    STRETCHES,
    TotalsOfIntervals,
    enrich_intervals,
    normalise_readings,
)
from shiftline.operators.lookup import resolve_component
from shiftline.operators.ordered import written
from shiftline.operators.slots import (
    BEGIN_HOUR,
    assign_shift,
    display_columns,
    parse_records,
    production_date,
    resolve_end,
    resolve_start,
    trailing_window,
    unpivot_slots,
    unpivot_with_later_slot,
    window_start,
    with_begin_hour,
    with_later_slot,
)
from shiftline.operators.split import split_at_boundary


@dataclass(frozen=True)
class Sources:
    """The three input tables, as DataFrames. Kept totals may stand in for the readings."""

    production: DataFrame
    readings: DataFrame | TotalsOfIntervals
    component_map: DataFrame


def slot_intervals(
    production: DataFrame,
    one_row_per_record: bool = True,
    calendar: ShiftCalendar = THREE_SHIFTS,
    fix_next_day_fallback: bool = False,
) -> DataFrame:
    """One row per used slot with its start, end, shift and production date.

    When several rows may share an ``id`` and count as one record, pass
    ``one_row_per_record=False``.
    """
    records = parse_records(production, calendar)
    if one_row_per_record:
        slots = unpivot_with_later_slot(records, calendar=calendar)
    else:
        slots = with_later_slot(resolve_start(unpivot_slots(records), calendar), ("id",))
    slots = with_begin_hour(slots)
    for step in (production_date, assign_shift):
        slots = slots.transform(step, calendar=calendar)
    ended = resolve_end(slots, calendar, fix_next_day_fallback)
    return display_columns(ended.drop(BEGIN_HOUR))


def recent_records(
    production: DataFrame, as_of: dt.date | None, days: int
) -> DataFrame:
    """Records that can hold slots of the trailing window.

    A production date is the record's date or the day before, and slots only depend on their own
    record, so whole records can go before any other work.
    """
    return production.where(f"{parse_date('date_begin')} >= {window_start(as_of, days)}")


def enriched_slots(
    sources: Sources,
    as_of: dt.date | None = None,
    window_days: int = 2,
    strict: bool = False,
    collation: str | None = None,
    one_row_per_record: bool = True,
    calendar: ShiftCalendar = THREE_SHIFTS,
    stretches: Sequence[str] = STRETCHES,
    fix_next_day_fallback: bool = False,
    line: str | None = None,
) -> DataFrame:
    """Split slots of the trailing window with readings and component ids.

    ``line`` names a column of records and readings; slots then meet readings of their line only.
    """
    by = [line] if line else []
    records = recent_records(sources.production, as_of, window_days)
    slots = slot_intervals(records, one_row_per_record, calendar, fix_next_day_fallback)
    recent = trailing_window(slots, "production_date", as_of, window_days)
    split = split_at_boundary(recent, calendar=calendar)
    split = written(split.select(*dict.fromkeys([*by, *REPORT_KEYS, "start_dt", "end_dt"])))
    # What is booked in the window starts at or after its first midnight. Totals are differences, so
    # readings from before it change nothing.
    readings = sources.readings
    if isinstance(readings, DataFrame):
        readings = normalise_readings(readings, by, collation).where(
            f"mem_dt >= CAST({window_start(as_of, window_days)} AS TIMESTAMP_NTZ)"
        )
    enriched = enrich_intervals(
        split, readings, by=by, collation=collation, stretches=stretches
    )
    return resolve_component(
        enriched, sources.component_map, strict=strict, collation=collation, names=split
    )


# Stretches of the report order, for its fill. A window holds what one date has in one minute.
FILL_STRETCHES = ("production_date", "shift_order", "left(sort_begin, 5)")


def fill_setpoints(
    enriched: DataFrame,
    partition_by: Sequence[str] = (),
    strategy: str = "stretches",
    seed: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Rows with a component id, channels filled forward in report order, from ``seed`` on, and the
    last setpoints of each production date.

    ``strategy="stretches"`` goes by date and minute; those of ``forward_fill`` serve as well, such as
    ``two_phase`` for rows of which a single minute of one date has the most.
    """
    bookable = enriched.where("component_id IS NOT NULL")
    if strategy == "stretches":
        filled, lasts = fill_by_stretch(
            bookable, CHANNELS, REPORT_ORDER, FILL_STRETCHES, partition_by, seed
        )
        return filled, lasts.withColumnRenamed("_stretch_0", "production_date")
    filled = forward_fill(bookable, CHANNELS, REPORT_ORDER, partition_by, strategy, seed)
    return filled, last_values(filled, CHANNELS, REPORT_ORDER, ["production_date", *partition_by])


def setpoints_before(
    enriched: DataFrame,
    first: dt.date,
    partition_by: Sequence[str] = (),
    seed: DataFrame | None = None,
) -> DataFrame:
    """What the rows before the date ``first`` hand on to it: per channel the last value of those with
    a component id, or that of ``seed``.
    """
    by = quoted(partition_by)
    earlier = enriched.where("component_id IS NOT NULL").where(F.col("production_date") < F.lit(first))
    # All of these rows are asked for the last dates with a value. Their order counts on those alone.
    dates = earlier.groupBy(*by).agg(
        *(F.expr(f"max(production_date) FILTER (WHERE `{c}` IS NOT NULL) AS `{c}`") for c in CHANNELS)
    )
    wanted = {r[c] for r in dates.select(*CHANNELS).distinct().collect() for c in CHANNELS} - {None}
    lasts = last_values(
        earlier.where(F.col("production_date").isin(sorted(wanted))), CHANNELS, REPORT_ORDER, partition_by
    ).withColumn("_later", F.lit(1))
    if seed is not None:
        seed = seed.select(*by, *CHANNELS).withColumn("_later", F.lit(0))
        lasts = last_values(lasts.unionByName(seed), CHANNELS, ["_later"], partition_by)
    return written(lasts.select(*by, *CHANNELS))


def bookings(
    sources: Sources,
    as_of: dt.date | None = None,
    window_days: int = 2,
    line_id: int = 1,
    columns: Sequence[str] = BOOKING_COLUMNS,
    keep: Sequence[str] = (),
    line: str | None = None,
    **options,
) -> DataFrame:
    """Booking rows of the trailing window. ``options`` go to ``filled_slots``.

    With ``line``, a column of records and readings, all lines are booked in one run: setpoints do not
    pass from one line to another, and each row is booked under its own line.
    """
    filled = filled_slots(sources, as_of, window_days, line=line, **options)
    return to_booking(filled, line_id, columns, keep, line)


def filled_slots(
    sources: Sources,
    as_of: dt.date | None = None,
    window_days: int = 2,
    fill_strategy: str = "stretches",
    line: str | None = None,
    seed: DataFrame | None = None,
    first: dt.date | None = None,
    **options,
) -> DataFrame:
    """Slots of the trailing window as they are booked, setpoints filled forward from ``seed`` on.
    ``options`` go to ``enriched_slots``.

    With ``first``, a date, slots before it are not in the result; they only hand their setpoints on.
    """
    by = [line] if line else []
    enriched = enriched_slots(sources, as_of, window_days, line=line, **options)
    if first is not None:
        seed = setpoints_before(enriched, first, by, seed)
        enriched = enriched.where(F.col("production_date") >= F.lit(first))
    return fill_setpoints(enriched, by, fill_strategy, seed)[0]
