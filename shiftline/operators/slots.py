"""From wide records to time intervals.

A wide record carries up to 26 slots side by side. The operators here turn slots into rows and work
out when each slot started, which shift and production date it belongs to, and when it ended.

A slot ends where the next-later slot of its record starts. There are two ways to find that slot:

* ``unpivot_with_later_slot`` sorts the slots inside their own row, before they become rows. A
  record is bounded by its columns, so no shuffle is needed, and no key can be hot.
* ``with_later_slot`` serves slots that already are rows, with a window per record. Its
  ``two_phase`` strategy spreads one record over many tasks.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame

from shiftline.functions import listed, quoted, with_exprs
from shiftline.functions.calendar import THREE_SHIFTS, ShiftCalendar
from shiftline.functions.text_time import hour_of, instant, parse_date
from shiftline.operators.ordered import FIRST_OF_RANGE, edge_before, pinned_ranges, same_key

# Number of repeated groups in a record, its plain columns, and for each repeated
# column (`begin_1` .. `begin_26` and so on) the name it gets as a slot column.
SLOTS_PER_RECORD = 26
RECORD_COLUMNS = ("id", "date_begin", "time_begin", "time_end")
SLOT_GROUPS = {
    "begin": "begin",
    "titel": "component",
    "moulded": "moulded",
    "poured": "poured",
    "waste": "waste",
}


def parse_records(records: DataFrame, calendar: ShiftCalendar = THREE_SHIFTS) -> DataFrame:
    """Add what the texts of a record say, once per record: ``record_date``, ``is_evening`` and
    ``record_end_dt`` (NULL when ``time_end`` is missing or unreadable).

    Runs on wide records and on slots that already are rows. The ``resolve`` operators need it.
    """
    date, evening = parse_date("date_begin"), calendar.is_evening("time_begin")
    end_seconds = calendar.seconds_from_record_date(evening, "time_end")
    return with_exprs(
        records,
        {"record_date": date, "is_evening": evening, "record_end_dt": instant(date, end_seconds)},
    )


def _slot_structs(
    records: DataFrame,
    groups: Mapping[str, str],
    n: int,
    trimmed: str,
    used_when: str,
    leading: Callable[[int], str],
) -> tuple[list[str], str]:
    """Names of the columns outside the repeated groups, and an array with a struct per slot.

    Unused slots are NULL. ``leading`` gives the first fields of a slot's struct. Each slot has its
    own expression rather than a shared lambda, because those are compiled and lambdas are not.
    """

    def field(group: str, name: str, number: int) -> str:
        column = f"`{group}_{number}`"
        return f"'{name}', " + (f"trim({column})" if name == trimmed else column)

    def slot(number: int) -> str:
        fields = ", ".join(field(group, name, number) for group, name in groups.items())
        struct = f"named_struct({leading(number)}, 'slot_no', {number}, {fields})"
        return f"CASE WHEN coalesce(`{used_when}_{number}`, 0) > 0 THEN {struct} END"

    numbers = range(1, n + 1)
    grouped = {f"{group}_{number}" for group in groups for number in numbers}
    slots = f"array({', '.join(slot(number) for number in numbers)})"
    return [c for c in records.columns if c not in grouped], slots


def unpivot_slots(
    records: DataFrame,
    keep: Sequence[str] | None = None,
    groups: Mapping[str, str] = SLOT_GROUPS,
    n: int = SLOTS_PER_RECORD,
    trimmed: str = "component",
    used_when: str = "moulded",
) -> DataFrame:
    """One row per slot whose ``used_when`` quantity is above zero, in one scan of the records.

    ``keep`` defaults to all columns outside the repeated groups.
    """
    ungrouped, slots = _slot_structs(
        records, groups, n, trimmed, used_when, lambda number: "'used', true"
    )
    kept, names = quoted(keep or ungrouped), quoted(["slot_no", *groups.values()])
    # Slots are built in a projection of their own: inside a generator over so many columns Spark
    # would interpret them.
    return (
        records.selectExpr(*kept, f"{slots} AS _slots")
        .selectExpr(*kept, f"inline(_slots) AS (_used, {', '.join(names)})")
        .where("_used")
        .drop("_used")
    )


def unpivot_with_later_slot(
    records: DataFrame,
    keep: Sequence[str] | None = None,
    groups: Mapping[str, str] = SLOT_GROUPS,
    n: int = SLOTS_PER_RECORD,
    trimmed: str = "component",
    used_when: str = "moulded",
    calendar: ShiftCalendar = THREE_SHIFTS,
) -> DataFrame:
    """``unpivot_slots`` plus ``start_dt``, ``later_begin`` and ``later_start`` of every slot.

    Takes parsed records. Same result as ``resolve_start`` and ``with_later_slot`` by record,
    provided a record is one row, and without a shuffle. Slots with equal starts are ordered by
    slot number.
    """

    def sort_fields(number: int) -> str:
        seconds = calendar.seconds_from_record_date("is_evening", f"`begin_{number}`")
        return f"'at', {seconds}, 'rank', {-number}"

    ungrouped, slots = _slot_structs(records, groups, n, trimmed, used_when, sort_fields)
    kept, names = quoted(keep or ungrouped), ["slot_no", *groups.values()]
    # Sorted downwards, these structs put the latest slot first, then unreadable ones in slot order,
    # then the unused ones.
    latest_first = f"sort_array({slots}, false)"
    # Shifted by one, so that each slot meets the one that starts after it.
    shifted = "slice(concat(array(NULL), this), 1, size(this))"
    return (
        records.selectExpr(*kept, f"{latest_first} AS this")
        .selectExpr(*kept, f"inline(arrays_zip(this, {shifted})) AS (this, later)")
        .where("this IS NOT NULL")
        .selectExpr(
            *kept,
            *(f"this.`{name}` AS `{name}`" for name in names),
            f"{instant('record_date', 'this.at')} AS start_dt",
            "later.begin AS later_begin",
            f"{instant('record_date', 'later.at')} AS later_start",
        )
    )


def resolve_start(slots: DataFrame, calendar: ShiftCalendar = THREE_SHIFTS) -> DataFrame:
    """Add ``start_dt``: ``record_date`` at ``begin``, a day later for slots past midnight."""
    seconds = calendar.seconds_from_record_date("is_evening", "begin")
    return with_exprs(slots, {"start_dt": instant("record_date", seconds)})


BEGIN_HOUR = "_begin_hour"


def with_begin_hour(slots: DataFrame) -> DataFrame:
    """Add the hour in ``begin`` for the operators below, which otherwise read it each for itself.

    They ask for it many times over. As a column it is read once, and the code that Spark generates
    stays small enough for the JVM to compile.
    """
    return with_exprs(slots, {BEGIN_HOUR: hour_of("begin")})


def _with_exprs_by_hour(slots: DataFrame, exprs: Mapping[str, str]) -> DataFrame:
    if BEGIN_HOUR in slots.columns:
        return with_exprs(slots, exprs)
    return with_exprs(with_begin_hour(slots), exprs).drop(BEGIN_HOUR)


def production_date(slots: DataFrame, calendar: ShiftCalendar = THREE_SHIFTS) -> DataFrame:
    """Add ``production_date``; early-morning slots count to the day before, unless an evening
    record runs on into them."""
    own_day = f"{BEGIN_HOUR} >= {calendar.morning_hour} OR is_evening"
    date = f"CASE WHEN {own_day} THEN record_date ELSE date_sub(record_date, 1) END"
    return _with_exprs_by_hour(slots, {"production_date": date})


def assign_shift(slots: DataFrame, calendar: ShiftCalendar = THREE_SHIFTS) -> DataFrame:
    """Add ``shift`` and ``shift_order`` from the hour in ``begin``."""
    shift = {"shift": calendar.label(BEGIN_HOUR), "shift_order": calendar.order(BEGIN_HOUR)}
    return _with_exprs_by_hour(slots, shift)


def with_later_slot(
    slots: DataFrame,
    record_key: Sequence[str] = ("id",),
    order_col: str = "start_dt",
    tie_break: Sequence[str] = ("slot_no",),
    strategy: str = "window",
) -> DataFrame:
    """Add ``later_begin`` and ``later_start``: begin text and start of the next-later slot.

    ``strategy="window"`` puts each record into one task. ``strategy="two_phase"`` also holds when
    a single record is too large for that: rows are cut into ranges of record and time, and only
    the last slot of each range travels on to the next one.
    """
    order = [f"{order_col} DESC NULLS LAST", *(f"{c} ASC" for c in tie_break)]
    later = {"later_begin": "begin", "later_start": order_col}

    if strategy == "window":
        over = f"OVER (PARTITION BY {listed(record_key)} ORDER BY {', '.join(order)})"
        return with_exprs(slots, {name: f"lag({c}) {over}" for name, c in later.items()})
    if strategy != "two_phase":
        raise ValueError(f"unknown strategy {strategy!r}")

    by_time = [(order_col, "DESC NULLS LAST"), *((c, "ASC") for c in tie_break)]
    ranged = pinned_ranges(slots, [*((c, "ASC") for c in record_key), *by_time])
    edges = edge_before(ranged, {"_edge": (f"struct({listed([*record_key, *later.values()])})", "true")})
    over = f"OVER (PARTITION BY _range, {listed(record_key)} ORDER BY _position)"
    carried = f"{FIRST_OF_RANGE} AND {same_key('_edge', record_key)}"
    neighbours = {
        name: f"CASE WHEN {carried} THEN _edge.{c} ELSE lag({c}) {over} END"
        for name, c in later.items()
    }
    return with_exprs(ranged.join(edges, "_range", "left"), neighbours).drop(
        "_range", "_position", "_edge"
    )


def resolve_end(
    slots: DataFrame,
    calendar: ShiftCalendar = THREE_SHIFTS,
    fix_next_day_fallback: bool = False,
) -> DataFrame:
    """Add ``end_dt`` and its display text ``end``.

    A slot ends where the next-later slot of its record starts; the last one at the record's
    ``time_end``; without that, at the end of the shift its begin hour names, on
    ``record_date``. That last rule gives an evening record's slot past midnight an end before its
    start, which makes an empty interval; ``fix_next_day_fallback`` counts from the day the slot
    starts on instead.
    """
    last_day = "to_date(start_dt)" if fix_next_day_fallback else "record_date"
    end_dt = (
        "CASE WHEN later_start IS NOT NULL THEN later_start "
        "WHEN time_end IS NOT NULL THEN record_end_dt "
        f"ELSE {calendar.end_instant(BEGIN_HOUR, last_day)} END"
    )
    end_text = (
        "CASE WHEN later_begin IS NOT NULL THEN left(later_begin, 5) "
        f"WHEN time_end IS NOT NULL THEN left(time_end, 5) ELSE {calendar.end_text(BEGIN_HOUR)} END"
    )
    return _with_exprs_by_hour(slots, {"end_dt": end_dt, "end": end_text})


def display_columns(slots: DataFrame) -> DataFrame:
    """Add ``start`` (``HH:MM`` text) and ``sort_begin`` (the begin text rows are ordered by)."""
    return with_exprs(slots, {"start": "left(begin, 5)", "sort_begin": "begin"})


def window_start(as_of: dt.date | None, days: int) -> str:
    """First date of the window of ``days`` days before ``as_of`` (default: today)."""
    today = "current_date()" if as_of is None else f"DATE'{as_of.isoformat()}'"
    return f"date_sub({today}, {days})"


def trailing_window(
    df: DataFrame, date_col: str, as_of: dt.date | None = None, days: int = 2
) -> DataFrame:
    """Rows dated ``days`` before ``as_of`` (default: today) or later; undated rows go."""
    return df.where(f"`{date_col}` >= {window_start(as_of, days)}")


# Why the boundary split drops a slot: which of its times cannot be read. NULL for the others.
REJECTED = (
    "CASE WHEN record_date IS NULL THEN 'date_begin' WHEN start_dt IS NULL THEN 'begin' "
    "WHEN end_dt IS NULL THEN 'time_end' END"
)


def rejected_slots(slots: DataFrame) -> DataFrame:
    """Slots that the boundary split drops because a time cannot be read, counted by reason."""
    rejected = slots.selectExpr(f"{REJECTED} AS reason").where("reason IS NOT NULL")
    return rejected.groupBy("reason").count().withColumnRenamed("count", "n_slots")
