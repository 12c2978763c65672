"""Cut intervals at shift boundaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from shiftline.functions import with_exprs
from shiftline.functions.calendar import THREE_SHIFTS, ShiftCalendar
from shiftline.functions.numbers import share
from shiftline.functions.text_time import minutes_between

QUANTITIES = ("moulded", "poured", "waste")


def split_at_boundary(
    intervals: DataFrame,
    start: str = "start_dt",
    end: str = "end_dt",
    quantities: Sequence[str] = QUANTITIES,
    calendar: ShiftCalendar = THREE_SHIFTS,
) -> DataFrame:
    """Cut every interval that runs past the end of the shift it starts in.

    The piece before the boundary gets a share of each quantity by whole minutes, rounded; the
    piece after it gets the rest, so the sum stays the same. An interval shorter than a whole minute
    has no shares, and both pieces lose their quantities. There is one cut at most: the second piece
    may run past a further boundary. An interval that ends exactly on the boundary is not cut.
    Intervals without a readable start or end are dropped.

    Expects and keeps ``production_date``, ``shift``, ``shift_order``, ``start``, ``end`` and
    ``sort_begin``; the pieces get their own.
    """
    measures = {
        "_crosses": f"{end} > _boundary",
        "_before": minutes_between(start, "_boundary"),
        "_whole": minutes_between(start, end),
    }
    facts = {
        f"_first_{q}": f"CASE WHEN _crosses THEN {share(q, '_before', '_whole')} END"
        for q in quantities
    }
    # Without a start or an end the test is unknown, and no array means no row.
    cut = "CASE WHEN _crosses THEN array(1, 2) WHEN NOT _crosses THEN array(0) END"

    # A cut interval starts on `_date` whichever way it is booked, and each boundary is the start
    # of a shift that is booked on that same date.
    own_date = calendar.production_date("_hour", "_date")
    boundary_text = calendar.end_text("_hour")

    def following(attribute: str) -> str:
        return calendar.pick("_hour", lambda shift: getattr(calendar.next_shift(shift), attribute))

    def piece(name: str, before: str, after: str) -> str:
        return f"CASE _piece WHEN 1 THEN {before} WHEN 2 THEN {after} ELSE `{name}` END"

    pieces = {
        "production_date": piece("production_date", own_date, "_date"),
        "shift": piece("shift", calendar.label("_hour"), following("label")),
        "shift_order": piece("shift_order", calendar.order("_hour"), following("order")),
        "start": piece("start", "start", boundary_text),
        "end": piece("end", boundary_text, "end"),
        "sort_begin": piece("sort_begin", "sort_begin", f"concat({boundary_text}, ':00')"),
        start: piece(start, start, "_boundary"),
        end: piece(end, "_boundary", end),
    }
    for q in quantities:
        kind = intervals.schema[q].dataType.simpleString()
        divided = piece(q, f"`_first_{q}`", f"`{q}` - `_first_{q}`")
        pieces[q] = f"CAST({divided} AS {kind})"
    timed = with_exprs(intervals, {"_hour": f"hour({start})", "_date": f"to_date({start})"})
    bounded = with_exprs(timed, {"_boundary": calendar.end_instant("_hour", "_date")})
    return (
        with_exprs(with_exprs(bounded, measures), facts)
        .selectExpr("*", f"explode({cut}) AS _piece")
        .selectExpr(*(f"{pieces.get(c, f'`{c}`')} AS `{c}`" for c in intervals.columns))
    )
