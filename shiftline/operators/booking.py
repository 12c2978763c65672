"""The booking payload: its rows, its JSON and its batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftline.functions import quoted
from shiftline.operators.ordered import pinned_ranges, written

# The order in which results are reported. The first three are the reported order;
# the rest only settle ties, so that the forward fill always sees rows in one order.
REPORT_ORDER = (
    "production_date",
    "shift_order",
    "sort_begin",
    "component",
    "component_key",
    "start",
    "end",
    "moulded",
    "poured",
    "waste",
)

# The columns of a report, by the name under which it shows them.
RESULT_COLUMNS = {
    "Foundry Date": "production_date",
    "Shift": "shift",
    "Component": "component",
    "ComponentID": "component_key",
    "Start": "start",
    "End": "end",
    "Moulded": "moulded",
    "Poured": "poured",
    "Waste": "waste",
    "Bentonite": "bentonite",
    "New Sand": "new_sand",
    "LCA": "lca",
    "Water": "water",
    "No of Batches": "n_batches",
    "Bad Batch": "n_bad",
}

# Payload columns in the order they are delivered.
BOOKING_COLUMNS = (
    "date",
    "shift",
    "startTime",
    "endTime",
    "componentId",
    "totalMould",
    "unpouredMould",
    "noOfBoxesPoured",
    "foundryLineId",
    "badBatches",
    "noOfBatches",
    "bentoniteSetPoint",
    "newSandSetPoint",
    "coalDustSetPoint",
    "waterSetPoint",
)

# Which channel becomes which setpoint.
SETPOINTS = {
    "bentonite": "bentoniteSetPoint",
    "new_sand": "newSandSetPoint",
    "lca": "coalDustSetPoint",
    "water": "waterSetPoint",
}


def report_rows(enriched: DataFrame, order: Sequence[str] = REPORT_ORDER) -> DataFrame:
    """The 15 report columns in report order, dates as ``dd-MM-yyyy`` text.

    The rows are written before they are sorted, as a sort runs the plan behind it twice.
    """
    shown = {"production_date": "date_format(production_date, 'dd-MM-yyyy')"}
    return written(enriched).orderBy(*order).selectExpr(
        *(f"{shown.get(c, f'`{c}`')} AS `{name}`" for name, c in RESULT_COLUMNS.items())
    )


def to_booking(
    resolved: DataFrame,
    line_id: int = 1,
    columns: Sequence[str] = BOOKING_COLUMNS,
    keep: Sequence[str] = (),
    line: str | None = None,
) -> DataFrame:
    """Booking rows of enriched slots that have a component id.

    Setpoints are taken as they are; fill them first. ``keep`` adds input columns, such as those
    that carry the order. ``line`` names the column with each row's line, in place of ``line_id``.
    """

    def count(name: str) -> str:
        return f"CAST(coalesce({name}, 0) AS BIGINT)"

    values = {
        "date": "date_format(production_date, 'yyyy-MM-dd')",
        "shift": "shift",
        "startTime": "concat(start, ':00')",
        "endTime": "concat(end, ':00')",
        "componentId": "component_id",
        "totalMould": count("moulded"),
        "unpouredMould": f"greatest({count('moulded')} - {count('poured')}, 0)",
        "noOfBoxesPoured": count("poured"),
        "foundryLineId": f"CAST({line_id if line is None else f'`{line}`'} AS BIGINT)",
        "badBatches": count("n_bad"),
        "noOfBatches": count("n_batches"),
        **{setpoint: f"CAST({c} AS DOUBLE)" for c, setpoint in SETPOINTS.items()},
    }
    return resolved.where("component_id IS NOT NULL").selectExpr(
        *(f"{values[c]} AS `{c}`" for c in columns), *quoted(keep)
    )


def booking_json(columns: Sequence[str]) -> str:
    """One JSON object with all ``columns``; NULL is written as ``""``."""
    fields = ", ".join(
        f"'{c}', CASE WHEN `{c}` IS NULL THEN parse_json('\"\"') ELSE CAST(`{c}` AS VARIANT) END"
        for c in columns
    )
    return f"to_json(named_struct({fields}))"


def payload_json(bookings: DataFrame, columns: Sequence[str] = BOOKING_COLUMNS) -> DataFrame:
    """One JSON text per booking, in column ``payload``."""
    others = [c for c in bookings.columns if c not in columns]
    return bookings.selectExpr(*quoted(others), f"{booking_json(columns)} AS payload")


def payload_batches(
    bookings: DataFrame,
    order_by: Sequence[str],
    batch_size: int = 500,
    columns: Sequence[str] = BOOKING_COLUMNS,
) -> DataFrame:
    """JSON arrays of ``batch_size`` bookings each, the last one may be shorter, numbered from 0.

    Batches hold consecutive bookings along ``order_by``. They do not depend on the number of tasks:
    a booking's number is its place in its range of the order plus the bookings of the ranges before.
    """
    ranged = pinned_ranges(bookings, [(c, "ASC") for c in order_by])
    counts = ranged.groupBy("_range").agg(
        F.expr("count(1) AS _n"), F.expr("min(_position) AS _first")
    )
    # One row per range.
    earlier = "OVER (ORDER BY _range ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    counts = counts.selectExpr("_range", f"coalesce(sum(_n) {earlier}, 0) - _first AS _base")
    members = f"struct(_position, {booking_json(columns)} AS json)"
    batches = (
        ranged.join(F.broadcast(counts), "_range")
        .groupBy(F.expr(f"(_position + _base) div {batch_size} AS batch_id"))
        .agg(
            F.expr("count(1) AS n_bookings"),
            F.expr(f"sort_array(collect_list({members})) AS _bookings"),
        )
    )
    return batches.selectExpr(
        "batch_id", "n_bookings", "concat('[', array_join(_bookings.json, ', '), ']') AS payload"
    )
