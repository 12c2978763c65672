"""The hand-computed case, from records to payload."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from shop_floor import sources

from shiftline.operators.booking import (
    BOOKING_COLUMNS,
    REPORT_ORDER,
    RESULT_COLUMNS,
    payload_batches,
    payload_json,
    report_rows,
)
from shiftline.operators.lookup import unresolved_report
from shiftline.plans.pipeline import bookings, enriched_slots

AS_OF = dt.date(2025, 1, 10)

REPORT = [
    "09-01-2025 A PX-2 102 08:05 14:00 100 90 None 10.25 7.50 3.35 20.15 4 1",
    "09-01-2025 A PX-1 101 14:00 16:00 120 112 8 10.75 8.50 3.45 20.25 2 0",
    "09-01-2025 B PX-1 101 16:00 16:30 30 28 2 11.00 9.00 3.50 20.30 1 0",
    "09-01-2025 B PX-3 PX-3 22:00 00:00 55 49 3 None None None None 0 0",
    "09-01-2025 C PX-3 PX-3 00:00 01:15 35 31 2 None None None None 0 0",
    "09-01-2025 C PX-1 101 01:15 07:30 60 60 0 None None None None 0 0",
    "09-01-2025 C PX-1 101 07:00 08:00 23 25 1 None None None None 0 0",
    "10-01-2025 A PX-1 101 08:00 09:00 22 25 0 None None None None 0 0",
]
BOOKED = [
    ("2025-01-09", "A", "08:05:00", "14:00:00", 102, 100, 10, 90, 1, 1, 4, 10.25, 7.5, 3.35, 20.15),
    ("2025-01-09", "A", "14:00:00", "16:00:00", 101, 120, 8, 112, 1, 0, 2, 10.75, 8.5, 3.45, 20.25),
    ("2025-01-09", "B", "16:00:00", "16:30:00", 101, 30, 2, 28, 1, 0, 1, 11.0, 9.0, 3.5, 20.3),
    ("2025-01-09", "C", "01:15:00", "07:30:00", 101, 60, 0, 60, 1, 0, 0, 11.0, 9.0, 3.5, 20.3),
    ("2025-01-09", "C", "07:00:00", "08:00:00", 101, 23, 0, 25, 1, 0, 0, 11.0, 9.0, 3.5, 20.3),
    ("2025-01-10", "A", "08:00:00", "09:00:00", 101, 22, 0, 25, 1, 0, 0, 11.0, 9.0, 3.5, 20.3),
]


@pytest.mark.parametrize("one_row_per_record", [True, False])
def test_report(spark, one_row_per_record):
    enriched = enriched_slots(sources(spark), AS_OF, one_row_per_record=one_row_per_record)
    report = report_rows(enriched)
    assert report.columns == list(RESULT_COLUMNS)
    assert [" ".join(map(str, row)) for row in report.collect()] == REPORT
    assert report.schema["Bentonite"].dataType.simpleString() == "decimal(18,2)"


def test_unresolved(spark):
    enriched = enriched_slots(sources(spark), AS_OF)
    assert [row.component for row in unresolved_report(enriched).collect()] == ["PX-3"]


@pytest.mark.parametrize("strategy", ["window", "two_phase"])
def test_bookings(spark, strategy):
    rows = bookings(sources(spark), AS_OF, keep=REPORT_ORDER[1:3], fill_strategy=strategy)
    ordered = rows.orderBy("date", "shift_order", "sort_begin").select(*BOOKING_COLUMNS)
    assert [tuple(row) for row in ordered.collect()] == BOOKED


def test_payload(spark):
    rows = bookings(sources(spark), AS_OF, keep=REPORT_ORDER[1:3])
    lines = [json.loads(row.payload) for row in payload_json(rows).collect()]
    assert sorted(tuple(line.values()) for line in lines) == sorted(BOOKED)
    assert all(list(line) == list(BOOKING_COLUMNS) for line in lines)

    batches = payload_batches(rows, ["date", "shift_order", "sort_begin"], batch_size=2)
    batches = batches.orderBy("batch_id").collect()
    assert all(0 < batch.n_bookings <= 2 for batch in batches)
    sent = [tuple(line.values()) for batch in batches for line in json.loads(batch.payload)]
    assert sent == BOOKED


def test_first_rows_stay_blank(spark):
    only_late = [("09.01.2025 16:00:00", "GOOD", 110, Decimal("9.5"), 35, None)]
    rows = bookings(sources(spark, reading_rows=only_late), AS_OF, keep=REPORT_ORDER[1:3])
    lines = [json.loads(row.payload) for row in payload_json(
        rows.orderBy("date", "shift_order", "sort_begin")).collect()]
    assert [line["newSandSetPoint"] for line in lines] == ["", 9.5, 9.5, 9.5, 9.5, 9.5]
    assert {line["waterSetPoint"] for line in lines} == {""}
    table = rows.orderBy("date", "shift_order", "sort_begin").first()
    assert table.newSandSetPoint is None


def test_column_list(spark):
    rows = bookings(sources(spark), AS_OF, line_id=7, columns=("componentId", "foundryLineId"))
    assert rows.columns == ["componentId", "foundryLineId"]
    assert {row.foundryLineId for row in rows.collect()} == {7}
