"""One record per rule that is easy to get wrong; a single run serves all of them."""

import datetime as dt

import pytest
from shop_floor import G1_READINGS, component_map, production, readings, record, sources

from shiftline.operators.intervals import collapse_duplicates, enrich_intervals, normalise_readings
from shiftline.operators.lookup import resolve_component, unresolved_report
from shiftline.operators.slots import rejected_slots, trailing_window
from shiftline.operators.split import split_at_boundary
from shiftline.plans.pipeline import bookings, slot_intervals

AS_OF = dt.date(2025, 1, 10)
RECORDS = (
    # 1: slots out of order
    record(1, "09.01.25", "08:00:00", "12:00:00", (1, "09:00:00", "a", 5, 5, 0),
           (2, "11:00:00", "b", 5, 5, 0), (3, "10:00:00", "c", 5, 5, 0)),
    # 2: no end, so the end of the shift, which is no crossing
    record(2, "09.01.25", "08:00:00", None, (1, "10:00:00", "a", 5, 5, 0)),
    # 3: evening record, slot past midnight, no end: an empty interval
    record(3, "09.01.25", "17:00:00", None, (1, "02:00:00", "a", 5, 5, 0)),
    # 4: crossing in less than a minute loses the quantities
    record(4, "09.01.25", "08:00:00", "16:00:15", (1, "15:59:30", "a", 5, 5, 0)),
    # 5: unreadable begin
    record(5, "09.01.25", "08:00:00", "12:00:00", (1, "xx:00:00", "a", 5, 5, 0)),
    # 6: before the window; 7: its morning half would be inside the window
    record(6, "07.01.25", "08:00:00", "12:00:00", (1, "10:00:00", "a", 5, 5, 0)),
    record(7, "08.01.25", "00:10:00", "09:00:00", (1, "07:00:00", "a", 5, 5, 0)),
    # 8: equal starts are ordered by slot number
    record(8, "09.01.25", "08:00:00", "12:00:00", (1, "09:00:00", "a", 5, 5, 0),
           (2, "09:00:00", "b", 6, 6, 0)),
    # 9: an unreadable end is not replaced
    record(9, "09.01.25", "08:00:00", "zz", (1, "10:00:00", "a", 5, 5, 0)),
    # 10: over two boundaries, cut once
    record(10, "09.01.25", "16:00:00", "07:00:00", (1, "15:30:00", "a", 114, 57, None),
           (2, "01:00:00", "b", 5, 5, 0)),
    # 11: short and unpadded times
    record(11, "9.1.25", "8:00", "12:30", (1, "9:05:00", "a", 5, 5, 0)),
    # 12: unreadable date
    record(12, "32.01.25", "08:00:00", "12:00:00", (1, "10:00:00", "a", 5, 5, 0)),
)


@pytest.fixture(scope="module", params=[True, False])
def pieces(request, spark):
    slots = slot_intervals(production(spark, *RECORDS), one_row_per_record=request.param)
    recent = trailing_window(slots, "production_date", AS_OF)
    found = {}
    for row in split_at_boundary(recent).orderBy("id", "start_dt", "slot_no").collect():
        found.setdefault(row.id, []).append(row)
    rejects = {row.reason: row.n_slots for row in rejected_slots(slots).collect()}
    return found, rejects


def times(rows):
    return [(r.slot_no, r.start, r.end) for r in rows]


def test_order_of_slots(pieces):
    found, _ = pieces
    assert times(found[1]) == [
        (1, "09:00", "10:00"), (3, "10:00", "11:00"), (2, "11:00", "12:00")
    ]
    # Latest first, slot 1 before slot 2: slot 1 runs to the end, slot 2 ends where slot 1 starts.
    assert times(found[8]) == [(1, "09:00", "12:00"), (2, "09:00", "09:00")]


def test_missing_end(pieces):
    found, _ = pieces
    assert times(found[2]) == [(1, "10:00", "16:00")]
    (empty,) = found[3]
    assert empty.start_dt == dt.datetime(2025, 1, 10, 2)
    assert empty.end_dt == dt.datetime(2025, 1, 9, 8)


def test_crossings(pieces):
    found, _ = pieces
    assert [(r.shift, r.moulded, r.poured) for r in found[4]] == [("A", None, None), ("B", None, None)]
    assert [
        (r.shift, r.start, r.end, r.moulded, r.poured, r.waste, str(r.production_date))
        for r in found[10]
    ] == [
        ("A", "15:30", "16:00", 6, 3, None, "2025-01-09"),
        ("B", "16:00", "01:00", 108, 54, None, "2025-01-09"),
        ("C", "01:00", "07:00", 5, 5, 0, "2025-01-09"),
    ]


def test_dropped(pieces):
    found, rejects = pieces
    assert not {5, 6, 7, 9, 12} & set(found)
    assert rejects == {"begin": 1, "time_end": 1, "date_begin": 1}


def test_short_times(pieces):
    found, _ = pieces
    (row,) = found[11]
    assert (row.start, row.sort_begin, row.end, row.shift) == ("9:05:", "9:05:00", "12:30", "A")
    assert row.start_dt == dt.datetime(2025, 1, 9, 9, 5)


def test_merge_and_lookup(spark):
    slot = (1, "09:00:00", "PX-1", 10, 8, 2)
    records = [
        record(1, "09.01.25", "08:00:00", "10:00:00", slot),
        record(2, "09.01.25", "08:00:00", "10:00:00", slot),
        # Same to the minute, ends later: merges, and the larger counts win.
        record(3, "09.01.25", "08:00:00", "10:00:30", slot),
        record(4, "09.01.25", "08:00:00", "11:00:00", (1, "10:30:00", "1234", 1, 1, 0)),
        record(5, "09.01.25", "08:00:00", "12:00:00", (1, "11:30:00", "12D", 1, 1, 0)),
    ]
    rows = [
        ("09.01.2025 09:00:00", "GOOD", 10, 1, 0, 0),
        ("09.01.2025 09:30:00", "good", 99, 9, 9, 9),
        ("09.01.2025 10:00:10", "GOOD", 40, 2, 0, 0),
        ("not a time", "GOOD", 99, 9, 9, 9),
    ]
    mapping = [("PX-1", 101), (" PX-1", 103), ("px-1 ", 101)]
    pieces = split_at_boundary(slot_intervals(production(spark, *records)))
    assert collapse_duplicates(pieces).count() == 3

    enriched = enrich_intervals(pieces, normalise_readings(readings(spark, *rows)))
    lookup = component_map(spark, *mapping)
    found = resolve_component(enriched, lookup).orderBy("sort_begin", "component_id").collect()
    # (1.0 * 3 + 4.0 * 1) / 4 = 1.75: the mean is over the readings of all merged slots.
    assert [(r.component_id, str(r.bentonite), r.n_batches, r.n_bad) for r in found] == [
        (101, "1.75", 3, 0), (103, "1.75", 3, 0), (1234, "None", 0, 0), (None, "None", 0, 0)
    ]
    strict = resolve_component(enriched, lookup, strict=True)
    assert [r.component for r in unresolved_report(strict).collect()] == ["1234", "12D"]

    nocase = normalise_readings(readings(spark, *rows), collation="UTF8_LCASE")
    both = enrich_intervals(pieces.where("id = 1"), nocase).first()
    assert (str(both.bentonite), both.n_batches) == ("5.45", 2)
    lower = pieces.where("id = 1").selectExpr("lower(component) AS component")
    ids = resolve_component(lower, lookup, collation="UTF8_LCASE").collect()
    assert sorted(r.component_id for r in ids) == [101, 103]


def test_no_rows(spark):
    empty = sources(spark, records=())
    assert bookings(empty, AS_OF).count() == 0
    blank = sources(spark, reading_rows=G1_READINGS[:0])
    assert bookings(blank, AS_OF).where("bentoniteSetPoint IS NOT NULL").count() == 0
