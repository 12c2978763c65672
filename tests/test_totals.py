"""Totals that are kept between runs and probed by intervals."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from shop_floor import G1_READINGS, readings, sources

from shiftline.operators.intervals import attach_interval_totals
from shiftline.plans.pipeline import Sources, bookings
from shiftline.sources import versions
from shiftline.sources.totals import KeptTotals, keep_readings, update_totals

TOTALS = {"n": "1", "total": "v", "large": "CASE WHEN v > 5 THEN v END"}
POINTS = "line string, at timestamp_ntz, v decimal(9,3)"
INTERVALS = "line string, b timestamp_ntz, e timestamp_ntz"
START = dt.datetime(2025, 1, 1)


def drawn(seed, n=400):
    rng = random.Random(seed)

    def instant():
        # Days 3 and 4 have no points of their own; many instants are equal or share a minute.
        day = rng.choice([-400, 0, 1, 2, 5, 6])
        return START + dt.timedelta(days=day, seconds=rng.choice([0, 30, 59, 60, 61, 43_200, 86_399]) + rng.randrange(3))

    lines = ["a", "b", None]
    values = [None, Decimal("0.001"), Decimal("7.5"), Decimal("-3")]
    points = [(rng.choice(lines), rng.choice([instant(), instant(), None]), rng.choice(values)) for _ in range(n)]

    def bound():
        if rng.random() < 0.2:
            return START + dt.timedelta(days=rng.choice([3, 4, 9, -500]), seconds=rng.randrange(86_400))
        return instant()

    intervals = [(rng.choice([*lines, "c"]), bound(), rng.choice([bound(), bound(), None])) for _ in range(60)]
    return points, intervals


def texts(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("closed, by", [("both", ["line"]), ("neither", [])])
def test_kept_totals_equal_plain_ones(spark, tmp_path, closed, by):
    """Three updates, the last one late; then a date is replaced."""
    path = str(tmp_path / "totals")
    points, intervals = drawn(len(by) + len(closed))
    late = lambda p: p[1] is not None and p[1].date() == dt.date(2025, 1, 2)
    on_time = [p for p in points if not late(p)]
    for batch in (on_time[::2], on_time[1::2], [p for p in points if late(p)]):
        found = update_totals(spark.createDataFrame(batch, POINTS), path, "at", TOTALS, by)
    assert found["dates"] == ["2025-01-02"] and found["version"] == 3

    def check(of):
        plain = spark.createDataFrame(of, POINTS)
        rows = spark.createDataFrame(intervals, INTERVALS)
        sides = [
            attach_interval_totals(rows, side, "b", "e", "at", TOTALS, by, closed)
            for side in (KeptTotals(spark, path), plain)
        ]
        assert texts(sides[0].select(sides[1].columns)) == texts(sides[1])

    check(points)
    corrected = [("a", START + dt.timedelta(days=1, seconds=30), Decimal(9))]
    update_totals(spark.createDataFrame(corrected, POINTS), path, "at", TOTALS, by, ["2025-01-02"])
    check([*on_time, *corrected])
    update_totals(spark.createDataFrame([], POINTS), path, "at", TOTALS, by, ["2025-01-02"])
    assert not any("2025-01-02" in d for d in versions.current(spark, path).folders)


def test_probes_read_their_own_dates(spark, tmp_path):
    path = str(tmp_path / "totals")
    days = [(None, START + dt.timedelta(days=d, hours=9), Decimal(d)) for d in range(30)]
    update_totals(spark.createDataFrame(days, POINTS), path, "at", TOTALS)
    folders = dict(versions.current(spark, path).folders)
    late = [(None, START + dt.timedelta(days=3, hours=1), Decimal(1))]
    assert update_totals(spark.createDataFrame(late, POINTS), path, "at", TOTALS)["rows"] == 4
    after = versions.current(spark, path).folders
    assert {d for d in after if after[d] != folders[d]} == {"2025-01-04", "minutes-2025-01-04"}
    interval = [(None, START + dt.timedelta(days=1), START + dt.timedelta(days=20, hours=12))]
    probe = spark.createDataFrame(interval, INTERVALS).select("b", "e")
    found = KeptTotals(spark, path).interval_totals(probe, "b", "e")
    read = " ".join(found.inputFiles())
    assert {d for d in folders if f"filed_under={d}/" in read} <= {
        "2025-01-02", "minutes-2025-01-02", "2025-01-21", "minutes-2025-01-21"
    }
    assert [(r.n, r.total) for r in found.collect()] == [(21, sum(range(1, 21)) + 1)]
    # A reader of the first version does not see the late point.
    first = KeptTotals(spark, path, versions.current(spark, path, 1))
    assert [r.n for r in first.interval_totals(probe, "b", "e").collect()] == [20]


def test_kept_totals_edges(spark, tmp_path):
    path = str(tmp_path / "totals")
    empty = spark.createDataFrame([], POINTS)
    probe = spark.createDataFrame([("a", START, START)], INTERVALS)
    with pytest.raises(ValueError):
        KeptTotals(spark, path).interval_totals(probe, "b", "e", ["line"])
    assert update_totals(empty, path, "at", TOTALS, ["line"]) == {"version": 1, "dates": [], "rows": 0}
    assert update_totals(empty, path, "at", TOTALS, ["line"])["version"] == 1
    found = KeptTotals(spark, path).interval_totals(probe, "b", "e", ["line"]).collect()
    assert [(r.n, r.total) for r in found] == [(0, 0)]
    with pytest.raises(ValueError):  # other totals than those kept
        update_totals(empty, path, "at", {"n": "1"}, ["line"])
    with pytest.raises(ValueError):
        KeptTotals(spark, path).interval_totals(probe, "b", "e")
    with pytest.raises(ValueError):
        KeptTotals(spark, path).interval_totals(probe, "b", "e", ["line"], "open")


def test_bookings_over_kept_totals(spark, tmp_path):
    """Bookings are the same, whether the readings are there or their totals."""
    path = str(tmp_path / "totals")
    for part in (G1_READINGS[2:], G1_READINGS[:2], (("n/a", "GOOD", 1, 1, 1, 1),)):
        keep_readings(readings(spark, *part), path)
    plain = sources(spark)
    kept = Sources(plain.production, KeptTotals(spark, path), plain.component_map)
    day = dt.date(2025, 1, 10)
    assert texts(bookings(kept, day)) == texts(bookings(plain, day))
