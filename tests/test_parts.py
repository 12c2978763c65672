"""Sums that travel as whole numbers, and what the intervals' totals do only once."""

import datetime as dt
import random
import sys
from decimal import Decimal
from fractions import Fraction
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from test_plans import _counted, _explained

from shiftline.functions.numbers import (
    exact_mean,
    exact_mean_of_parts,
    high_part,
    low_part,
    parts_are_small,
    whole_units,
)
from shiftline.operators.intervals import enrich_intervals
from shiftline.sources.totals import KeptTotals, update_totals

NOON = dt.datetime(2024, 1, 5, 12)


def _at(minutes):
    return NOON + dt.timedelta(minutes=minutes)


def _tables(spark, factor, digits="20,4"):
    """Intervals of which some share a key, and a reading a minute, of ``factor`` and more."""
    rng = random.Random(5)
    slots = [(f"k{i % 7}", _at(a), _at(a + rng.randrange(-3, 40))) for i in range(40) for a in [rng.randrange(60)]]
    slots += slots[:5] + [("none", _at(900), _at(950)), ("null", None, _at(5))]
    points = [
        (_at(m), rng.choice(["GOOD", "GOOD", "BAD"]), Decimal(factor) * m + Decimal(m % 13) / 8 - 1)
        for m in range(100)
    ]
    return (
        (slots, spark.createDataFrame(slots, "name string, start_dt timestamp_ntz, end_dt timestamp_ntz")),
        (points, spark.createDataFrame(points, f"mem_dt timestamp_ntz, type string, water decimal({digits})")),
    )


def _plain(slots, points):
    rows = {}
    for name, start, end in slots:
        inside = [] if start is None else [p for p in points if start <= p[0] <= end]
        bad = sum(kind == "BAD" for _, kind, _ in inside)
        good = [value for _, kind, value in inside if kind == "GOOD"]
        had = rows.setdefault(name, [0, 0, []])
        rows[name] = [max(had[0], len(inside)), max(had[1], bad), had[2] + good]

    def mean(values):
        exact = Fraction(sum(map(Fraction, values))) / len(values) * 100
        cents = int(abs(exact) + Fraction(1, 2)) * (-1 if exact < 0 else 1)
        return Decimal(cents).scaleb(-2)

    return {name: (n, bad, mean(good) if good else None) for name, (n, bad, good) in rows.items()}


@pytest.mark.parametrize("broadcast_rows", [0, 1000])
@pytest.mark.parametrize("factor", [1, -3, 10**7, -(10**7), 10**13])
def test_means_of_small_and_large_sums(spark, factor, broadcast_rows):
    (slots, slots_df), (points, points_df) = _tables(spark, factor)
    found = enrich_intervals(
        slots_df, points_df, channels=["water"], keys=["name"], broadcast_rows=broadcast_rows, heavy_rows=2
    )
    assert {r.name: (r.n_batches, r.n_bad, r.water) for r in found.collect()} == _plain(slots, points)
    assert dict(found.dtypes)["water"] == "decimal(18,2)"


def test_sums_travel_as_whole_numbers(spark):
    (_, slots), (_, points) = _tables(spark, 1)
    for rows in (0, 1000):
        found = enrich_intervals(slots, points, channels=["water"], keys=["name"], broadcast_rows=rows)
        plan = _explained(found, "simple")
        assert "sum(coalesce(high_water" in plan.replace("`", "") or "sum(high_water" in plan
        assert "SortMergeJoin" not in plan and "sum_water" not in plan.split("FileScan")[0]


@pytest.mark.parametrize("places", [0, 4, 5, 17])
def test_mean_of_parts_is_the_exact_mean(spark, places):
    rng = random.Random(places)
    units = [0, 1, -1, 5, -5, 2**30, -(2**30), 10**18 - 1, 1 - 10**18]
    units += [rng.randrange(-(10**rng.randrange(1, 18)), 10**17) for _ in range(60)]
    rows = [
        (Decimal(u).scaleb(-places), copies, n)
        for u in units
        for copies, n in ((1, 1), (1, 0), (3, 8), (7, 200), (1, 10**9))
        if abs(u) * copies < 10 ** (15 + places) * max(n, 1)  # means have 18 digits
    ]
    df = spark.createDataFrame(rows, f"total decimal(38,{places}), copies long, n long")
    whole = whole_units("total", places)
    df = df.selectExpr("*", f"{high_part(whole)} * copies AS high", f"{low_part(whole)} * copies AS low")
    df = df.selectExpr("*", f"{parts_are_small(['high'], ['low'], ['n'], places)} AS small")
    exact = f"CAST(CAST(total AS DECIMAL(28,{places})) * copies AS DECIMAL(38,{places}))"
    shown = df.selectExpr(
        "small",
        f"{exact_mean_of_parts('high', 'low', 'n', places, 'small')} AS got",
        f"{exact_mean(exact, 'n', places)} AS want",
    ).collect()
    assert [r for r in shown if r.got != r.want] == []
    assert {r.small for r in shown} == {True, False}


def test_kept_totals_run_the_plan_of_intervals_once(spark, tmp_path):
    (_, slots), (_, points) = _tables(spark, 1)
    update_totals(points, str(tmp_path / "kept"), "mem_dt", {"n": "1"})
    runs = spark.sparkContext.accumulator(0)
    asked = _counted(slots.selectExpr("start_dt", "end_dt", "monotonically_increasing_id() AS id"), runs, "id")
    asked = asked.where("id IS NOT NULL AND start_dt IS NOT NULL")
    found = KeptTotals(spark, str(tmp_path / "kept")).interval_totals(asked, "start_dt", "end_dt")
    assert found.count() == 46
    assert runs.value <= 47  # rows of ``slots``
