"""The paths taken on large data give what the plain ones give."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shiftline.functions.numbers import exact_mean, share, to_whole_number
from shiftline.functions.text_time import minutes_between
from shiftline.operators.fill import forward_fill
from shiftline.operators.intervals import attach_interval_totals
from shiftline.operators.lookup import resolve_component
from shiftline.operators.ordered import pinned_ranges
from shiftline.operators.skew import join_by_weight
from shiftline.operators.slots import with_later_slot


@pytest.fixture
def many_ranges(spark):
    """Keep AQE from merging the small ranges of a test."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def same_rows(left, right):
    columns = sorted(left.columns)
    rows = [sorted(map(str, df.select(columns).collect())) for df in (left, right)]
    return rows[0] == rows[1]


def hot_rows(n=600, seed=7):
    """A third of all rows share key 1; values are sparse, with a long stretch of none."""
    rng = random.Random(seed)
    return [
        (
            i,
            rng.choice([1, None, 2, 3, 4, 5]) if i % 3 else 1,
            None if 100 < i < 400 or rng.random() < 0.7 else i * 10,
            None if rng.random() < 0.9 else i,
        )
        for i in range(n)
    ]


@pytest.mark.parametrize("keys", [(), ("k",)])
def test_fill_across_ranges(many_ranges, keys):
    df = many_ranges.createDataFrame(hot_rows(), "i INT, k INT, a INT, b INT")
    assert pinned_ranges(df, [("i", "ASC")]).select("_range").distinct().count() > 4
    plain = forward_fill(df, ["a", "b"], ["i"], keys, strategy="window")
    assert same_rows(forward_fill(df, ["a", "b"], ["i"], keys), plain)


def test_later_slot_across_ranges(many_ranges):
    rng = random.Random(3)
    rows = [
        (
            rng.choice([1, 1, 1, None, 2, 3]),
            f"{i}",
            None if rng.random() < 0.1 else dt.datetime(2025, 1, 1) + dt.timedelta(
                seconds=rng.randrange(90)),
            i,
        )
        for i in range(500)
    ]
    slots = many_ranges.createDataFrame(
        rows, "id INT, begin STRING, start_dt TIMESTAMP_NTZ, slot_no INT"
    )
    plain = with_later_slot(slots)
    assert same_rows(with_later_slot(slots, strategy="two_phase"), plain)


def inside(closed, start, end, at):
    after = at >= start if closed in ("both", "left") else at > start
    before = at <= end if closed in ("both", "right") else at < end
    return after and before


@pytest.mark.parametrize(
    "closed, stretches, broadcast_rows, by",
    [
        ("both", ("day",), 10**6, ()),
        ("left", ("minute", "day"), 0, ()),
        ("right", ("hour",), 0, ("line",)),
        ("neither", (), 0, ("line",)),
    ],
)
def test_totals_equal_pairs(spark, closed, stretches, broadcast_rows, by):
    rng = random.Random(11)
    first = dt.datetime(2024, 12, 31, 20)

    def moment():
        return first + dt.timedelta(seconds=rng.choice([0, 15_000, rng.randrange(200_000)]))

    slots = [
        (i, rng.choice([1, 2, None]), first if i % 3 == 0 else moment(),
         None if i % 41 == 0 else moment())
        for i in range(150)
    ]
    points = [
        (rng.choice([1, 2]), None if i % 37 == 0 else moment(), i,
         None if i % 5 == 0 else Decimal(i) / 8 - 9)
        for i in range(200)
    ]
    found = attach_interval_totals(
        spark.createDataFrame(slots, "i INT, line INT, s TIMESTAMP_NTZ, e TIMESTAMP_NTZ"),
        spark.createDataFrame(points, "line INT, ts TIMESTAMP_NTZ, n INT, v DECIMAL(18,4)"),
        "s", "e", "ts", {"n_points": "1", "n_sum": "n", "v_sum": "v"}, by, closed, stretches,
        broadcast_rows,
    ).collect()
    expected = {}
    for i, line, start, end in slots:
        hits = [
            (n, v) for of, at, n, v in points
            if end and at and (not by or of == line) and inside(closed, start, end, at)
            and start <= end
        ]
        expected[i] = (len(hits), sum(n for n, _ in hits), sum(v or 0 for _, v in hits))
    assert {r.i: (r.n_points, r.n_sum, r.v_sum) for r in found} == expected
    assert any(count for count, _, _ in expected.values())


def test_heavy_keys_leave_the_shuffle(spark):
    left = spark.createDataFrame(
        [(i, 1 if i % 3 == 0 else i % 7) for i in range(300)] + [(999, None)], "i INT, k INT"
    )
    right = left.groupBy("k").agg(F.count("*").alias("w")).where("k IS NOT NULL AND k <> 5")
    right = right.selectExpr("k", "w", "k * 100 AS v")
    joined = join_by_weight(left, right, ["k"], "w", heavy_rows=50)
    assert same_rows(joined, left.join(right.drop("w"), "k", "left"))


def test_large_lookup_is_salted(spark):
    slots = spark.createDataFrame(
        [(i, f" PX-{1 if i % 3 else i}") for i in range(200)] + [(999, None)],
        "i INT, component STRING",
    )
    mapping = spark.createDataFrame(
        [(f"PX-{i}", i) for i in range(0, 150)] + [("PX-1", 77)], "Component STRING, ComponentID INT"
    )
    plain = resolve_component(slots, mapping)
    assert same_rows(resolve_component(slots, mapping, broadcast_bytes=0), plain)
    assert plain.where("i = 4").count() == 2


def test_exact_mean(spark):
    cases = [
        ("0.03000", 6, "0.01"), ("-0.03000", 6, "-0.01"), ("0.02999", 6, "0.00"),
        ("1.00500", 1, "1.01"), ("10.04999", 1, "10.05"), ("10.00499", 1, "10.00"),
        ("0.00000", 0, "None"),
    ]
    df = spark.createDataFrame(
        [(Decimal(total), n, mean) for total, n, mean in cases],
        "total DECIMAL(38,5), n BIGINT, mean STRING",
    )
    found = df.selectExpr(f"{exact_mean('total', 'n')} AS found", "mean").collect()
    assert [str(r.found) for r in found] == [r.mean for r in found]


def test_numbers_and_minutes(spark):
    found = spark.range(1).selectExpr(
        f"{share('45L', '60', '120')} AS half",
        f"{share('45L', '60', '0')} AS nothing",
        *(f"{to_whole_number(repr(t))} AS n{i}" for i, t in enumerate(
            ["12", " 12 ", "12.9", "1e3", "12D", "PX", "", "inf"])),
        minutes_between("TIMESTAMP_NTZ'2025-03-09 01:00:00'", "TIMESTAMP_NTZ'2025-03-09 04:00:59'")
        + " AS over_clock_change",
        minutes_between("TIMESTAMP_NTZ'2025-01-01 01:01:45'", "TIMESTAMP_NTZ'2025-01-01 01:00:00'")
        + " AS backwards",
    ).first()
    assert (found.half, found.nothing) == (23, None)
    assert list(found)[2:10] == [12, 12, 12, 1000, None, None, None, None]
    assert (found.over_clock_change, found.backwards) == (180, -1)
