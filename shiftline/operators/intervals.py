"""What happened during each interval: totals of points by closed time range.

The obvious plan joins every interval with every reading inside it and aggregates the pairs. With
many intervals over the same hours those pairs grow with the product of the two sides. The plan here
never forms a pair. Totals over a range are the difference of two running totals, so it

1. reduces the intervals to their distinct (start, end), and the points to one row per instant,
2. runs totals over the points along time, within bounded stretches and then across them,
3. lays the intervals' ends between the points, where each takes the running totals of the last
   point before it, and joins the differences back to the intervals.

Counts and decimal sums are exact, so the difference equals the direct sum.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftline.functions import listed, quoted, with_exprs
from shiftline.functions.numbers import (
    MOST_IN_PARTS,
    MOST_ROWS_IN_PARTS,
    exact_mean,
    exact_mean_of_parts,
    high_part,
    low_part,
    parts_are_small,
    whole_units,
)
from shiftline.functions.text_time import parse_datetime_text
from shiftline.operators.ordered import written
from shiftline.operators.skew import HEAVY_ROWS, join_by_weight

# Rows of the interval table (two instants and a dozen numbers, some 300 bytes) up to which every
# executor gets a copy of it.
BROADCAST_INTERVALS = 200_000

# Rows of it per task up to which a join by key holds them in memory; with more, both sides are sorted.
HASHED_INTERVALS = 200_000

# Stretches of time, the finest first.
STRETCHES = ("minute", "day")


def _stretch(unit: str, instant: str) -> str:
    """Number of the calendar ``unit`` (``day``, ``hour`` or ``minute``) that holds ``instant``."""
    day = f"CAST(unix_date(to_date({instant})) AS BIGINT)"
    if unit == "day":
        return day
    if unit == "hour":
        return f"{day} * 24 + hour({instant})"
    if unit == "minute":
        return f"{day} * 1440 + hour({instant}) * 60 + minute({instant})"
    raise ValueError(f"unknown stretch {unit!r}")


def _total_type(name: str, kind: T.DataType) -> str:
    if isinstance(kind, T.IntegralType):
        return "bigint"
    if isinstance(kind, T.DecimalType):
        return f"decimal(38,{kind.scale})"
    raise ValueError(
        f"total {name!r} is {kind.simpleString()}: differences of running totals are only exact "
        "for whole numbers and decimals; cast it to a decimal"
    )


def _sum_of(left: str, right: str, kind: str) -> str:
    """``left + right``, NULL as 0, as ``kind``. Spark cuts decimal places where 39 digits could be
    needed, so decimals are added with one digit less."""
    part = kind.replace("(38,", "(37,")
    return (
        f"CAST(CAST(coalesce({left}, 0) AS {part}) + CAST(coalesce({right}, 0) AS {part}) AS {kind})"
    )


def _grouped(df: DataFrame, keys: Sequence[str], aggregates: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*map(F.expr, aggregates))


def _running_totals(
    rows: DataFrame,
    by: Sequence[str],
    order: str,
    kinds: Mapping[str, str],
    stretches: Sequence[str],
) -> DataFrame:
    """Add ``before_<total>``: the sum over all rows of the same ``by`` that come earlier.

    ``stretches`` are columns that cut time into ever longer stretches. A window only ever spans one
    stretch of the finest kind; whole stretches are carried over as one row each.
    """
    finest = list(stretches[:1])
    keys = f"PARTITION BY {listed([*by, *finest])} " if by or finest else ""
    over = f"OVER ({keys}ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    inside = rows.selectExpr(
        "*",
        *(
            f"CAST(coalesce(sum(`{t}`) {over}, 0) AS {kind}) AS `before_{t}`"
            for t, kind in kinds.items()
        ),
    )
    if not stretches:
        return inside
    per_stretch = _grouped(
        rows,
        [*by, *stretches],
        [f"CAST(sum(`{t}`) AS {kind}) AS `{t}`" for t, kind in kinds.items()],
    )
    carried = _running_totals(per_stretch, by, finest[0], kinds, stretches[1:]).selectExpr(
        *quoted([*by, *finest]), *(f"`before_{t}` AS `carried_{t}`" for t in kinds)
    )
    # Every stretch has its row. A left join, because an inner one would add tests for NULL to one
    # of the two uses of `rows`, and they could no longer share their shuffle.
    return inside.join(carried, [*by, *finest], "left").selectExpr(
        *quoted(rows.columns),
        *(
            f"{_sum_of(f'`before_{t}`', f'`carried_{t}`', kind)} AS `before_{t}`"
            for t, kind in kinds.items()
        ),
    )


def distinct_intervals(
    intervals: DataFrame, start: str, end: str, by: Sequence[str] = (), closed: str = "both"
) -> DataFrame:
    """The different non-empty (``by``, ``start``, ``end``), with how many rows have each in
    ``_weight``. An open interval between equal ends is empty."""
    not_empty = intervals.where(f"`{start}` {'<' if closed == 'neither' else '<='} `{end}`")
    return _grouped(not_empty, [*by, start, end], ["count(1) AS _weight"])


def interval_totals(
    intervals: DataFrame,
    points: DataFrame,
    start: str,
    end: str,
    ts: str,
    totals: Mapping[str, str],
    by: Sequence[str] = (),
    closed: str = "both",
    stretches: Sequence[str] = STRETCHES,
) -> DataFrame:
    """Add to every distinct interval the totals of the points inside it.

    ``totals`` are expressions over ``points``, as SQL text; NULL counts as 0. Whole numbers are
    added up as bigint, decimals at their own scale; floats and doubles are refused. ``closed`` says which ends belong to
    the interval: ``both``, ``left``, ``right`` or ``neither``. ``by`` names columns on both sides
    that must be equal as well.

    ``stretches`` bounds the work of a task: with the default a window holds what lies within one
    minute, and what came before is carried over minutes and days, one row each.
    """
    if closed not in ("both", "left", "right", "neither"):
        raise ValueError(f"unknown closed {closed!r}")
    kinds, instants = instant_totals(points, ts, totals, by)
    instants = instants.selectExpr("*", *_units(stretches))
    if by:  # with a key their two readers would not share a shuffle
        instants = written(instants)
    cuts = [f"_{unit}" for unit in stretches]
    bounds = interval_bounds(intervals, start, end, closed, stretches)
    carried = _carried(instants, bounds, by, kinds, cuts) if cuts else None
    return between_bounds(intervals, bounds, instants, carried, by, kinds, cuts)


def _units(stretches: Sequence[str]) -> list[str]:
    return [f"{_stretch(unit, '_instant')} AS `_{unit}`" for unit in stretches]


def instant_totals(
    points: DataFrame, ts: str, totals: Mapping[str, str], by: Sequence[str] = ()
) -> tuple[dict[str, str], DataFrame]:
    """The type of every total, and one row per instant (``_instant``) with points."""
    measured = points.selectExpr(
        *quoted(by),
        f"`{ts}` AS _instant",
        *(f"{total} AS `{name}`" for name, total in totals.items()),
    ).where("_instant IS NOT NULL")
    kinds = {name: _total_type(name, measured.schema[name].dataType) for name in totals}
    sums = [f"CAST(coalesce(sum(`{name}`), 0) AS {kind}) AS `{name}`" for name, kind in kinds.items()]
    return kinds, _grouped(measured, [*by, "_instant"], sums)


def interval_bounds(
    intervals: DataFrame, start: str, end: str, closed: str, stretches: Sequence[str]
) -> DataFrame:
    """Both ends of every interval, with the stretches that hold them.

    An end that belongs to the interval comes after the points of its instant, a start before.
    """
    phase = {True: 2 if closed in ("both", "right") else 0, False: 0 if closed in ("both", "left") else 2}
    return intervals.selectExpr(
        "*", f"stack(2, `{start}`, false, `{end}`, true) AS (_instant, _is_end)"
    ).selectExpr("*", *_units(stretches), f"IF(_is_end, {phase[True]}, {phase[False]}) AS _phase")


def between_bounds(
    intervals: DataFrame,
    bounds: DataFrame,
    instants: DataFrame,
    carried: DataFrame | None,
    by: Sequence[str],
    kinds: Mapping[str, str],
    cuts: Sequence[str],
) -> DataFrame:
    """Add to every interval what lies between its two ``bounds``.

    ``instants`` have totals per instant, and ``carried`` what came before each of the finest
    stretches (the first of ``cuts``) that hold a bound.
    """
    # Totals from the start of the finest stretch to each instant.
    finest = f"PARTITION BY {listed([*by, *cuts[:1]])} " if by or cuts else ""
    upto = f"OVER ({finest}ORDER BY _instant ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    so_far = ", ".join(
        f"'{name}', CAST(sum(`{name}`) {upto} AS {kind})" for name, kind in kinds.items()
    )
    known = instants.selectExpr(
        *quoted([*by, *cuts]), "_instant", "1 AS _phase", f"named_struct({so_far}) AS _so_far"
    )
    last = f"OVER ({finest}ORDER BY _instant, _phase ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    at_bounds = (
        bounds.unionByName(known, allowMissingColumns=True)
        .selectExpr(*quoted(bounds.columns), f"last(_so_far, true) {last} AS _so_far")
        .where("_is_end IS NOT NULL")
    )
    before = [f"_so_far.`{name}`" for name in kinds]
    if carried is not None:
        at_bounds = at_bounds.join(carried, [*by, cuts[0]], "left")
        before = [
            _sum_of(text, f"`carried_{name}`", kind)
            for text, (name, kind) in zip(before, kinds.items(), strict=True)
        ]
    return _grouped(
        at_bounds,
        intervals.columns,
        [
            f"CAST(coalesce(sum(CASE WHEN _is_end THEN {text} ELSE -({text}) END), 0) AS {kind})"
            f" AS `{name}`"
            for text, (name, kind) in zip(before, kinds.items(), strict=True)
        ],
    )


def _carried(
    instants: DataFrame,
    bounds: DataFrame,
    by: Sequence[str],
    kinds: Mapping[str, str],
    cuts: Sequence[str],
) -> DataFrame:
    """What came before each of the finest stretches that hold a point or an end of an interval."""
    empty = [f"CAST(0 AS {kind}) AS `{name}`" for name, kind in kinds.items()]
    where = quoted([*by, *cuts])
    rows = instants.selectExpr(*where, *quoted(kinds)).unionByName(
        bounds.selectExpr(*where).distinct().selectExpr("*", *empty)
    )
    sums = [f"CAST(sum(`{name}`) AS {kind}) AS `{name}`" for name, kind in kinds.items()]
    per_stretch = _grouped(rows, [*by, *cuts], sums)
    return _running_totals(per_stretch, by, cuts[0], kinds, cuts[1:]).selectExpr(
        *quoted([*by, cuts[0]]), *(f"`before_{name}` AS `carried_{name}`" for name in kinds)
    )


class TotalsOfIntervals(Protocol):
    """Points whose totals are kept somewhere; stands in for the points themselves."""

    def interval_totals(
        self, intervals: DataFrame, start: str, end: str, by: Sequence[str], closed: str
    ) -> DataFrame:
        """As the function of this name, with the totals that are kept."""


def attach_interval_totals(
    intervals: DataFrame,
    points: DataFrame | TotalsOfIntervals,
    start: str,
    end: str,
    ts: str,
    totals: Mapping[str, str],
    by: Sequence[str] = (),
    closed: str = "both",
    stretches: Sequence[str] = STRETCHES,
    broadcast_rows: int = BROADCAST_INTERVALS,
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Every interval with the totals of the points inside it; 0 where there are none.

    This writes two intermediate tables, so it runs the plan of ``intervals``: the intervals, which
    are read for their distinct ends and for the join back, and the totals by distinct interval,
    whose number decides how that join is done. A small table goes to all executors and the
    intervals are not shuffled; a large one is joined by key, with the most frequent intervals taken
    out of the shuffle.

    ``points`` whose totals are kept (``sources.totals.KeptTotals``) are not read again; ``ts`` and
    ``stretches`` are then those they were kept by.
    """
    intervals, per_interval = _totals_by_interval(
        intervals, points, start, end, ts, totals, by, closed, stretches
    )
    keys = [*by, start, end]
    joined = _with_totals(
        intervals, per_interval, per_interval.count(), keys, closed, broadcast_rows, heavy_rows
    )
    return with_exprs(joined, {name: f"coalesce(`{name}`, 0)" for name in totals})


def _totals_by_interval(
    intervals: DataFrame,
    points: DataFrame | TotalsOfIntervals,
    start: str,
    end: str,
    ts: str,
    totals: Mapping[str, str],
    by: Sequence[str],
    closed: str,
    stretches: Sequence[str],
) -> tuple[DataFrame, DataFrame]:
    """The intervals and the totals by distinct interval, both written."""
    intervals = written(intervals)
    # Their ends are read three times.
    distinct = written(distinct_intervals(intervals, start, end, by, closed))
    if isinstance(points, DataFrame):
        found = interval_totals(distinct, points, start, end, ts, totals, by, closed, stretches)
    else:
        found = points.interval_totals(distinct, start, end, by, closed)
    return intervals, written(found.selectExpr(*quoted([*distinct.columns, *totals])))


def _with_totals(
    intervals: DataFrame,
    per_interval: DataFrame,
    count: int,
    keys: Sequence[str],
    closed: str,
    broadcast_rows: int,
    heavy_rows: int,
) -> DataFrame:
    """Join the ``count`` rows of ``per_interval`` back; NULL where an interval has no row there."""
    if count <= broadcast_rows:
        return intervals.join(F.broadcast(per_interval.drop("_weight")), list(keys), "left")
    *_, start, end = keys
    empty = f"`{start}` {'>=' if closed == 'neither' else '>'} `{end}`"
    tasks = int(intervals.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hashed = count <= HASHED_INTERVALS * tasks
    return join_by_weight(intervals, per_interval, keys, "_weight", heavy_rows, empty, hashed)


# The channels of a reading, by the name they are reported under.
CHANNELS = ("bentonite", "new_sand", "lca", "water")

# Keys by which slots are reported. Two slots equal on all of them become one row, and their
# quantities are not added up.
REPORT_KEYS = (
    "production_date",
    "shift",
    "component",
    "start",
    "end",
    "moulded",
    "poured",
    "waste",
    "shift_order",
    "sort_begin",
)


def normalise_readings(
    readings: DataFrame, extra: Sequence[str] = (), collation: str | None = None
) -> DataFrame:
    """``mem_dt`` and ``type`` of every reading, and its channels in their reporting unit.

    Channels keep every digit: a tenth has one decimal place more than its input. They must be
    decimals or whole numbers. ``collation`` (such as ``UTF8_LCASE``) decides how ``type`` compares;
    the default is bytewise.
    """
    def number(channel: str) -> tuple[int, int]:
        kind = readings.schema[channel].dataType
        if isinstance(kind, T.IntegralType):
            return 20, 0
        if isinstance(kind, T.DecimalType):
            return min(kind.precision, 36), kind.scale
        raise ValueError(f"{channel} is {kind.simpleString()}: cast it to a decimal")

    def tenth(channel: str) -> str:
        digits, places = number(channel)
        exact = f"CAST({channel} AS DECIMAL({digits},{places})) * 0.1BD"
        return f"CAST({exact} AS DECIMAL({digits + 1},{places + 1}))"

    def whole(channel: str) -> str:
        digits, places = number(channel)
        return f"CAST({channel} AS DECIMAL({digits},{places}))"

    kind = "type" if collation is None else f"collate(type, '{collation}')"
    return readings.selectExpr(
        *quoted(extra),
        f"{parse_datetime_text('mem_date_time')} AS mem_dt",
        f"{kind} AS type",
        f"{tenth('comp_3')} AS bentonite",
        f"{whole('comp_2')} AS new_sand",
        f"{tenth('comp_5')} AS lca",
        f"{tenth('water')} AS water",
    )


def batch_counts() -> dict[str, str]:
    """Totals over readings: all of them, whatever their type, and the bad ones."""
    return {"n_batches": "1", "n_bad": "CASE WHEN type = 'BAD' THEN 1 ELSE 0 END"}


def channel_totals(channels: Sequence[str] = CHANNELS) -> dict[str, str]:
    """Per channel, sum and number of the values in good readings."""
    sums = {f"sum_{c}": f"CASE WHEN type = 'GOOD' THEN `{c}` END" for c in channels}
    counts = {
        f"n_{c}": f"CASE WHEN type = 'GOOD' AND `{c}` IS NOT NULL THEN 1 ELSE 0 END"
        for c in channels
    }
    return {**sums, **counts}


def enrich_intervals(
    slots: DataFrame,
    readings: DataFrame | TotalsOfIntervals,
    start: str = "start_dt",
    end: str = "end_dt",
    by: Sequence[str] = (),
    closed: str = "both",
    channels: Sequence[str] = CHANNELS,
    keys: Sequence[str] = REPORT_KEYS,
    broadcast_rows: int = BROADCAST_INTERVALS,
    stretches: Sequence[str] = STRETCHES,
    collation: str | None = None,
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """One row per different slot, with channel means over good readings and batch counts.

    Slots that agree on ``keys`` merge: means are taken over the readings of all of them, counts
    are the largest. Slots without readings have NULL means and counts of 0. With a ``collation``
    text keys that it holds equal merge, and the spelling that is first bytewise is kept. For
    ``stretches`` see ``interval_totals``.

    Slots are many, and decimals of 38 digits are slow to add and divide. So the sums travel with the
    slots as two whole numbers each, unless one of them is too large for that.
    """
    keys = list(dict.fromkeys([*by, *keys]))
    totals = {**batch_counts(), **channel_totals(channels)}
    wanted = list(dict.fromkeys([*keys, start, end]))
    slots, per_interval = _totals_by_interval(
        slots if slots.columns == wanted else slots.select(*wanted),
        readings,
        start,
        end,
        "mem_dt",
        totals,
        by,
        closed,
        stretches,
    )
    kinds = {name: per_interval.schema[name].dataType.simpleString() for name in totals}
    places = {c: getattr(per_interval.schema[f"sum_{c}"].dataType, "scale", 0) for c in channels}
    sizes = per_interval.agg(
        F.count("*"),
        F.expr("coalesce(sum(_weight), 0)"),
        *(F.expr(f"coalesce(max(abs(`sum_{c}`)), 0)") for c in channels),
    ).first()
    fit = sizes[1] < MOST_ROWS_IN_PARTS and all(
        int(largest * 10 ** places[c]) < MOST_IN_PARTS
        for c, largest in zip(channels, sizes[2:], strict=True)
    )
    counts = [f"n_{c}" for c in channels]
    if fit:
        sums = [f"{part}_{c}" for c in channels for part in ("high", "low")]
        whole = {c: whole_units(f"`sum_{c}`", places[c]) for c in channels}
        parts = {f"high_{c}": high_part(whole[c]) for c in channels}
        parts |= {f"low_{c}": low_part(whole[c]) for c in channels}
        per_interval = with_exprs(per_interval, parts).drop(*(f"sum_{c}" for c in channels))
        kinds |= dict.fromkeys(sums, "bigint")
        means = {
            c: exact_mean_of_parts(f"`high_{c}`", f"`low_{c}`", f"`n_{c}`", places[c], "_small")
            for c in channels
        }
    else:
        sums = [f"sum_{c}" for c in channels]
        means = {c: exact_mean(f"`sum_{c}`", f"`n_{c}`", places[c]) for c in channels}
    joined = _with_totals(
        slots, per_interval, sizes[0], [*by, start, end], closed, broadcast_rows, heavy_rows
    )
    attached = with_exprs(joined, {t: f"coalesce(`{t}`, 0)" for t in [*batch_counts(), *sums, *counts]})
    aggregates = [
        *(f"CAST(sum(`{t}`) AS {kinds[t]}) AS `{t}`" for t in [*sums, *counts]),
        *(f"max(`{t}`) AS `{t}`" for t in batch_counts()),
    ]
    merged = grouped_alike(attached, keys, collation, aggregates, aggregates)
    if fit:
        highs, lows = ([f"`{part}_{c}`" for c in channels] for part in ("high", "low"))
        small = parts_are_small(highs, lows, quoted(counts), max(places.values(), default=0))
        merged = with_exprs(merged, {"_small": small})
    return merged.selectExpr(
        *quoted([*keys, *batch_counts()]), *(f"{means[c]} AS `{c}`" for c in channels)
    )


def grouped_alike(
    df: DataFrame,
    keys: Sequence[str],
    collation: str | None,
    aggregates: Sequence[str],
    merged: Sequence[str],
) -> DataFrame:
    """Group by ``keys``; text keys compare by ``collation`` and keep their first spelling.

    Texts that compare by a collation can only be grouped by sorting rows. So rows are first
    grouped as they are spelled, which takes no sort, and a task sorts one row per spelling.
    ``merged`` puts together the results of ``aggregates`` over several spellings, by their names.
    """
    texts = [c for c in keys if collation and isinstance(df.schema[c].dataType, T.StringType)]
    if not texts:
        return _grouped(df, quoted(keys), aggregates)
    bytewise = {c: f"collate(`{c}`, 'UTF8_BINARY') AS `{c}`" for c in texts}
    spelling = [F.expr(bytewise.get(c, f"`{c}`")) for c in keys]
    df = df.groupBy(*spelling).agg(*map(F.expr, aggregates))
    named = {c: f"collate(`{c}`, '{collation}') AS `_{c}`" for c in texts}
    groups = [F.expr(named.get(c, f"`{c}`")) for c in keys]
    spelled = [f"min(`{c}`) AS `{c}`" for c in texts]
    grouped = df.groupBy(*groups).agg(*map(F.expr, [*spelled, *merged]))
    return grouped.drop(*(f"_{c}" for c in texts))


def collapse_duplicates(
    slots: DataFrame, keys: Sequence[str] = REPORT_KEYS, collation: str | None = None
) -> DataFrame:
    """One row per different slot; quantities are keys and are not added up.

    With a ``collation`` text keys that it holds equal merge, as in ``enrich_intervals``.
    """
    if collation is None:
        return slots.select(*keys).distinct()
    return grouped_alike(slots, keys, collation, ["count(1) AS _n"], ["sum(_n) AS _n"]).select(*keys)
