"""Totals of points that are kept between runs: new points update them, intervals probe them.

A kept table has three levels. Per key there is one row for every instant with points, one for every
minute and one for every day. Instants and minutes lie in folders by date, days in one small table
that also holds their running totals. New points rewrite the dates they belong to and the days;
intervals read the days, and of the other levels the dates on which they start and end. Points that
are in the table are never read again. Every update is one version: readers see all of it or nothing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shiftline.functions import listed, quoted
from shiftline.operators.intervals import (
    STRETCHES,
    _grouped,
    _stretch,
    _sum_of,
    batch_counts,
    between_bounds,
    channel_totals,
    instant_totals,
    interval_bounds,
    normalise_readings,
)
from shiftline.operators.ordered import run_folder, written
from shiftline.sources.versions import Version, commit, current, read_version

DAYS = "days"
MINUTES = "minutes-"  # before the date in the names of the minutes' folders
UPTO = "upto_"
_CUTS = [f"_{unit}" for unit in STRETCHES]
_DATE = "to_date(_instant)"


def update_totals(
    points: DataFrame,
    path: str,
    ts: str,
    totals: Mapping[str, str],
    by: Sequence[str] = (),
    replaced: Iterable[str] = (),
) -> dict[str, int | list[str]]:
    """Add ``points`` to the totals kept below ``path``; the first call makes the table.

    ``ts``, ``totals`` and ``by`` are as in ``intervals.interval_totals``. Points may be late: those of
    a date that has totals are added to them. Dates in ``replaced`` (as ISO text) lose their totals
    first, so ``points`` must then hold all of these dates' points; that is how corrections enter, and
    how a batch that may come twice is made repeatable. Points without an instant count nowhere, and
    those whose ``by`` is NULL meet no interval. Without points and ``replaced`` a table that exists
    stays as it is. Returns the version, the dates written and the rows of instants and minutes.
    """
    spark = points.sparkSession
    base = current(spark, path)
    gone = set(replaced)
    with run_folder(spark):
        kinds, instants = instant_totals(points, ts, totals, by)
        new = written(instants)
        _check_same(spark, path, base, new, by, kinds)
        # The number of dates is all that comes to the driver.
        dates = {r.d for r in new.selectExpr(f"date_format({_DATE}, 'yyyy-MM-dd') AS d").distinct().collect()}
        if base.number and not dates and not gone:
            return {"version": base.number, "dates": [], "rows": 0}
        there = read_version(spark, path, new.schema, dates=dates - gone, version=base)
        merged = written(_sums(new.unionByName(there), [*by, "_instant"], kinds))
        # The first instant of a minute stands for it; cutting the instant itself off would go
        # through the session's time zone.
        in_minutes = merged.selectExpr("*", f"{_stretch('minute', '_instant')} AS _minute")
        minutes = _grouped(
            in_minutes, [*by, "_minute"], ["min(_instant) AS _instant", *_sum_texts(kinds)]
        )
        rows = merged.selectExpr("'' AS _level", *quoted(merged.columns)).unionByName(
            minutes.selectExpr(f"'{MINUTES}' AS _level", *quoted(merged.columns))
        )
        touched = dates | gone
        version, n = commit(
            rows,
            path,
            _DATE,
            [*touched, *(MINUTES + d for d in touched)],
            {DAYS: _days(spark, path, base, merged, by, kinds, touched)},
            base,
            prefix="_level",
        )
    return {"version": version.number, "dates": sorted(touched), "rows": n}


def _sums(rows: DataFrame, keys: Sequence[str], kinds: Mapping[str, str]) -> DataFrame:
    return _grouped(rows, keys, _sum_texts(kinds))


def _sum_texts(kinds: Mapping[str, str]) -> list[str]:
    return [f"CAST(sum(`{t}`) AS {kind}) AS `{t}`" for t, kind in kinds.items()]


def _days(
    spark: SparkSession,
    path: str,
    base: Version,
    merged: DataFrame,
    by: Sequence[str],
    kinds: Mapping[str, str],
    touched: set[str],
) -> DataFrame:
    """One row per key and day, with the totals of the day and those up to its end."""
    days = _sums(merged.selectExpr("*", f"{_stretch('day', '_instant')} AS _day"), [*by, "_day"], kinds)
    if DAYS in base.tables:
        renewed = [(dt.date.fromisoformat(d) - dt.date(1970, 1, 1)).days for d in touched]
        kept = spark.read.parquet(f"{path}/{base.tables[DAYS]}").where(~F.col("_day").isin(renewed))
        days = days.unionByName(kept.select(*days.columns))
    keys = f"PARTITION BY {listed(by)} " if by else ""
    over = f"OVER ({keys}ORDER BY _day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return days.selectExpr(
        "*", *(f"CAST(sum(`{t}`) {over} AS {kind}) AS `{UPTO}{t}`" for t, kind in kinds.items())
    )


def _days_schema(spark: SparkSession, path: str, version: Version) -> StructType:
    return spark.read.parquet(f"{path}/{version.tables[DAYS]}").schema


def _check_same(
    spark: SparkSession,
    path: str,
    base: Version,
    new: DataFrame,
    by: Sequence[str],
    kinds: Mapping[str, str],
) -> None:
    if not base.number:
        return
    there = {f.name: f.dataType.simpleString() for f in _days_schema(spark, path, base)}
    given = {c: new.schema[c].dataType.simpleString() for c in [*by, *kinds]}
    kept = {c: t for c, t in there.items() if c != "_day" and not c.startswith(UPTO)}
    if kept != given:
        raise ValueError(f"{path} keeps {kept}, not {given}")


@dataclass(frozen=True)
class KeptTotals:
    """The totals kept below ``path``, in place of the points; of one version, if given."""

    spark: SparkSession
    path: str
    version: Version | None = None

    def interval_totals(
        self, intervals: DataFrame, start: str, end: str, by: Sequence[str] = (), closed: str = "both"
    ) -> DataFrame:
        """Add to every distinct interval the totals of the points inside it.

        As ``intervals.interval_totals`` over all points that were added. ``by`` must be what the
        totals were kept by. This writes ``intervals``, which are read for the dates they touch and
        for their ends.
        """
        if closed not in ("both", "left", "right", "neither"):
            raise ValueError(f"unknown closed {closed!r}")
        version = self.version or current(self.spark, self.path)
        if DAYS not in version.tables:
            raise ValueError(f"no totals are kept in {self.path}")
        schema = _days_schema(self.spark, self.path, version)
        kinds = {
            f.name.removeprefix(UPTO): f.dataType.simpleString()
            for f in schema
            if f.name.startswith(UPTO)
        }
        kept_by = [c for c in schema.names if c != "_day" and c not in kinds and not c.startswith(UPTO)]
        if set(kept_by) != set(by):
            raise ValueError(f"totals are kept by {kept_by}, not by {list(by)}")
        intervals = written(intervals)
        bounds = interval_bounds(intervals, start, end, closed, STRETCHES)
        touched = bounds.selectExpr(f"date_format({_DATE}, 'yyyy-MM-dd') AS d").distinct()
        dates = {r.d for r in touched.collect()}
        instant = intervals.select(start).schema[0].dataType
        level = StructType([schema[c] for c in by]).add("_instant", instant)
        for t in kinds:
            level.add(schema[t])
        units = [f"{_stretch(unit, '_instant')} AS `_{unit}`" for unit in STRETCHES]

        def rows(prefix: str) -> DataFrame:
            names = {prefix + d for d in dates if d is not None}
            read = read_version(self.spark, self.path, level, dates=names, version=version)
            return read.selectExpr("*", *units)

        days = self.spark.read.schema(schema).parquet(f"{self.path}/{version.tables[DAYS]}")
        carried = _carried(rows(MINUTES), days, bounds, by, kinds)
        return between_bounds(intervals, bounds, rows(""), carried, by, kinds, _CUTS)


def _carried(
    minutes: DataFrame, days: DataFrame, bounds: DataFrame, by: Sequence[str], kinds: Mapping[str, str]
) -> DataFrame:
    """What came before each minute that holds a point or a bound, on the dates of the bounds."""
    where = quoted([*by, *_CUTS])
    empty = [f"CAST(0 AS {kind}) AS `{t}`" for t, kind in kinds.items()]
    wanted = bounds.selectExpr(*where).where("_day IS NOT NULL").distinct()
    both = minutes.selectExpr(*where, *quoted(kinds)).unionByName(wanted.selectExpr("*", *empty))
    per_minute = _sums(both, [*by, *_CUTS], kinds)
    earlier = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    inside = f"OVER (PARTITION BY {listed([*by, '_day'])} ORDER BY _minute {earlier})"
    # Days that have totals, and between them the days of the bounds, which take the last before.
    upto = ", ".join(f"'{t}', `{UPTO}{t}`" for t in kinds)
    known = days.selectExpr(*quoted([*by, "_day"]), f"named_struct({upto}) AS _upto", "false AS _asked")
    asked = wanted.select(*by, "_day").distinct().selectExpr("*", "true AS _asked")
    keys = f"PARTITION BY {listed(by)} " if by else ""
    # A day's own row comes after the question for what was before it.
    last = f"last(_upto, true) OVER ({keys}ORDER BY _day, NOT _asked {earlier}) AS _upto"
    before = (
        known.unionByName(asked, allowMissingColumns=True)
        .selectExpr(*quoted([*by, "_day"]), "_asked", last)
        .where("_asked")
        .drop("_asked")
    )
    running = per_minute.selectExpr(
        *where, *(f"CAST(sum(`{t}`) {inside} AS {kind}) AS `{t}`" for t, kind in kinds.items())
    )
    return running.join(before, [*by, "_day"], "left").selectExpr(
        *quoted([*by, _CUTS[0]]),
        *(f"{_sum_of(f'`{t}`', f'_upto.`{t}`', kind)} AS `carried_{t}`" for t, kind in kinds.items()),
    )


def keep_readings(
    readings: DataFrame,
    path: str,
    line: str | None = None,
    collation: str | None = None,
    replaced: Iterable[str] = (),
) -> dict[str, int | list[str]]:
    """Update kept totals with raw readings, as the booking job adds them up; see ``update_totals``.

    ``KeptTotals`` below ``path`` then stands in for the readings in ``pipeline.Sources``.
    """
    by = [line] if line else []
    points = normalise_readings(readings, by, collation)
    return update_totals(points, path, "mem_dt", {**batch_counts(), **channel_totals()}, by, replaced)
