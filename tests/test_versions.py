"""Versioned tables, change sets, filing of late rows, lines and kept setpoints."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F
from shop_floor import G1_MAP, G1_READINGS, G1_RECORDS, component_map, production, readings, record, sources

from shiftline.operators.changes import row_changes
from shiftline.operators.fill import forward_fill, last_values
from shiftline.plans.dirty import dirty_dates, rebook_dates
from shiftline.plans.job import rebook_versions, skipped
from shiftline.plans.pipeline import Sources, bookings
from shiftline.sources import curated, versions

AS_OF = dt.date(2025, 1, 10)
ROWS = "date string, k int, v double"


def live(spark, path, schema, **options):
    return sorted(map(str, versions.read_version(spark, path, schema, **options).collect()))


def texts(df):
    return sorted(map(str, df.collect()))


def test_readers_see_one_commit(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    old = spark.createDataFrame([("2025-01-01", 1, 1.0), ("2025-01-02", 2, None), (None, 3, 3.0)], ROWS)
    new = spark.createDataFrame([("2025-01-02", 2, 5.0), ("2025-01-03", 4, 4.0)], ROWS)
    assert live(spark, path, old.schema) == []
    versions.commit(old, path, "CAST(date AS DATE)", [])
    before = live(spark, path, old.schema)
    assert before == texts(old)

    # The job dies when everything is written but not yet in place.
    with monkeypatch.context() as broken:
        broken.setattr(versions, "_switch", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            versions.commit(new, path, "CAST(date AS DATE)", ["2025-01-01", "2025-01-02"])
    assert live(spark, path, old.schema) == before
    assert versions.current(spark, path).number == 1

    base = versions.current(spark, path)
    version, n = versions.commit(new, path, "CAST(date AS DATE)", ["2025-01-01", "2025-01-02"])
    assert (version.number, n) == (2, 2)
    assert live(spark, path, old.schema) == texts(new.unionAll(old.where("date IS NULL")))
    assert live(spark, path, old.schema, first=dt.date(2025, 1, 3)) == texts(new.where("k = 4"))
    assert len(live(spark, path, old.schema, first=dt.date(2025, 1, 3), undated=True)) == 2
    assert live(spark, path, old.schema, version=versions.current(spark, path, 1)) == before
    with pytest.raises(RuntimeError):  # computed from a version that is no longer the last
        versions.commit(old, path, "CAST(date AS DATE)", [], base=base)

    with pytest.raises(ValueError):
        versions.current(spark, path, 7)
    assert versions.vacuum(spark, path, keep=1) == 4  # two failed commits, two dates of the first
    assert len(live(spark, path, old.schema)) == 3
    assert versions.vacuum(spark, path, keep=1) == 0


def test_changes(spark):
    def rows(*values):
        return spark.createDataFrame(list(values), "k string, t string, v double, n int")

    before = rows(("a", "x", 1.0, 1), ("a", "x", 1.0, 1), ("b", None, None, 2), ("c", "y", 3.0, 3), ("e", "z", 1.0, 1), ("e", "z", 2.0, 1))
    after = rows(("a", "x", 1.0, 1), ("b", None, None, 2), ("c", "y", 4.0, 3), ("d", "y", 0.0, 0), ("d", "y", 0.0, 0), ("e", "z", 2.0, 1), ("e", "z", 9.0, 1), ("e", "z", 9.5, 1))
    found = {(r.change, r.k, r.v, r.n_removed, r.n_added) for r in row_changes(before, after, ["k", "t"]).collect()}
    assert found == {
        ("delete", "a", 1.0, 1, 0),
        ("update", "c", 4.0, 1, 1),
        ("insert", "d", 0.0, 0, 2),
        ("update", "e", 9.0, 1, 1),
        ("insert", "e", 9.5, 0, 1),
    }
    assert row_changes(before, before, ["k", "t"]).count() == 0
    assert row_changes(before.limit(0), after, ["k", "t"]).where("change <> 'insert'").count() == 0


def test_cycles_write_what_changed(spark, tmp_path):
    def tables(poured):
        third = record(3, "10.01.25", "00:10:00", "09:00:00", (1, "08:30:00", "PX-1", 45, poured, 1))
        return sources(spark, (*G1_RECORDS[:2], third))

    path = str(tmp_path / "bookings")
    expected = bookings(tables(44), AS_OF)
    first = rebook_versions(tables(44), path, AS_OF)
    n = expected.count()
    assert first == {"version": 1, "rows": n, "insert": n, "update": 0, "delete": 0}
    assert live(spark, path, expected.schema) == texts(expected)
    again = rebook_versions(tables(44), path, AS_OF)
    assert again == {"version": 1, "rows": 0, "insert": 0, "update": 0, "delete": 0}

    # A record of the 10th is corrected: the 9th is not written again.
    folder = versions.current(spark, path).folders["2025-01-09"]
    counts = rebook_versions(tables(40), path, AS_OF)
    assert (counts["version"], counts["insert"], counts["update"], counts["delete"]) == (2, 0, 1, 0)
    assert counts["rows"] == expected.where("date = '2025-01-10'").count() < n
    assert live(spark, path, expected.schema) == texts(bookings(tables(40), AS_OF))
    assert versions.current(spark, path).folders["2025-01-09"] == folder
    schema = spark.createDataFrame([], "change string, noOfBoxesPoured long").schema
    (change,) = versions.read_table(spark, path, "changes", schema).collect()
    assert (change.change, change.noOfBoxesPoured) == ("update", 40)


def test_setpoints_go_on_across_cycles(spark, tmp_path):
    """Readings of the 9th alone; the 12th inherits its setpoints from the version before."""
    path = str(tmp_path / "bookings")
    more = record(4, "12.01.25", "08:00:00", "15:00:00", (1, "09:00:00", "PX-1", 30, 30, 0))
    tables = sources(spark, (*G1_RECORDS, more))
    rebook_versions(tables, path, AS_OF)
    rebook_versions(tables, path, dt.date(2025, 1, 12), window_days=0)
    whole = bookings(tables, dt.date(2025, 1, 12), 30)
    assert live(spark, path, whole.schema) == texts(whole)
    assert whole.where("date = '2025-01-12' AND bentoniteSetPoint IS NOT NULL").count() == 1


@pytest.mark.parametrize("line", ["line"])
def test_only_dirty_dates_are_booked_again(spark, tmp_path, line):
    """Ten days with a slot each and readings on some; a late reading reaches as far as its fill."""
    days = [f"{d:02d}.02.25" for d in range(1, 11)]
    records = [
        record(n, day, "08:00:00", "15:00:00", (1, "09:00:00", "PX-1", 30, 30, 0))
        for n, day in enumerate(days)
    ]
    rows = [(f"{day[:6]}2025 10:00:00", "GOOD", n, n, n, n) for n, day in enumerate(days) if n in (0, 1, 5, 8)]
    tables = production(spark, *records), readings(spark, *rows)
    extra = [F.lit(7).cast("long").alias("line")] if line else []
    tables = [
        tables[0].select("*", *extra),
        tables[1].select("*", F.monotonically_increasing_id().alias("n"), *extra),
    ]
    paths = [str(tmp_path / name) for name in ("records", "readings", "bookings")]
    schemas = tables[0].schema, tables[1].schema
    mapping = component_map(spark, *G1_MAP)
    curated.file_rows(tables[0], paths[0], curated.RECORD_DATE, "id")
    curated.file_rows(tables[1], paths[1], curated.READING_DATE, "n")
    load = curated.filed_dates(spark, *paths[:2], schemas, mapping)
    plain = curated.filed_sources(spark, *paths[:2], schemas, mapping, dt.date(2025, 2, 10), 30)
    first = rebook_versions(plain, paths[2], dt.date(2025, 2, 10), 30, line=line)
    assert first["rows"] == 10
    before = dict(versions.current(spark, paths[2]).folders)

    late = readings(spark, ("03.02.2025 09:30:00", "GOOD", 90, 90, 90, 90)).select(
        "*", F.lit(10**12).alias("n"), *extra
    )
    filed = curated.file_rows(late, paths[1], curated.READING_DATE, "n")
    dates = dirty_dates([], filed["dates"])
    assert dates == {"2025-02-02", "2025-02-03"}
    found = rebook_dates(load, paths[2], dates, line=line)
    # The 6th has readings of its own; what lies between inherits.
    after = dict(versions.current(spark, paths[2]).folders)
    assert {d for d in after if after[d] != before[d]} == {"2025-02-03", "2025-02-04", "2025-02-05"}
    assert (found["version"], found["rows"], found["update"], found["booked"]) == (2, 3, 3, 5)
    plain = curated.filed_sources(spark, *paths[:2], schemas, mapping, dt.date(2025, 2, 10), 30)
    whole = bookings(plain, dt.date(2025, 2, 10), 30, line=line)
    assert live(spark, paths[2], whole.schema) == texts(whole)

    # A record that moves leaves its date empty.
    moved = production(spark, records[9] | {"date_begin": "14.02.25"}).select("*", *extra)
    filed = curated.file_rows(moved, paths[0], curated.RECORD_DATE, "id")
    found = rebook_dates(load, paths[2], dirty_dates(filed["dates"], []), line=line)
    assert (found["insert"], found["delete"], found["version"]) == (1, 1, 3)
    rows = versions.read_version(spark, paths[2], whole.schema)
    assert rows.count() == 10 and rows.where("date = '2025-02-14' AND bentoniteSetPoint = 0.8").count() == 1
    assert "2025-02-10" not in versions.current(spark, paths[2]).folders


def test_seeds_and_lasts(spark):
    rows = [("a", 1, None), ("a", 2, 5.0), ("a", 3, None), ("b", 1, None), (None, 1, None), ("c", 9, None)]
    df = spark.createDataFrame(rows, "line string, at int, v double")
    seed = spark.createDataFrame([("a", 1.0), ("b", 2.0), (None, 3.0)], "line string, v double")
    for strategy in ("window", "two_phase"):
        found = forward_fill(df, ["v"], ["at"], ["line"], strategy, seed).collect()
        assert {(r.line, r.at): r.v for r in found} == {
            ("a", 1): 1.0, ("a", 2): 5.0, ("a", 3): 5.0, ("b", 1): 2.0, (None, 1): 3.0, ("c", 9): None,
        }
    one = forward_fill(df.where("line = 'a'"), ["v"], ["at"], seed=seed.where("line = 'b'").select("v"))
    assert [r.v for r in one.orderBy("at").collect()] == [2.0, 5.0, 5.0]
    lasts = {r.line: r.v for r in last_values(df, ["v"], ["at"], ["line"]).collect()}
    assert lasts == {"a": 5.0, "b": None, None: None, "c": None}


def test_lines_are_booked_apart(spark):
    """Two lines in one run give what each gives alone."""
    lines = []
    for line, readings_of in ((1, G1_READINGS), (2, [(at, k, 7, 1, 2, 3) for at, k, *_ in G1_READINGS[:1]])):
        tables = (production(spark, *G1_RECORDS), readings(spark, *readings_of))
        lines.append([t.withColumn("line", F.lit(line).cast("long")) for t in tables])
    both = Sources(lines[0][0].unionAll(lines[1][0]), lines[0][1].unionAll(lines[1][1]), component_map(spark, *G1_MAP))
    found = bookings(both, AS_OF, line="line")
    alone = [bookings(Sources(*own, both.component_map), AS_OF, line_id=i) for i, own in enumerate(lines, 1)]
    assert texts(found) == texts(alone[0].unionAll(alone[1]))


def test_filing_late_rows(spark, tmp_path):
    path = str(tmp_path / "records")
    schema = production(spark).schema
    file = lambda *rows: curated.file_rows(production(spark, *rows), path, curated.RECORD_DATE, "id")
    unreadable = record(9, "soon", "08:00:00", None, (1, "09:00:00", "PX-1", 5, 5, 0))
    assert file(*G1_RECORDS, unreadable) == {
        "version": 1, "dates": ["2025-01-09", "2025-01-10", "undated"], "rows": 4,
    }
    # One late row of a filed date, one that moves to another, one without a number.
    late = record(7, "09.01.25", "08:00:00", "10:00:00", (1, "09:00:00", "PX-1", 5, 5, 0))
    moved = G1_RECORDS[2] | {"date_begin": "11.01.25"}
    nameless = record(None, "10.01.25", "08:00:00", "10:00:00")
    assert file(late, late, moved, nameless) == {
        "version": 2, "dates": ["2025-01-09", "2025-01-10", "2025-01-11"], "rows": 5,
    }
    wanted = production(spark, *G1_RECORDS[:2], unreadable, late, moved, nameless)
    assert live(spark, path, schema) == texts(wanted)
    assert live(spark, path, schema, first=dt.date(2025, 1, 11)) == texts(production(spark, moved))
    assert file() == {"version": 2, "dates": [], "rows": 0}
    # Of several rows with one number the newest counts.
    newer = [G1_RECORDS[2] | {"time_end": t} for t in ("09:30:00", "08:30:00")]
    curated.file_rows(production(spark, *newer), path, curated.RECORD_DATE, "id", newest="time_end")
    assert [r.time_end for r in versions.read_version(spark, path, schema).where("id = 3").collect()] == ["09:30:00"]

    # What is skipped is the same as over plain tables, unreadable dates included.
    readings_path = str(tmp_path / "readings")
    plain = Sources(versions.read_version(spark, path, schema), readings(spark, *G1_READINGS), component_map(spark, *G1_MAP))
    curated.file_rows(plain.readings.withColumn("n", F.monotonically_increasing_id()), readings_path, curated.READING_DATE, "n")
    filed = curated.filed_sources(
        spark, path, readings_path, (schema, plain.readings.schema), plain.component_map, AS_OF
    )
    assert texts(skipped(filed, AS_OF)) == texts(skipped(plain, AS_OF))
    assert any("date_begin" in t for t in texts(skipped(filed, AS_OF)))
    assert texts(bookings(filed, AS_OF)) == texts(bookings(plain, AS_OF))
