"""What cycles that book most dates twice do only once, or for the dates that they book."""

import datetime as dt
import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F
from shop_floor import record, sources
from test_plans import _explained
from test_scale_paths import same_rows

from shiftline.operators.changes import row_changes
from shiftline.operators.fill import fill_by_stretch, forward_fill, last_values
from shiftline.operators.lookup import resolve_component
from shiftline.operators.ordered import is_stored, written
from shiftline.plans import pipeline
from shiftline.plans.job import rebook, rebook_versions
from shiftline.plans.pipeline import bookings
from shiftline.sources import curated, versions


def _sparse(spark):
    rng = random.Random(3)
    rows = [
        (
            i,
            rng.choice(["a", "b", None]),
            dt.date(2025, 1, 1 + i // 60),
            rng.choice([None, "", "08:00", "08:01", "23:59"]),
            rng.choice([None] * 9 + [float(i)]),
            float(i) if i % 97 == 50 else None,
        )
        for i in range(400)
    ]
    return spark.createDataFrame(rows, "i int, line string, day date, at string, u double, v double")


@pytest.mark.parametrize("by", [[], ["line"]])
@pytest.mark.parametrize("seeded", [False, True])
def test_stretches_fill_as_one_window(spark, by, seeded):
    df, cols, order = _sparse(spark), ["u", "v"], ["day", "at", "i"]
    seed = None
    if seeded:
        seed = spark.createDataFrame([("a", -1.0, -2.0), (None, -3.0, None)], "line string, u double, v double")
        seed = seed if by else seed.where("line = 'a'").select(*cols)
    filled, lasts = fill_by_stretch(df, cols, order, ["day", "left(at, 2)", "at"], by, seed)
    plain = forward_fill(df, cols, order, by, "window", seed)
    assert filled.columns == df.columns
    assert same_rows(filled, plain)
    expected = last_values(plain, cols, order, ["day", *by])
    assert same_rows(lasts.withColumnRenamed("_stretch_0", "day"), expected)
    nothing, none = fill_by_stretch(df.limit(0), cols, order, ["day", "at"], by, seed)
    assert nothing.count() == none.count() == 0


AS_OF = dt.date(2025, 1, 20)
DAYS = [
    record(
        d, f"{d:02d}.01.25", "16:00:00", None,
        (1, "17:00:00", "PX-1", 30, 30, 0), (2, "23:00:00", "PX-2", 30, 30, 0), (3, "18:00:00", "PX-9", 30, 30, 0),
    )
    for d in range(8, 23)
]
READ = [
    # The last reading of all before the window lies in a slot without an id.
    ("10.01.2025 17:30:00", "GOOD", 10, 20, 30, 40),
    ("12.01.2025 23:30:00", "GOOD", 50, 60, 70, None),
    ("14.01.2025 18:30:00", "GOOD", 5, 6, 7, 8),
    ("19.01.2025 17:30:00", "GOOD", None, 9, 9, 9),
]


@pytest.mark.parametrize("line", [None, "line"])
def test_lookback_only_hands_its_setpoints_on(spark, tmp_path, monkeypatch, line):
    given = sources(spark, DAYS, READ)
    if line:
        own = {"line": F.lit(1).cast("long")}
        given = pipeline.Sources(
            given.production.withColumn("line", F.when(F.col("id") % 2 == 0, 1).otherwise(2).cast("long")),
            given.readings.withColumns(own),
            given.component_map,
        )
    whole = bookings(given, AS_OF, 30, line=line, fill_strategy="window").where("date >= '2025-01-18'")
    assert whole.where("date = '2025-01-18' AND waterSetPoint = 4 AND newSandSetPoint = 60").count() > 0
    seen, plain = [], pipeline.fill_by_stretch

    def spied(df, *args):
        seen.append(df.agg(F.min("production_date")).first()[0])
        return plain(df, *args)

    monkeypatch.setattr(pipeline, "fill_by_stretch", spied)
    path = str(tmp_path / "bookings")
    rebook(given, path, AS_OF, lookback_days=30, line=line)
    assert seen == [dt.date(2025, 1, 18)]
    found = spark.read.parquet(path).withColumn("date", F.col("date").cast("string"))
    assert same_rows(found.select(*whole.columns), whole)
    # A seed counts for what no earlier row has.
    if not line:
        seed = spark.createDataFrame([(7.0, 7.0, 7.0, 7.0)], "bentonite double, new_sand double, lca double, water double")
        late = dt.date(2025, 1, 12)
        options = {"seed": seed, "fill_strategy": "window"}
        expected = bookings(given, AS_OF, 30, **options).where("date >= '2025-01-12'")
        assert same_rows(bookings(given, AS_OF, 30, seed=seed, first=late), expected)


def test_a_large_lookup_comes_down_to_the_names(spark):
    slots = written(
        spark.createDataFrame([(n,) for n in (" a", "b", "c", "12", "1e2", "7D", None, "b", "B")], "component string")
    )
    ids = [("a", "5"), ("a", "x"), ("b", None), ("c", "2.9"), ("12", "oops")]
    large = spark.createDataFrame([*ids, *((f"n{i}", f"{i}") for i in range(2_000))], "Component string, ComponentID string")
    for options in ({}, {"strict": True}, {"collation": "UTF8_LCASE"}):
        plain = resolve_component(slots, large, **options)
        found = resolve_component(slots, large, broadcast_bytes=20_000, names=slots, **options)
        plan = _explained(found, "simple")
        assert "BroadcastHashJoin" in plan and "_salt" not in plan and "try_cast" not in plan
        assert found.columns == plain.columns
        assert same_rows(found, plain)
    many = resolve_component(slots, large, broadcast_bytes=0, names=slots)
    assert same_rows(many, resolve_component(slots, large))


def test_written_tables_are_not_written_again(spark):
    table = written(spark.range(3))
    assert written(table) is table
    assert written(table.where("id > 0")).inputFiles() != table.inputFiles()


def test_what_has_nothing_before_is_shuffled_once(spark):
    after = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "k int, v string")
    found = row_changes(None, after, ["k"])
    assert _explained(found, "simple").count("Exchange hashpartitioning") == 1
    expected = row_changes(after.limit(0), after, ["k"])
    assert found.columns == expected.columns
    assert [f.dataType for f in found.schema] == [f.dataType for f in expected.schema]
    assert same_rows(found, expected)


def test_changes_are_written_where_they_are_kept(spark, tmp_path, monkeypatch):
    path, kept = str(tmp_path / "bookings"), []
    plain = versions.commit
    import shiftline.plans.job as job

    def spied(rows, at, date, replaced, tables, *args, **kwargs):
        kept.append(sorted(name for name, table in tables.items() if table is not None))
        return plain(rows, at, date, replaced, tables, *args, **kwargs)

    monkeypatch.setattr(job, "commit", spied)
    given = sources(spark, DAYS, READ)
    first = rebook_versions(given, path, AS_OF, 30)
    assert kept == [["setpoints"]]
    schema = spark.createDataFrame([], "change string, date string, n_removed long, n_added long").schema
    changes = versions.read_table(spark, path, "changes", schema)
    assert changes.groupBy("change").count().collect() == [("insert", first["insert"])]
    # A cycle without changes leaves nothing behind.
    before = sorted(p.name for p in (tmp_path / "bookings" / "data").iterdir())
    again = rebook_versions(given, path, AS_OF, 30)
    assert (again["version"], again["rows"]) == (1, 0)
    assert sorted(p.name for p in (tmp_path / "bookings" / "data").iterdir()) == before


def test_rows_of_files_are_filed_without_a_copy(spark, tmp_path, monkeypatch):
    spark.createDataFrame(
        [(1, "09.01.25", "a"), (2, "10.01.25", "b"), (2, "10.01.25", "c"), (None, "x", "d")],
        "id int, date_begin string, more string",
    ).write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    assert is_stored(rows) and is_stored(rows.where("id > 1").select("more"))
    assert not is_stored(rows.selectExpr("id + 1 AS id"))
    assert not is_stored(rows.where("rand() < 0.5"))
    assert not is_stored(rows.distinct())
    copied, plain = [], curated.written

    def spied(df):
        copied.append(df.columns)
        return plain(df)

    monkeypatch.setattr(curated, "written", spied)
    once = rows.where("id = 1 OR id IS NULL")
    path = str(tmp_path / "filed")
    assert curated.file_rows(once, path, curated.RECORD_DATE, "id")["rows"] == 2
    assert rows.columns not in copied
    assert curated.file_rows(rows.where("id = 2"), path, curated.RECORD_DATE, "id")["rows"] == 1
    found = versions.read_version(spark, path, rows.schema, undated=True)
    assert sorted(map(str, found.collect())) == sorted(
        map(str, [*once.collect(), *rows.where("more = 'c'").collect()])
    )
