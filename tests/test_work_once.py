"""Work that is done once, or for few rows only: per name, per repeated key."""

import datetime as dt
import sys
from dataclasses import replace
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from shop_floor import G1_MAP, record, sources
from pyspark.sql import functions as F
from test_plans import _explained

from shiftline.operators.changes import row_changes
from shiftline.operators.lookup import resolve_component
from shiftline.operators.ordered import written
from shiftline.plans.job import skipped
from shiftline.sources.curated import _newest


def test_skipped_works_slots_out_once(spark):
    runs = spark.sparkContext.accumulator(0)
    given = sources(
        spark,
        (
            record(1, "09.01.25", "08:00:00", "16:00:00", (1, "08:00:00", "PX-9", 5, 5, 0), (2, "09:00:00", "PX-1", 5, 5, 0), (3, "xx", "PX-1", 5, 5, 0)),
            record(2, "09.01.25", "08:00:00", "zz", (1, "08:00:00", "PX-9", 5, 5, 0), (2, "07:00:00", None, 5, 5, 0)),
            record(3, "01.01.25", "08:00:00", "xx", (1, "08:00:00", "PX-8", 5, 5, 0)),
            record(4, "nothing", "08:00:00", "16:00:00", (1, "08:00:00", "PX-8", 5, 5, 0)),
        ),
        mapping=(*G1_MAP, ("PX-9", 1)),
    )
    @F.udf("string")
    def seen(text):
        runs.add(1)
        return text

    production = given.production.withColumn("date_begin", seen.asNondeterministic()("date_begin"))
    given = replace(given, production=production)
    given = replace(given, component_map=given.component_map.where("Component <> 'PX-9'"))
    rows = [tuple(r) for r in skipped(given, dt.date(2025, 1, 10)).collect()]
    expected = [
        ("unmapped", "PX-9", 1), ("begin", None, 1), ("date_begin", None, 1), ("time_end", None, 1),
    ]
    assert sorted(rows, key=str) == sorted(expected, key=str)
    assert runs.value == 4


def test_unmapped_names_with_two_ids_count_twice(spark):
    """As in the bookings, where a slot has a row per id."""
    given = sources(
        spark,
        (record(1, "09.01.25", "08:00:00", "16:00:00", (1, "08:00:00", "PX-9", 5, 5, 0)),),
    )
    ids = "Component string, ComponentID string"
    both = spark.createDataFrame([("PX-9", "a"), ("PX-9", "b"), ("PX-9", None)], ids)
    rows = skipped(replace(given, component_map=both), dt.date(2025, 1, 10)).collect()
    assert [tuple(r) for r in rows] == [("unmapped", "PX-9", 3)]


def test_ids_are_read_as_numbers_once(spark):
    slots = spark.createDataFrame([("a",)], "component string")
    mapping = spark.createDataFrame([("a", "5")], "Component string, ComponentID string")
    plan = _explained(resolve_component(slots, mapping).where("component_id IS NOT NULL"), "simple")
    assert "try_cast(coalesce(_id" not in plan and "THEN _number" in plan


def test_ids_of_every_kind(spark):
    slots = spark.createDataFrame([(n,) for n in (" a", "b", "c", "12", "1e2", "7D", None)], "component string")
    ids = [("a", "5"), ("a", "x"), ("b", None), ("c", "2.9"), ("12", "oops")]
    mapping = spark.createDataFrame(ids, "Component string, ComponentID string")
    expected = {
        (" a", "5", 5), (" a", "x", None), ("b", "b", None), ("c", "2.9", 2), ("12", "oops", None),
        ("1e2", "1e2", 100), ("7D", "7D", None), (None, None, None),
    }
    found = resolve_component(slots, mapping)
    assert found.columns == ["component", "component_key", "component_id"]
    assert {tuple(r) for r in found.collect()} == expected
    strict = {tuple(r) for r in resolve_component(slots, mapping, strict=True).collect()}
    assert strict == {r if r[0] != "1e2" else ("1e2", "1e2", None) for r in expected}


def test_rows_with_a_key_of_their_own_stay_where_they_are(spark):
    rows = written(spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (None, "c")], "k int, v string"))
    assert "Aggregate" not in _explained(_newest(rows, "k", None), "simple")
    more = written(rows.unionAll(spark.createDataFrame([(2, "c"), (2, "a")], "k int, v string")))
    found = sorted((tuple(r) for r in _newest(more, "k", None).collect()), key=str)
    assert found == [(1, "a"), (2, "c"), (None, "c"), (None, "c")]
    found = sorted((tuple(r) for r in _newest(more, "k", "v <> 'c'").collect()), key=str)
    assert found == [(1, "a"), (2, "b"), (None, "c"), (None, "c")]


def test_changes_are_dealt_by_key_once(spark):
    before = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], "k int, v string")
    after = spark.createDataFrame([(1, "c"), (2, "a"), (2, "a")], "k int, v string")
    changes = row_changes(before, after, ["k"])
    assert _explained(changes, "simple").count("Exchange hashpartitioning") == 2
    assert {(r.change, r.k, r.v) for r in changes.collect()} == {
        ("update", 1, "c"), ("delete", 1, "b"), ("insert", 2, "a"),
    }
