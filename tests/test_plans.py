"""What plans do not do: run twice, outgrow the JVM's compiler, or sort rows that could be hashed."""

import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F

from shiftline.functions.text_time import parse_date, parse_datetime_text
from shiftline.operators.booking import RESULT_COLUMNS, REPORT_ORDER, report_rows
from shiftline.operators.intervals import grouped_alike
from shiftline.operators.ordered import pinned_ranges, written
from shiftline.operators.split import split_at_boundary
from shiftline.plans.pipeline import slot_intervals

from __spark_entry__ import _plain
from shiftline.sources.derived import _wide_records

MOST_COMPILED = 8000  # bytes of a method that the JVM still compiles


def _explained(df, mode):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def _records(spark):
    events = spark.range(300).selectExpr(
        "id AS event_id", "timestampadd(MINUTE, CAST(id * 97 AS INT), TIMESTAMP_NTZ'2024-01-05') AS ts"
    )
    return written(_wide_records(events))


def test_split_slots_are_compiled(spark):
    pieces = _plain(split_at_boundary(slot_intervals(_records(spark))))
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", _explained(pieces, "codegen"))]
    assert sizes and max(sizes) <= MOST_COMPILED


def _counted(df, runs, column):
    @F.udf("long")
    def seen(value):
        runs.add(1)
        return value

    return df.withColumn(column, seen.asNondeterministic()(column))


def test_ranges_run_the_plan_once(spark):
    runs = spark.sparkContext.accumulator(0)
    rows = pinned_ranges(_counted(spark.range(500), runs, "id"), [("id", "ASC")])
    assert rows.count() == 500
    assert runs.value == 500


def test_report_runs_the_plan_once(spark):
    runs = spark.sparkContext.accumulator(0)
    names = {*RESULT_COLUMNS.values(), *REPORT_ORDER} - {"moulded", "production_date"}
    rows = spark.range(500).selectExpr(
        "id AS moulded", "DATE'2024-01-05' AS production_date", *(f"'x' AS `{c}`" for c in names)
    )
    assert len(report_rows(_counted(rows, runs, "moulded")).collect()) == 500
    assert runs.value == 500


def test_spellings_are_hashed_before_they_are_sorted(spark):
    rows = spark.createDataFrame(
        [("Ab", 1), ("aB", 2), ("ab", 3), ("Ab", 4), ("c", 5), (None, 6), (None, 7)],
        "name string, n long",
    )
    aggregates = ["count(1) AS rows", "sum(n) AS n"]
    merged = ["sum(rows) AS rows", "sum(n) AS n"]
    grouped = grouped_alike(rows, ["name"], "UTF8_LCASE", aggregates, merged)
    found = {(r["name"], r["rows"], r["n"]) for r in grouped.collect()}
    assert found == {("Ab", 4, 10), ("c", 1, 5), (None, 2, 13)}
    assert "HashAggregate" in _explained(grouped, "simple")


def test_parts_of_dates_without_patterns(spark):
    texts = ["05.01.24", "5.1.24", "5.1", "5", "", "5.1.24.7", ".1.24", "5.1.", None, "5..24"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    year = "try_cast(split_part(t, '.', 3) AS INT)"
    date = (
        f"try_cast(concat(CASE WHEN {year} BETWEEN 0 AND 99 THEN ({year} + 30) % 100 + 1970 END, '-', "
        "split_part(t, '.', 2), '-', split_part(t, '.', 1)) AS DATE)"
    )
    parsed = df.selectExpr("t", f"{parse_date('t')} AS got", f"{date} AS want")
    assert [r for r in parsed.collect() if r.got != r.want] == []
    assert "split" not in parse_date("t") + parse_datetime_text("t")
