"""Readers, the partitioned sink, the job and the stream."""

import datetime as dt

import pytest
from shop_floor import sources

from shiftline.operators.booking import BOOKING_COLUMNS
from shiftline.plans.pipeline import Sources, bookings
from shiftline.sources.readers import (
    COMPONENT_MAP_SCHEMA,
    PRODUCTION_SCHEMA,
    READINGS_SCHEMA,
    jdbc_options,
    query_as_table,
    read_files,
)
from shiftline.sources.sinks import write_bookings, write_payload
from shiftline.streaming.rebooking import rebook_stream

AS_OF = dt.date(2025, 1, 10)


def booked(spark, path):
    rows = spark.read.parquet(str(path)).withColumn("date", _text("date")).select(*BOOKING_COLUMNS)
    return sorted(map(str, rows.collect()))


def _text(name):
    from pyspark.sql import functions as F

    return F.col(name).cast("string")


def test_write_again_and_empty(spark, tmp_path):
    rows = bookings(sources(spark), AS_OF)
    path = str(tmp_path / "bookings")
    assert write_bookings(rows, path, AS_OF) == {"rows": 6, "emptied": 0}
    first = booked(spark, path)
    assert first == sorted(map(str, rows.collect()))
    assert write_bookings(rows, path, AS_OF) == {"rows": 6, "emptied": 0}
    assert booked(spark, path) == first

    # The 9th loses its bookings; the next day's run leaves what is before its window alone.
    fewer = rows.where("date = '2025-01-10'")
    assert write_bookings(fewer, path, AS_OF + dt.timedelta(2))["emptied"] == 0
    assert booked(spark, path) == first
    assert write_bookings(fewer, path, AS_OF)["emptied"] == 1
    assert booked(spark, path) == sorted(map(str, fewer.collect()))

    write_payload(fewer, str(tmp_path / "payload"))
    (line,) = spark.read.text(str(tmp_path / "payload")).collect()
    assert line.value.startswith('{"date":"2025-01-10","shift":"A","startTime":"08:00:00"')


def test_stream(spark, tmp_path):
    tables = sources(spark)
    for name in ("production", "readings", "component_map"):
        getattr(tables, name).write.parquet(str(tmp_path / name))

    def load():
        return Sources(
            read_files(spark, str(tmp_path / "production"), PRODUCTION_SCHEMA),
            read_files(spark, str(tmp_path / "readings"), READINGS_SCHEMA),
            read_files(spark, str(tmp_path / "component_map"), COMPONENT_MAP_SCHEMA),
        )

    def run():
        arrivals = spark.readStream.schema(PRODUCTION_SCHEMA).parquet(str(tmp_path / "production"))
        query = rebook_stream(
            arrivals, load, str(tmp_path / "out"), str(tmp_path / "progress"),
            as_of=lambda: AS_OF, every=None,
        )
        query.awaitTermination()
        return booked(spark, tmp_path / "out")

    expected = sorted(map(str, bookings(tables, AS_OF).collect()))
    assert run() == expected
    assert run() == expected  # nothing arrived since


def test_jdbc_options():
    options = jdbc_options("jdbc:x:y", "records", "id", (1, 100), 8, fetch_size=500)
    assert options == {
        "url": "jdbc:x:y", "dbtable": "records", "fetchsize": "500", "partitionColumn": "id",
        "lowerBound": "1", "upperBound": "100", "numPartitions": "8",
    }
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x:y", "records", "id")
    assert query_as_table(" SELECT 1 ;\n") == "(SELECT 1) AS query_result"
