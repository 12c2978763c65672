"""Small hand-made tables."""

from decimal import Decimal

from shiftline.plans.pipeline import Sources
from shiftline.sources.readers import COMPONENT_MAP_SCHEMA, PRODUCTION_SCHEMA, READINGS_SCHEMA


def record(id, date_begin, time_begin, time_end, *slots):
    """``slots``: (number, begin, title, moulded, poured, waste)."""
    row = dict.fromkeys(PRODUCTION_SCHEMA.fieldNames())
    row |= {"id": id, "date_begin": date_begin, "time_begin": time_begin, "time_end": time_end}
    for number, *values in slots:
        for group, value in zip(("begin", "titel", "moulded", "poured", "waste"), values):
            row[f"{group}_{number}"] = value
    return row


def production(spark, *records):
    names = PRODUCTION_SCHEMA.fieldNames()
    return spark.createDataFrame([tuple(r[n] for n in names) for r in records], PRODUCTION_SCHEMA)


def readings(spark, *rows):
    """``rows``: (mem_date_time, type, comp_3, comp_2, comp_5, water)."""

    def number(value):
        return None if value is None else Decimal(value)

    return spark.createDataFrame(
        [
            (at, kind, number(c2), number(c3), number(c5), number(water))
            for at, kind, c3, c2, c5, water in rows
        ],
        READINGS_SCHEMA,
    )


def component_map(spark, *rows):
    return spark.createDataFrame(list(rows), COMPONENT_MAP_SCHEMA)


G1_RECORDS = (
    record(
        1, "09.01.25", "08:05:00", "16:30:00",
        (1, "14:00:00", " PX-1 ", 150, 140, 10),
        (2, "08:05:00", "PX-2", 100, 90, None),
        (3, "12:00:00", "PX-1", 0, 5, 5),
    ),
    record(
        2, "09.01.25", "16:30:00", "07:30:00",
        (1, "01:15:00", "PX-1", 60, 60, 0),
        (2, "22:00:00", "PX-3", 90, 80, 5),
    ),
    record(3, "10.01.25", "00:10:00", "09:00:00", (1, "07:00:00", "PX-1", 45, 50, 1)),
)
G1_READINGS = (
    ("09.01.2025 08:05:00", "GOOD", 100, 7, 33, 201),
    ("09.01.2025 10:00:00", "BAD", 999, 99, 99, 999),
    ("09.01.2025 11:00:00", "TEST", 999, 99, 99, 999),
    ("09.01.2025 14:00:00", "GOOD", 105, 8, 34, 202),
    ("09.01.2025 16:00:00", "GOOD", 110, 9, 35, 203),
)
G1_MAP = ((" PX-1", 101), ("PX-2", 102))


def sources(spark, records=G1_RECORDS, reading_rows=G1_READINGS, mapping=G1_MAP):
    return Sources(
        production(spark, *records),
        readings(spark, *reading_rows),
        component_map(spark, *mapping),
    )
