"""Shop-floor tables derived from general ones.

The registered queries and the bench run on these: wide production records, readings and a
component lookup, computed by Spark from ``events`` and ``part``. Every event gives one record and
one reading, so the tables grow with their source. All rules of the calendar occur: slots in any
order, runs past midnight, all three boundary crossings, missing and unreadable times, names with
no id, with two ids, and one name that a third of all slots share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shiftline.operators.ordered import written
from shiftline.operators.slots import SLOTS_PER_RECORD


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# Written production tables, by application and folder.
_PRODUCTION: dict[tuple[str, str], DataFrame] = {}


def production(spark: SparkSession, folder: str) -> DataFrame:
    """Wide records, written once per application, as a table of their own would be."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _PRODUCTION:
        _PRODUCTION[key] = written(_wide_records(table(spark, folder, "events")))
    return _PRODUCTION[key]


def _wide_records(events: DataFrame) -> DataFrame:
    """``4 + 26 * 5`` columns."""
    # The source may be a single small file; the rows it turns into are worth more tasks than that.
    # An explicit number, because AQE would merge the small source into one task.
    spark = events.sparkSession
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(spark.sparkContext.defaultParallelism, wanted)
    base = events.repartition(tasks, "event_id", "ts").selectExpr(
        "event_id AS id",
        "date_format(ts, 'dd.MM.yy') AS date_begin",
        "element_at(array('08:00:00', '16:00:00', '00:00:00'), CAST(event_id % 3 + 1 AS INT)) "
        "AS time_begin",
        "element_at(array(480, 960, 0), CAST(event_id % 3 + 1 AS INT)) + event_id * 7 % 30 AS first",
        "8 + event_id % 23 AS step",
        "1 + event_id % 26 AS used",
    )

    def clock(minutes: str, seconds: str, padded: str = "true") -> str:
        hour = f"CAST(({minutes}) div 60 % 24 AS STRING)"
        return (
            f"concat(CASE WHEN {padded} THEN lpad({hour}, 2, '0') ELSE {hour} END, ':', "
            f"lpad(CAST(({minutes}) % 60 AS STRING), 2, '0'), ':', "
            f"lpad(CAST({seconds} AS STRING), 2, '0'))"
        )

    def slot(i: int) -> list[str]:
        rank = (i * 11 + 5) % SLOTS_PER_RECORD  # slot numbers do not follow the clock
        begin = clock(f"first + {rank} * step", f"(id * 13 + {i * 17}) % 60", "id % 17 <> 3")
        moulded = (
            f"CASE WHEN {rank} >= used THEN NULL WHEN (id + {i}) % 19 = 0 THEN 0 "
            f"ELSE 20 + (id * 31 + {i * 7}) % 180 END"
        )
        return [
            f"CASE WHEN id % 101 = 7 AND {i} = 4 THEN 'xx:15:00' ELSE {begin} END AS begin_{i}",
            f"CASE WHEN id % 53 = 5 AND {i} = 2 THEN NULL "
            f"WHEN (id + {i}) % 29 = 0 THEN '90{i}' "
            f"WHEN (id + {i}) % 3 = 0 THEN ' PX-1' "
            f"WHEN (id + {i}) % 4 = 0 THEN concat('QX-', CAST(id % 12 AS STRING)) "
            f"ELSE concat(' PX-', CAST((id * 17 + {i * 3}) % 150 AS STRING), ' ') END AS titel_{i}",
            f"{moulded} AS moulded_{i}",
            f"CASE WHEN (id + {i}) % 23 = 0 THEN NULL WHEN (id + {i}) % 31 = 0 THEN ({moulded}) + 5 "
            f"ELSE ({moulded}) - (id + {i}) % 9 END AS poured_{i}",
            f"CASE WHEN id % 7 = 0 THEN NULL ELSE (id + {i}) % 9 END AS waste_{i}",
        ]

    time_end = clock("first + used * step + 5", "0")
    return base.selectExpr(
        "id",
        "date_begin",
        "time_begin",
        f"CASE WHEN id % 4 = 1 THEN NULL WHEN id % 113 = 9 THEN 'zz' ELSE {time_end} END "
        "AS time_end",
        *(column for i in range(1, SLOTS_PER_RECORD + 1) for column in slot(i)),
    )


def readings(spark: SparkSession, folder: str, with_line: bool = False) -> DataFrame:
    """One reading per event; ``with_line`` adds ``line`` and ``event_id``."""

    def component(expression: str) -> str:
        return f"CAST({expression} AS DECIMAL(18,4))"

    return table(spark, folder, "events").selectExpr(
        *(("user_id div 6 AS line", "event_id") if with_line else ()),
        "CASE WHEN event_id % 211 = 0 THEN 'n/a' "
        "ELSE date_format(ts, 'dd.MM.yyyy HH:mm:ss') END AS mem_date_time",
        "CASE event_type WHEN 'error' THEN 'BAD' WHEN 'signup' THEN 'TEST' ELSE 'GOOD' END AS type",
        f"{component('event_id % 97')} AS comp_2",
        f"{component('event_id * 7 % 1000')} AS comp_3",
        f"{component('event_id * 3 % 500')} AS comp_5",
        f"CASE WHEN event_id % 13 <> 0 THEN {component('event_id * 11 % 300')} END AS water",
    )


def component_map(spark: SparkSession, folder: str) -> DataFrame:
    """Every tenth name has two ids, and another has none."""
    return table(spark, folder, "part").selectExpr(
        "concat(' PX-', CAST(CASE WHEN p_partkey % 10 = 9 THEN p_partkey - 9 ELSE p_partkey END "
        "AS STRING)) AS Component",
        "p_partkey + 1000 AS ComponentID",
    )


def line_slots(spark: SparkSession, folder: str) -> DataFrame:
    """Slots that already are rows: one per event, in records by line, date and kind.

    Hours 8 to 15 make kind A. Even lines run an evening record B from 16:00 through to 08:00 of the
    next day; odd lines stop it at midnight and start a record C. ``time_end`` is missing on every
    third day.
    """
    return (
        table(spark, folder, "events")
        .where("floor(value) > 0")
        .selectExpr("*", "user_id div 6 AS line", "hour(ts) AS hour", "to_date(ts) AS day")
        .selectExpr(
            "*",
            "CASE WHEN hour BETWEEN 8 AND 15 THEN 'A' WHEN hour >= 16 OR line % 2 = 0 THEN 'B' "
            "ELSE 'C' END AS kind",
            "CASE WHEN hour < 8 AND line % 2 = 0 THEN date_sub(day, 1) ELSE day END AS record_day",
        )
        .selectExpr(
            "line",
            "kind",
            "date_format(record_day, 'dd.MM.yy') AS date_begin",
            "CASE kind WHEN 'A' THEN '08:00:00' WHEN 'B' THEN '16:00:00' ELSE '00:00:00' END "
            "AS time_begin",
            "CASE WHEN day(record_day) % 3 = 0 THEN NULL WHEN kind = 'A' THEN '16:30:00' "
            "WHEN kind = 'C' THEN '09:00:00' WHEN line % 2 = 0 THEN '07:30:00' ELSE '00:15:00' END "
            "AS time_end",
            "event_id AS slot_no",
            "date_format(ts, 'HH:mm:ss') AS begin",
            "concat('PX-', CAST(event_id % 40 AS STRING)) AS component",
            "CAST(floor(value) AS BIGINT) AS moulded",
            "CAST(floor(value * 0.9) AS BIGINT) AS poured",
            "CAST(floor(value) - floor(value * 0.9) AS BIGINT) AS waste",
        )
    )
