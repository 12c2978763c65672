"""

``queries()`` run on tables that Spark derives from ``events`` and ``part`` (see
``shiftline/sources/derived.py``). ``oracle_sql()`` derives the same tables in SQL and states each
operator the plain way: unions of all slots, a window per record, a range join, one global window.
"""

from __future__ import annotations

import datetime as dt
import sys
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from oracle_queries import ORACLE_SQL  # noqa: E402
from shiftline.functions import with_exprs  # noqa: E402
from shiftline.functions.text_time import (  # noqa: E402
    hour_of,
    parse_date,
    parse_datetime,
    seconds_of_day,
)
from shiftline.operators import intervals as I  # noqa: E402
from shiftline.operators import slots as S  # noqa: E402
from shiftline.operators.booking import (  # noqa: E402
    BOOKING_COLUMNS,
    REPORT_ORDER,
    payload_batches,
    payload_json,
    report_rows,
)
from shiftline.operators.changes import row_changes  # noqa: E402
from shiftline.operators.fill import forward_fill  # noqa: E402
from shiftline.operators.lookup import resolve_component, unresolved_report  # noqa: E402
from shiftline.operators.ordered import shared_folder, written  # noqa: E402
from shiftline.operators.split import split_at_boundary  # noqa: E402
from shiftline.plans.dirty import dirty_dates, rebook_dates  # noqa: E402
from shiftline.plans.job import BOOKING_KEY, rebook, rebook_versions, skipped  # noqa: E402
from shiftline.plans.pipeline import (  # noqa: E402
    Sources,
    bookings,
    enriched_slots,
    slot_intervals,
)
from shiftline.sources import curated, derived  # noqa: E402
from shiftline.sources.totals import KeptTotals, keep_readings  # noqa: E402
from shiftline.sources.versions import commit, read_version  # noqa: E402
from shiftline.streaming.rebooking import rebook_stream  # noqa: E402

try:
    import corpus_pipeline
    from shiftline.llm import queries as llm
except ModuleNotFoundError:  # the training-data operators are not installed
    corpus_pipeline = llm = None

# The derived records span a month up to this date; the whole-table queries look back over all.
AS_OF = dt.date(2024, 1, 31)
WHOLE_SPAN = 3_650


def _sources(spark: SparkSession, folder: str) -> Sources:
    return Sources(
        derived.production(spark, folder),
        derived.readings(spark, folder),
        derived.component_map(spark, folder),
    )


def _slots(spark: SparkSession, folder: str) -> DataFrame:
    return slot_intervals(derived.production(spark, folder))


def _pieces(spark: SparkSession, folder: str) -> DataFrame:
    return split_at_boundary(_slots(spark, folder))


def _readings(spark: SparkSession, folder: str) -> DataFrame:
    return I.normalise_readings(derived.readings(spark, folder))


def _plain(df: DataFrame) -> DataFrame:
    """Instants as text, dates as text and decimals as doubles: one form in both engines."""
    shown = {
        "timestamp_ntz": "date_format({}, 'yyyy-MM-dd HH:mm:ss')",
        "date": "date_format({}, 'yyyy-MM-dd')",
        "decimal": "CAST({} AS DOUBLE)",
    }
    return df.selectExpr(
        *(
            shown.get(f.dataType.typeName(), "{}").format(f"`{f.name}`") + f" AS `{f.name}`"
            for f in df.schema.fields
        )
    )


def unpivot_slots(spark: SparkSession, folder: str) -> DataFrame:
    return S.unpivot_slots(derived.production(spark, folder))


def shift_dates(spark: SparkSession, folder: str) -> DataFrame:
    slots = S.unpivot_slots(S.parse_records(derived.production(spark, folder)))
    for step in (S.resolve_start, S.production_date, S.assign_shift):
        slots = slots.transform(step)
    return _plain(
        slots.select("id", "slot_no", "start_dt", "production_date", "shift", "shift_order")
    )


SLOT_END_COLUMNS = ("slot_no", "component", "start", "end", "start_dt", "end_dt")


def slot_ends(spark: SparkSession, folder: str) -> DataFrame:
    return _plain(_slots(spark, folder).select("id", *SLOT_END_COLUMNS))


def slot_ends_by_line(spark: SparkSession, folder: str) -> DataFrame:
    slots = S.resolve_start(S.parse_records(derived.line_slots(spark, folder)))
    key = ("line", "kind", "date_begin")
    later = S.with_later_slot(slots, record_key=key, strategy="two_phase")
    return _plain(
        S.display_columns(S.resolve_end(later)).select("line", "kind", *SLOT_END_COLUMNS)
    )


def text_time_parse(spark: SparkSession, folder: str) -> DataFrame:
    texts = S.unpivot_slots(derived.production(spark, folder))
    record_date, minutes = parse_date("date_begin"), "substring_index(begin, ':', 2)"
    return _plain(
        texts.selectExpr(
            "id",
            "slot_no",
            f"{hour_of('begin')} AS begin_hour",
            f"{seconds_of_day('begin')} AS begin_seconds",
            f"{record_date} AS record_date",
            f"date_format({record_date}, 'dd-MM-yyyy') AS shown_date",
            f"{parse_datetime('date_begin', 'begin')} AS begin_dt",
            f"{parse_datetime('date_begin', minutes)} AS begin_dt_to_the_minute",
        )
    )


def readings_normalised(spark: SparkSession, folder: str) -> DataFrame:
    return _plain(I.normalise_readings(derived.readings(spark, folder), extra=["mem_date_time"]))


def rejected_slots(spark: SparkSession, folder: str) -> DataFrame:
    return S.rejected_slots(_slots(spark, folder))


def trailing_window(spark: SparkSession, folder: str) -> DataFrame:
    recent = S.trailing_window(_slots(spark, folder), "production_date", dt.date(2024, 1, 20))
    return _plain(recent.select("id", "slot_no", "production_date", "start_dt", "end_dt"))


PIECE_COLUMNS = (
    "id", "slot_no", "production_date", "shift", "shift_order", "start", "end", "sort_begin",
    "start_dt", "end_dt", "moulded", "poured", "waste",
)


def boundary_split(spark: SparkSession, folder: str) -> DataFrame:
    return _plain(_pieces(spark, folder).select(*PIECE_COLUMNS))


def interval_counts_lateral(spark: SparkSession, folder: str) -> DataFrame:
    counted = I.attach_interval_totals(
        _pieces(spark, folder).select("id", "slot_no", "start_dt", "end_dt"),
        _readings(spark, folder),
        "start_dt",
        "end_dt",
        "mem_dt",
        I.batch_counts(),
    )
    return _plain(counted)


def interval_enrich(spark: SparkSession, folder: str) -> DataFrame:
    return _plain(I.enrich_intervals(_pieces(spark, folder), _readings(spark, folder)))


def interval_enrich_by_line(spark: SparkSession, folder: str) -> DataFrame:
    """Readings belong to a line, ends are half open."""
    slots = S.resolve_start(S.parse_records(derived.line_slots(spark, folder)))
    slots = S.with_later_slot(slots, ("line", "kind", "date_begin"), strategy="two_phase")
    for step in (S.production_date, S.assign_shift, S.resolve_end):
        slots = slots.transform(step)
    pieces = split_at_boundary(S.display_columns(slots))
    readings = derived.readings(spark, folder, with_line=True)
    readings = I.normalise_readings(readings, extra=["line"])
    return _plain(I.enrich_intervals(pieces, readings, by=["line"], closed="left"))


def interval_enrich_kept(spark: SparkSession, folder: str) -> DataFrame:
    """Totals of readings that are kept and updated three times; the last readings are late."""
    path = _new_path(spark, "interval_enrich_kept")
    readings = derived.readings(spark, folder, with_line=True)
    late = "coalesce(mem_date_time LIKE '10.01.2024%', false)"
    for arrived in (
        f"NOT {late} AND event_id % 3 <> 1", f"NOT {late} AND event_id % 3 = 1", late
    ):
        keep_readings(readings.where(arrived), path)
    return _plain(I.enrich_intervals(_pieces(spark, folder), KeptTotals(spark, path)))


def duplicate_collapse(spark: SparkSession, folder: str) -> DataFrame:
    pieces = written(_pieces(spark, folder))
    return _plain(I.collapse_duplicates(pieces.unionAll(pieces)))


def lookup_fallback(spark: SparkSession, folder: str) -> DataFrame:
    slots = S.unpivot_slots(derived.production(spark, folder)).select("id", "slot_no", "component")
    return resolve_component(slots, derived.component_map(spark, folder))


def unresolved(spark: SparkSession, folder: str) -> DataFrame:
    return unresolved_report(lookup_fallback(spark, folder))


def setpoint_fill(spark: SparkSession, folder: str) -> DataFrame:
    """Channels of good readings, filled forward along time and within a line."""
    readings = derived.readings(spark, folder, with_line=True)
    readings = I.normalise_readings(readings, extra=["line", "event_id"])
    sparse = with_exprs(readings, {c: f"CASE WHEN type = 'GOOD' THEN {c} END" for c in I.CHANNELS})
    everywhere = forward_fill(sparse, I.CHANNELS, ["mem_dt", "event_id"])
    by_line = forward_fill(sparse, I.CHANNELS, ["mem_dt", "event_id"], ["line"])
    return _plain(
        everywhere.select(F.lit("all").alias("scope"), "event_id", *I.CHANNELS).unionByName(
            by_line.select(F.lit("line").alias("scope"), "event_id", *I.CHANNELS)
        )
    )


def report(spark: SparkSession, folder: str) -> DataFrame:
    """The 15 report columns over the whole span."""
    return _plain(report_rows(enriched_slots(_sources(spark, folder), AS_OF, WHOLE_SPAN)))


def booking_rows(spark: SparkSession, folder: str) -> DataFrame:
    return bookings(_sources(spark, folder), AS_OF, WHOLE_SPAN)


def recent_bookings(spark: SparkSession, folder: str) -> DataFrame:
    """What one cycle books: three dates, computed without what came before them."""
    return bookings(_sources(spark, folder), dt.date(2024, 1, 20))


def payload(spark: SparkSession, folder: str) -> DataFrame:
    return payload_json(booking_rows(spark, folder))


def payload_in_batches(spark: SparkSession, folder: str) -> DataFrame:
    order = REPORT_ORDER
    rows = bookings(_sources(spark, folder), AS_OF, WHOLE_SPAN, keep=order)
    return payload_batches(rows, order)


def interval_totals_fine(spark: SparkSession, folder: str) -> DataFrame:
    """Totals of a channel with eight decimal places."""
    points = with_exprs(
        _readings(spark, folder),
        {"fine": "CAST((bentonite * 70 + 3) * 0.00000001BD AS DECIMAL(18,8))"},
    )
    totals = I.attach_interval_totals(
        _pieces(spark, folder).select("id", "slot_no", "start_dt", "end_dt"),
        points,
        "start_dt",
        "end_dt",
        "mem_dt",
        {"fine": "fine"},
    )
    return _plain(totals)


def interval_enrich_by_key(spark: SparkSession, folder: str) -> DataFrame:
    """No table small enough to broadcast, and intervals that two slots share count as heavy."""
    enriched = I.enrich_intervals(
        _pieces(spark, folder),
        _readings(spark, folder),
        broadcast_rows=0,
        stretches=("hour", "day"),
        heavy_rows=2,
    )
    return _plain(enriched)


def lookup_fallback_large(spark: SparkSession, folder: str) -> DataFrame:
    """The lookup counts as too large to broadcast."""
    slots = S.unpivot_slots(derived.production(spark, folder)).select("id", "slot_no", "component")
    return resolve_component(slots, derived.component_map(spark, folder), broadcast_bytes=0)


def collated_slots(spark: SparkSession, folder: str) -> DataFrame:
    """Components that differ in case only count as one."""
    spelled = "CASE WHEN id % 2 = 0 THEN lower(component) ELSE component END"
    pieces = with_exprs(_pieces(spark, folder), {"component": spelled})
    keys = ["production_date", "shift", "component"]
    merged = ["coalesce(sum(n), 0L) AS n"]
    return _plain(I.grouped_alike(pieces, keys, "UTF8_LCASE", ["count(1) AS n"], merged))


def rebook_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """What a run over the whole span left out, as the job reports it."""
    path = _new_path(spark, "rebook_rejects")
    rebook(
        _sources(spark, folder), path, AS_OF, WHOLE_SPAN, skipped_path=f"{path}-skipped"
    )
    return spark.read.parquet(f"{path}-skipped")


def rebooked(spark: SparkSession, folder: str) -> DataFrame:
    """Two overlapping cycles into one folder; the later one replaces what both cover."""
    path = _new_path(spark, "rebooked")
    sources = _sources(spark, folder)
    for day in (19, 20):
        rebook(sources, path, dt.date(2024, 1, day), lookback_days=WHOLE_SPAN)
    return _read_bookings(spark, path)


def stream_rebooked(spark: SparkSession, folder: str) -> DataFrame:
    """Bookings of all dates, written by a stream that watches the events arrive."""
    path = _new_path(spark, "stream_rebooked")
    arrivals = (
        spark.readStream.schema(derived.table(spark, folder, "events").schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(folder)
    )
    rebook_stream(
        arrivals,
        lambda: _sources(spark, folder),
        path,
        f"{path}-progress",
        as_of=lambda: AS_OF,
        every=None,
        window_days=WHOLE_SPAN,
    ).awaitTermination()
    return _read_bookings(spark, path)


# One line has seven tenths of all records and readings.
LINE_OF = "CASE WHEN {0} % 10 < 7 THEN 1L ELSE CAST({0} % 10 AS BIGINT) END"


def _line_sources(spark: SparkSession, folder: str) -> Sources:
    readings = derived.readings(spark, folder, with_line=True)
    return Sources(
        derived.production(spark, folder).withColumn("line", F.expr(LINE_OF.format("id"))),
        readings.withColumn("line", F.expr(LINE_OF.format("event_id"))).drop("event_id"),
        derived.component_map(spark, folder),
    )


def booking_rows_by_line(spark: SparkSession, folder: str) -> DataFrame:
    """All lines in one run; each has its own readings and setpoints."""
    return bookings(_line_sources(spark, folder), AS_OF, WHOLE_SPAN, line="line")


def rebooked_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Two cycles into one versioned table: all dates up to a day, then the dates from there on,
    whose setpoints go on from what the first one kept.
    """
    path = _new_path(spark, "rebooked_versions")
    sources = _line_sources(spark, folder)
    rebook_versions(sources, path, dt.date(2024, 1, 16), WHOLE_SPAN, line="line")
    rebook_versions(sources, path, dt.date(2024, 1, 22), window_days=5, line="line")
    schema = bookings(sources, AS_OF, line="line").schema
    return read_version(spark, path, schema, dt.date(2024, 1, 17))


def _filed(spark: SparkSession, folder: str) -> Sources:
    """Records and readings filed in two rounds; the second corrects and completes the first.

    The first round lacks every fifth record, and has every seventh one a day late and half empty.
    """
    path = _new_path(spark, "filed")
    records, readings = derived.production(spark, folder), derived.readings(spark, folder, True)
    readings = readings.drop("line")
    wrong = with_exprs(
        records.where("id % 7 = 0"),
        {"date_begin": "date_format(date_add(to_date(date_begin, 'dd.MM.yy'), 1), 'dd.MM.yy')",
         "moulded_1": "CAST(NULL AS BIGINT)"},
    )
    early = records.where("id % 5 <> 0 AND id % 7 <> 0").unionByName(wrong.where("id % 5 <> 0"))
    late = records.where("id % 5 = 0 OR id % 7 = 0")
    for rows in (early, late):
        curated.file_rows(rows, f"{path}-records", curated.RECORD_DATE, "id")
    for rows in (readings.where("event_id % 3 <> 1"), readings.where("event_id % 3 = 1")):
        curated.file_rows(rows, f"{path}-readings", curated.READING_DATE, "event_id")
    return curated.filed_sources(
        spark,
        f"{path}-records",
        f"{path}-readings",
        (records.schema, readings.schema),
        derived.component_map(spark, folder),
        dt.date(2024, 1, 20),
    )


def filed_bookings(spark: SparkSession, folder: str) -> DataFrame:
    """The bookings of one cycle over tables into which late and corrected rows were filed."""
    return bookings(_filed(spark, folder), dt.date(2024, 1, 20))


def filed_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """What that cycle could not book, records without a readable date included."""
    return skipped(_filed(spark, folder), dt.date(2024, 1, 20))


def dirty_rebooked(spark: SparkSession, folder: str) -> DataFrame:
    """All dates are booked, then late readings of one day and late records of another arrive, and
    only what they reach is booked again.
    """
    path = _new_path(spark, "dirty_rebooked")
    records = derived.production(spark, folder)
    readings = derived.readings(spark, folder, True).drop("line")
    late_records = "date_begin = '10.01.24' AND id % 3 = 0"
    late_readings = "mem_date_time LIKE '20.01.2024%' AND event_id % 2 = 0"
    paths = f"{path}-records", f"{path}-readings"
    mapping = derived.component_map(spark, folder)
    schemas = records.schema, readings.schema

    def file(kind: str) -> tuple[dict, dict]:
        new_records = records.where(f"{kind} ({late_records})")
        new_readings = readings.where(f"{kind} ({late_readings})")
        return (
            curated.file_rows(new_records, paths[0], curated.RECORD_DATE, "id"),
            curated.file_rows(new_readings, paths[1], curated.READING_DATE, "event_id"),
        )

    file("NOT")
    plain = curated.filed_sources(spark, *paths, schemas, mapping, AS_OF, WHOLE_SPAN)
    rebook_versions(plain, path, AS_OF, WHOLE_SPAN)
    arrived = file("")
    load = curated.filed_dates(spark, *paths, schemas, mapping)
    rebook_dates(load, path, dirty_dates(arrived[0]["dates"], arrived[1]["dates"]))
    return read_version(spark, path, bookings(plain, AS_OF).schema)


def booking_changes(spark: SparkSession, folder: str) -> DataFrame:
    """What a second commit changed: rows that went, came, changed and were doubled."""
    path = _new_path(spark, "booking_changes")
    rows = written(booking_rows(spark, folder))
    poured = "`noOfBoxesPoured` + CASE WHEN `componentId` % 5 = 1 THEN 1 ELSE 0 END"
    old = with_exprs(rows, {"noOfBoxesPoured": poured}).where("`componentId` % 7 <> 0")
    commit(old, path, "CAST(date AS DATE)", [])
    new = rows.where("`componentId` % 11 <> 3")
    new = new.unionAll(new.where("`componentId` % 13 = 4"))
    return row_changes(read_version(spark, path, rows.schema), new, BOOKING_KEY)


def _new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _read_bookings(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.parquet(path)
    return rows.withColumn("date", F.col("date").cast("string")).select(*BOOKING_COLUMNS)


def entry(spark: SparkSession) -> DataFrame:
    """Booking rows from wide records, readings and the component lookup."""
    return booking_rows(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**_booking_queries(), **(llm.QUERIES | {"pipeline": corpus_pipeline.run} if llm else {})}


def _booking_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "unpivot_slots": unpivot_slots,
        "shift_dates": shift_dates,
        "slot_ends": slot_ends,
        "slot_ends_by_line": slot_ends_by_line,
        "text_time_parse": text_time_parse,
        "readings_normalised": readings_normalised,
        "rejected_slots": rejected_slots,
        "trailing_window": trailing_window,
        "boundary_split": boundary_split,
        "interval_counts_lateral": interval_counts_lateral,
        "interval_enrich": interval_enrich,
        "interval_enrich_by_line": interval_enrich_by_line,
        "interval_enrich_kept": interval_enrich_kept,
        "duplicate_collapse": duplicate_collapse,
        "lookup_fallback": lookup_fallback,
        "unresolved_report": unresolved,
        "forward_fill": setpoint_fill,
        "report": report,
        "booking_rows": booking_rows,
        "recent_bookings": recent_bookings,
        "payload_json": payload,
        "payload_batches": payload_in_batches,
        "interval_totals_fine": interval_totals_fine,
        "interval_enrich_by_key": interval_enrich_by_key,
        "lookup_fallback_large": lookup_fallback_large,
        "collated_slots": collated_slots,
        "rebook_rejects": rebook_rejects,
        "booking_rows_by_line": booking_rows_by_line,
        "rebooked_versions": rebooked_versions,
        "dirty_rebooked": dirty_rebooked,
        "booking_changes": booking_changes,
        "filed_bookings": filed_bookings,
        "filed_rejects": filed_rejects,
        "rebooked": rebooked,
        "stream_rebooked": stream_rebooked,
    }


def oracle_sql() -> dict[str, str]:
    return ORACLE_SQL | (llm.ORACLE_SQL if llm else {})
