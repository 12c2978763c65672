"""Rebooking driven by arriving records.

Finding the next-later slot and filling forward need whole records in order, which a streaming plan
cannot give. So the stream only says that something arrived, and every micro-batch recomputes the
trailing window from the tables. Because that replaces whole dates, a batch that runs twice after a
failure does no harm, and late or corrected records inside the window are picked up.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from shiftline.plans.job import rebook
from shiftline.plans.pipeline import Sources


def rebook_stream(
    arrivals: DataFrame,
    load_sources: Callable[[], Sources],
    path: str,
    checkpoint: str,
    as_of: Callable[[], dt.date | None] = lambda: None,
    every: str | None = "900 seconds",
    **options,
) -> StreamingQuery:
    """Start rebooking whenever ``arrivals`` has new rows.

    ``load_sources`` is called per batch, so that each one sees the tables as they are then.
    ``every=None`` handles what is there now and stops. ``options`` go to ``rebook``.
    """

    def book(batch: DataFrame, _batch_id: int) -> None:
        if not batch.isEmpty():
            rebook(load_sources(), path, as_of(), **options)

    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return (
        arrivals.writeStream.foreachBatch(book)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def rebook_on_schedule(
    spark: SparkSession,
    load_sources: Callable[[], Sources],
    path: str,
    checkpoint: str,
    as_of: Callable[[], dt.date | None] = lambda: None,
    every: str = "900 seconds",
    **options,
) -> StreamingQuery:
    """Start rebooking once per ``every``, whether or not new records have arrived.

    So late readings, new component ids and a new day take effect in the next cycle. The stream's
    only input is a clock.
    """

    def book(_batch: DataFrame, _batch_id: int) -> None:
        rebook(load_sources(), path, as_of(), **options)

    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return (
        ticks.writeStream.foreachBatch(book)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=every)
        .start()
    )
