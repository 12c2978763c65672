"""Work that follows one global order, spread over many tasks.

``pinned_ranges`` cuts a DataFrame into consecutive ranges of its order and writes the result to
the shared folder, so the cut is the same for every later reader, also after an executor is lost.
``edge_before`` then tells each range what the ranges before it left behind. It handles one row per
range, never the data itself.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_run_folder: ContextVar[str | None] = ContextVar("run_folder", default=None)

# monotonically_increasing_id keeps the partition number above bit 33.
_ROW_BITS = 33


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables, from ``spark.checkpoint.dir``.

    Only a local session, as in tests, gets a temporary folder when the setting is missing.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder and folder.startswith("file:") and not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir is a local folder; executors need a shared one")
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="shiftline-"))
    return context.getCheckpointDir()


def written(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, and safe from then on.

    Inside ``run_folder`` the table goes when the run ends; otherwise it stays. What this returned is
    not written again.
    """
    if "_is_written" in df.__dict__:
        return df
    spark = df.sparkSession
    path = f"{_run_folder.get() or shared_folder(spark)}/shiftline-{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._is_written = True
    return table


def is_stored(df: DataFrame) -> bool:
    """Whether ``df`` is rows as they lie in files, at most filtered and with fewer columns. Reading
    some columns of them again takes less than writing all of them."""
    plan = df._jdf.queryExecution().optimizedPlan()
    if not plan.deterministic():
        return False
    while (kind := plan.nodeName()) in ("Filter", "Project"):
        if kind == "Project":
            shown = plan.projectList()
            kinds = {shown.apply(i).getClass().getSimpleName() for i in range(shown.length())}
            if kinds - {"AttributeReference"}:
                return False
        plan = plan.child()
    return kind == "LogicalRelation" and plan.relation().getClass().getSimpleName() == "HadoopFsRelation"


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """Tables written inside go to one folder, which is deleted at the end, also after a failure."""
    path = f"{shared_folder(spark)}/shiftline-run-{uuid.uuid4().hex}"
    token = _run_folder.set(path)
    try:
        yield path
    finally:
        _run_folder.reset(token)
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files.delete(place, True)


def pinned_ranges(df: DataFrame, order: Sequence[tuple[str, str]]) -> DataFrame:
    """Add ``_position``, which rises along ``order``, and ``_range``, its partition.

    ``order`` pairs column names with directions like ``DESC NULLS LAST``. This writes the rows, first
    as they come: Spark reads them once for the bounds of the ranges and once to deal them out, and
    would run their plan both times. Ranges are balanced whatever the
    leading order columns hold, as long as the full order tells rows apart. AQE merges small ones.
    """
    columns = [_sort_order(*item) for item in order]
    return written(
        written(df)
        .repartitionByRange(*columns)
        .sortWithinPartitions(*columns)
        .selectExpr("*", "monotonically_increasing_id() AS _position")
    ).selectExpr("*", f"shiftright(_position, {_ROW_BITS}) AS _range")


def _sort_order(name: str, direction: str) -> Column:
    column = F.col(f"`{name}`")
    return {
        "ASC": column.asc,
        "DESC": column.desc,
        "DESC NULLS LAST": column.desc_nulls_last,
        "ASC NULLS LAST": column.asc_nulls_last,
    }[direction]()


FIRST_OF_RANGE = f"_position = shiftleft(_range, {_ROW_BITS})"


def edge_before(ranged: DataFrame, values: Mapping[str, tuple[str, str]]) -> DataFrame:
    """For every range, what the rows before it hold last.

    ``values`` maps a result name to ``(value, counts)``, both SQL text: the value of the last
    earlier row for which ``counts`` is true. The result has one row per range, which is at most the
    number of shuffle partitions, so it is safe to broadcast.
    """
    # First the positions of those rows, as plain numbers, then the few rows themselves.
    last = ranged.groupBy("_range").agg(
        *(
            F.expr(f"max(_position) FILTER (WHERE {counts}) AS _at{i}")
            for i, (_, counts) in enumerate(values.values())
        )
    )
    earlier = "OVER (ORDER BY _range ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    before = last.selectExpr(
        "_range AS _for", *(f"max(_at{i}) {earlier} AS _at{i}" for i in range(len(values)))
    )
    flat = ", ".join(f"{i}, _at{i}" for i in range(len(values)))
    wanted = before.selectExpr("_for", f"stack({len(values)}, {flat}) AS (_which, _at)")
    rows = ranged.join(F.broadcast(wanted.where("_at IS NOT NULL")), F.expr("_position = _at"))
    found = rows.groupBy("_for").agg(
        *(
            F.expr(f"first({value}) FILTER (WHERE _which = {i}) AS {name}")
            for i, (name, (value, _)) in enumerate(values.items())
        )
    )
    return F.broadcast(found.withColumnRenamed("_for", "_range"))


def same_key(edge: str, keys: Sequence[str]) -> str:
    """Whether the edge row belongs to the key of the current row. NULL keys are equal."""
    return " AND ".join([f"{edge} IS NOT NULL", *(f"{edge}.`{k}` <=> `{k}`" for k in keys)])
