"""Dated tables in versions: a reader sees the rows of one commit, never half of one.

Below a table's path, ``data`` has a folder per commit with a folder per date, written once and never
changed, and ``versions`` a small file per commit that names the live folder of every date. A commit
writes its dates beside the old ones and then puts its file in place with one rename. What a commit
that failed leaves behind is not live, and ``vacuum`` removes it. The number of dates is all that
the driver handles.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

FILED_UNDER = "filed_under"
UNDATED = "undated"  # what rows without a date are filed under


@dataclass(frozen=True)
class Version:
    """A commit: the folder of every date, and of further tables by name, below the path."""

    number: int = 0
    folders: Mapping[str, str] = field(default_factory=dict)
    tables: Mapping[str, str] = field(default_factory=dict)


class _Files:
    """The file system that a path lies in."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.root = spark, path
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self.system = self._path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def names(self, folder: str) -> list[str]:
        place = self._path(f"{self.root}/{folder}")
        if not self.system.exists(place):
            return []
        return sorted(entry.getPath().getName() for entry in self.system.listStatus(place))

    def delete(self, name: str) -> None:
        self.system.delete(self._path(f"{self.root}/{name}"), True)

    def put(self, name: str, text: str) -> None:
        """Write a file that is there as a whole or not at all; an existing one is an error."""
        target, draft = (self._path(f"{self.root}/{n}") for n in (name, f"drafts/{uuid.uuid4().hex}"))
        self.system.mkdirs(target.getParent())
        out = self.system.create(draft, False)
        out.write(bytearray(text.encode()))
        out.close()
        if self.system.exists(target) or not self.system.rename(draft, target):
            self.system.delete(draft, False)
            raise RuntimeError(f"{name} exists: another job committed in the meantime")


def _numbers(files: _Files) -> list[int]:
    return [int(name.removesuffix(".json")) for name in files.names("versions") if name.endswith(".json")]


def current(spark: SparkSession, path: str, number: int | None = None) -> Version:
    """The live version, or the one with ``number``. Version 0 is an empty table."""
    numbers = _numbers(_Files(spark, path))
    if number is None:
        number = max(numbers, default=0)
    if number == 0:
        return Version()
    if number not in numbers:
        raise ValueError(f"no version {number} of {path}")
    text = spark.read.text(f"{path}/versions/{number:010d}.json", wholetext=True).first()[0]
    return Version(**json.loads(text))


def read_version(
    spark: SparkSession,
    path: str,
    schema: StructType,
    first: dt.date | None = None,
    undated: bool = False,
    dates: Iterable[str] | None = None,
    version: Version | None = None,
) -> DataFrame:
    """The live rows of all dates, of ``first`` and later ones, or of ``dates``.

    Only these dates' folders are read. Rows without a date come without a ``first``, or with
    ``undated``.
    """
    version = version or current(spark, path)
    wanted = set(version.folders) if dates is None else set(dates) & set(version.folders)
    if first is not None:
        wanted = {d for d in wanted if (undated if d == UNDATED else d >= first.isoformat())}
    folders = [f"{path}/{version.folders[d]}" for d in sorted(wanted)]
    reader = spark.read.schema(schema)
    return reader.parquet(*folders) if folders else spark.createDataFrame([], schema)


def read_table(spark: SparkSession, path: str, name: str, schema: StructType, version: Version | None = None) -> DataFrame:
    """A further table of the live version; empty if the version has none."""
    version = version or current(spark, path)
    if name not in version.tables:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/{version.tables[name]}")


def new_stage(base: Version) -> str:
    """The folder that a commit on top of ``base`` writes to."""
    return f"data/{base.number + 1:010d}-{uuid.uuid4().hex}"


def staged(table: DataFrame, path: str, stage: str, name: str) -> DataFrame:
    """``table`` written where a commit with this ``stage`` keeps its further table ``name``."""
    spark, place = table.sparkSession, f"{path}/{stage}-{name}"
    table.write.parquet(place)
    return spark.read.schema(table.schema).parquet(place)


def drop_staged(spark: SparkSession, path: str, stage: str, name: str) -> None:
    """Delete what ``staged`` wrote, when nothing is committed."""
    _Files(spark, path).delete(f"{stage}-{name}")


def commit(
    rows: DataFrame,
    path: str,
    date: str,
    replaced: Iterable[str],
    tables: Mapping[str, DataFrame | None] | None = None,
    base: Version | None = None,
    prefix: str = "''",
    stage: str | None = None,
) -> tuple[Version, int]:
    """Make ``rows`` the live rows of their dates; dates in ``replaced`` without rows lose theirs.

    ``date`` is SQL text for a date. ``tables`` are kept with the version; those of the version before
    that are not given stay. ``base`` is the version the rows were computed from; when another job has
    committed since, this fails and changes nothing. ``prefix`` is SQL text that goes before the date,
    so that a date can have several folders. ``stage`` is that of further tables which are in place
    already (``staged``); they are None in ``tables``. Returns the version and the rows written.
    """
    spark = rows.sparkSession
    base = base or current(spark, path)
    number = base.number + 1
    stage = stage or new_stage(base)
    filed = F.coalesce(F.date_format(F.expr(date), "yyyy-MM-dd"), F.lit(UNDATED))
    filed = F.concat(F.expr(prefix), filed)
    seen = Observation("filed")
    (
        rows.withColumn(FILED_UNDER, filed)
        .observe(seen, F.count(F.lit(1)).alias("rows"), F.collect_set(FILED_UNDER).alias("dates"))
        .write.partitionBy(FILED_UNDER)
        .parquet(f"{path}/{stage}")
    )
    gone = set(replaced)
    folders = {d: f for d, f in base.folders.items() if d not in gone}
    folders |= {d: f"{stage}/{FILED_UNDER}={d}" for d in seen.get["dates"]}
    kept = dict(base.tables)
    for name, table in (tables or {}).items():
        kept[name] = f"{stage}-{name}"
        if table is not None:
            table.write.parquet(f"{path}/{kept[name]}")
    version = Version(number, folders, kept)
    _switch(spark, path, version)
    return version, seen.get["rows"]


def _switch(spark: SparkSession, path: str, version: Version) -> None:
    text = json.dumps({"number": version.number, "folders": version.folders, "tables": version.tables})
    _Files(spark, path).put(f"versions/{version.number:010d}.json", text)


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete versions before the last ``keep``, and folders that none of these needs.

    A commit that is under way keeps its folders: they bear a later number. Returns how many folders
    went.
    """
    files = _Files(spark, path)
    numbers = sorted(_numbers(files))
    kept = [current(spark, path, n) for n in numbers[-keep:]]
    for number in numbers[:-keep]:
        files.delete(f"versions/{number:010d}.json")
    needed = {f for v in kept for f in (*v.folders.values(), *v.tables.values())}
    removed = 0
    for name in files.names("data"):
        if int(name.split("-")[0]) > (numbers[-1] if numbers else 0):
            continue
        own = {f for f in needed if f == f"data/{name}" or f.startswith(f"data/{name}/")}
        if not own:
            files.delete(f"data/{name}")
            removed += 1
        elif f"data/{name}" not in own:
            for part in files.names(f"data/{name}"):
                if part.startswith(FILED_UNDER) and f"data/{name}/{part}" not in own:
                    files.delete(f"data/{name}/{part}")
                    removed += 1
    return removed
