"""Names of columns that operators add beside whatever the input holds."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def free(columns: Iterable[str], name: str) -> str:
    """``name`` with as many underscores after it as it takes to differ from all ``columns``.

    Names compare as Spark compares them, regardless of case.
    """
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def all_but(columns: Iterable[str], replaced: Iterable[str] = ()) -> list[Column]:
    """The ``columns`` whose names are not among ``replaced``, whatever characters they hold."""
    gone = {r.lower() for r in replaced}
    return [F.col(f"`{c.replace('`', '``')}`") for c in columns if c.lower() not in gone]
