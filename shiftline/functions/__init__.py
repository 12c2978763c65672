"""SQL expressions: shift calendar, text dates and times, exact numbers.

The functions take and return SQL text, for ``selectExpr`` and ``F.expr``. Text reaches Spark in one
call per projection, where an expression built from ``Column`` objects takes one call per node.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame


def quoted(names: Iterable[str]) -> list[str]:
    return [f"`{name}`" for name in names]


def listed(names: Iterable[str]) -> str:
    return ", ".join(quoted(names))


def with_exprs(df: DataFrame, exprs: Mapping[str, str]) -> DataFrame:
    """``df`` with the columns in ``exprs`` replaced or added, like ``withColumns``."""
    columns = df.columns
    kept = [f"{exprs[c]} AS `{c}`" if c in exprs else f"`{c}`" for c in columns]
    added = [f"{text} AS `{name}`" for name, text in exprs.items() if name not in columns]
    return df.selectExpr(*kept, *added)
