"""Forward fill along an order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftline.functions import listed, quoted, with_exprs
from shiftline.operators.ordered import edge_before, pinned_ranges, same_key, written
from shiftline.operators.skew import fits_broadcast


def forward_fill(
    df: DataFrame,
    cols: Sequence[str],
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    strategy: str = "two_phase",
    seed: DataFrame | None = None,
) -> DataFrame:
    """Replace NULL in each of ``cols`` by the last value before it in ``order_by``.

    Columns are filled independently. Rows with nothing before them stay NULL. ``order_by`` names
    ascending columns and should tell all rows apart. With ``partition_by`` values do not pass from
    one key to another.

    ``strategy="two_phase"`` fills inside consecutive ranges of the order, and hands only each
    range's last values on to the next. ``strategy="window"`` puts each key, or without
    ``partition_by`` everything, into one task; it is for small results and for keys known to be
    small.

    ``seed`` has ``cols`` and one row per key, or one row in all: what came before the first row.
    """
    if seed is not None:
        filled = forward_fill(df, cols, order_by, partition_by, strategy)
        return _seeded(filled, cols, partition_by, seed)
    so_far = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    if strategy == "window":
        keys = f"PARTITION BY {listed(partition_by)} " if partition_by else ""
        over = f"OVER ({keys}ORDER BY {listed(order_by)} {so_far})"
        return with_exprs(df, {c: f"last(`{c}`, true) {over}" for c in cols})
    if strategy != "two_phase":
        raise ValueError(f"unknown strategy {strategy!r}")

    ranged = pinned_ranges(df, [(c, "ASC") for c in (*partition_by, *order_by)])
    edge = {c: f"_edge_{i}" for i, c in enumerate(cols)}
    edges = edge_before(
        ranged,
        {
            edge[c]: (f"struct({listed([*partition_by, c])})", f"`{c}` IS NOT NULL") for c in cols
        },
    )
    over = f"OVER (PARTITION BY {listed(['_range', *partition_by])} ORDER BY _position {so_far})"

    def filled(c: str) -> str:
        carried = f"CASE WHEN {same_key(edge[c], partition_by)} THEN {edge[c]}.`{c}` END"
        return f"coalesce(last(`{c}`, true) {over}, {carried})"

    return with_exprs(ranged.join(edges, "_range", "left"), {c: filled(c) for c in cols}).drop(
        "_range", "_position", *edge.values()
    )


def fill_by_stretch(
    df: DataFrame,
    cols: Sequence[str],
    order_by: Sequence[str],
    stretches: Sequence[str],
    partition_by: Sequence[str] = (),
    seed: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``forward_fill`` along stretches of the order, and the last values of each long one.

    ``stretches`` are two or more expressions over the order's leading columns, as SQL text, that do
    not fall along the order, such as a date and a minute; the first one names the long stretch. A
    window holds one stretch, so the rows are shuffled and written once, where ranges of a global
    order take two of each. Whole stretches are carried over as one row each.

    The second table has ``partition_by``, the first of the ``stretches`` as ``_stretch_0`` and
    ``cols``: what each long stretch hands on.
    """
    names = [f"_stretch_{i}" for i in range(len(stretches))]
    keys = [*partition_by, *names]
    over = f"OVER (PARTITION BY {listed(keys)} ORDER BY {listed(order_by)}"
    so_far = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    inside = {c: f"last(`{c}`, true) {over} {so_far}" for c in cols}
    inside |= {"_ends": f"lead(true) {over}) IS NULL"}
    cut = with_exprs(df, dict(zip(names, stretches, strict=True)))
    inside = written(with_exprs(cut, inside))
    ends = written(inside.where("_ends").select(*quoted([*keys, *cols])))
    # One row per stretch, then one per long stretch.
    long = [*partition_by, names[0]]
    earlier = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    within = f"OVER (PARTITION BY {listed(long)} ORDER BY {listed(names[1:])} {earlier})"
    across = f"PARTITION BY {listed(partition_by)} " if partition_by else ""
    across = f"OVER ({across}ORDER BY `{names[0]}` {earlier})"
    lasts = last_values(ends, cols, names[1:], long)
    carried = lasts.selectExpr(*quoted(long), *(f"last(`{c}`, true) {across} AS `{c}`" for c in cols))
    if seed is not None:
        carried = _seeded(carried, cols, partition_by, seed)
    carried = written(carried)
    upto = _before(
        ends.selectExpr(*quoted(keys), *(f"last(`{c}`, true) {within} AS `{c}`" for c in cols)),
        carried, long, cols,
    )
    filled = _before(inside, written(upto), keys, cols).select(*quoted(df.columns))
    return filled, written(_before(lasts, carried, long, cols))


def _before(
    df: DataFrame, before: DataFrame, keys: Sequence[str], cols: Sequence[str]
) -> DataFrame:
    """NULL in each of ``cols`` replaced by what ``before`` has under the same ``keys``."""
    before = before.selectExpr(
        *(f"`{c}` AS `_key_{i}`" for i, c in enumerate(keys)),
        *(f"`{c}` AS `_before_{i}`" for i, c in enumerate(cols)),
    )
    before = F.broadcast(before) if fits_broadcast(before) else before
    same = " AND ".join(f"`{c}` <=> `_key_{i}`" for i, c in enumerate(keys))
    known = {c: f"coalesce(`{c}`, `_before_{i}`)" for i, c in enumerate(cols)}
    joined = df.join(before, F.expr(same), "left")
    return with_exprs(joined, known).select(*quoted(df.columns))


def _seeded(
    filled: DataFrame, cols: Sequence[str], partition_by: Sequence[str], seed: DataFrame
) -> DataFrame:
    names = filled.columns
    before = seed.selectExpr(
        *(f"`{c}` AS `_key_{i}`" for i, c in enumerate(partition_by)),
        *(f"`{c}` AS `_seed_{i}`" for i, c in enumerate(cols)),
    )
    same = " AND ".join(f"`{c}` <=> `_key_{i}`" for i, c in enumerate(partition_by)) or "true"
    joined = filled.join(before, F.expr(same), "left")
    known = {c: f"coalesce(`{c}`, `_seed_{i}`)" for i, c in enumerate(cols)}
    return with_exprs(joined, known).select(*quoted(names))


def last_values(
    df: DataFrame, cols: Sequence[str], order_by: Sequence[str], by: Sequence[str]
) -> DataFrame:
    """For each different ``by``, the last value of each of ``cols`` along ``order_by``."""
    order = f"struct({listed(order_by)})"
    return df.groupBy(*quoted(by)).agg(
        *(F.expr(f"max_by(`{c}`, {order}) FILTER (WHERE `{c}` IS NOT NULL) AS `{c}`") for c in cols)
    )
