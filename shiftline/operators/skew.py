"""Joins that stay even when a few keys hold most rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftline.functions import listed, quoted
from shiftline.operators.ordered import written

# A key with this many rows is heavy, and of those the most frequent ones are broadcast: so many rows
# fit every executor. Other keys hold a share of the rows that a task can take.
HEAVY_ROWS = 1_000_000
MOST_HEAVY = 20_000

# Size up to which a lookup is copied to every executor.
BROADCAST_BYTES = 64 * 1024 * 1024


def join_by_weight(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    weight: str,
    heavy_rows: int = HEAVY_ROWS,
    unmatched: str = "false",
    hashed: bool = False,
) -> DataFrame:
    """Left join with a side that has one row per key and knows how many left rows want it.

    Rows with a heavy key get their match from a broadcast of the heavy keys alone. They still pass
    the shuffle of the light join, but spread by row instead of by key. So do rows that match
    nothing for certain: those with a NULL key, and those for which ``unmatched`` holds. With
    ``hashed`` a task holds its share of ``right`` in memory, and no side is sorted.
    """
    values = [c for c in right.columns if c not in keys and c != weight]
    heavy = (
        right.where(f"`{weight}` >= {heavy_rows}")
        .orderBy(F.desc(weight), *keys)
        .limit(MOST_HEAVY)
        .selectExpr(*quoted(keys), f"struct({listed(values)}) AS _heavy")
    )
    # A heavy key stays here as well: its rows do not look for it. The sign of the weight is 0; a
    # literal would be folded into the condition and no longer spread rows.
    light = right.selectExpr(
        *quoted(keys),
        f"struct({listed(values)}) AS _light",
        f"shiftright(CAST(`{weight}` AS BIGINT), 63) AS _spread",
    )
    nothing = " OR ".join([f"({unmatched})", *(f"`{k}` IS NULL" for k in keys)])
    # Odd for rows that have their match already or have none, so that they meet no light row.
    spread = (
        f"CASE WHEN _heavy IS NULL AND NOT ({nothing}) THEN 0L "
        f"ELSE xxhash64({listed(left.columns)}) | 1L END"
    )
    return (
        left.join(F.broadcast(heavy), list(keys), "left")
        .selectExpr("*", f"{spread} AS _spread")
        .join(light.hint("shuffle_hash") if hashed else light, [*keys, "_spread"], "left")
        .selectExpr(
            *quoted(left.columns),
            *(f"coalesce(_heavy.`{value}`, _light.`{value}`) AS `{value}`" for value in values),
        )
    )


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether all rows of ``df`` together stay below ``limit`` bytes. Runs one aggregation."""
    row_bytes = " + ".join(
        f"coalesce(octet_length(`{f.name}`), 0) + 16" if isinstance(f.dataType, T.StringType)
        else "32"
        for f in df.schema.fields
    )
    return (df.selectExpr(f"sum({row_bytes}) AS size").first().size or 0) <= limit


def left_lookup(
    left: DataFrame,
    lookup: DataFrame,
    key: str,
    salts: int = 64,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Left join with a lookup table on a key that few values may dominate.

    A lookup of checked size is broadcast. In a larger one the names that hold a share of
    ``1 / salts`` of the left rows, of which there are at most ``salts``, are copied ``salts`` times, so
    that their rows spread over as many tasks; other names stay single. NULL names match nothing and
    are spread as well. For a larger lookup the left rows are written once, and so are their counts by
    name: the plan behind them runs once.
    """
    if fits_broadcast(lookup, broadcast_bytes):
        return left.join(F.broadcast(lookup), key, "left")
    left = written(left)
    counts = written(left.where(f"`{key}` IS NOT NULL").groupBy(key).count())
    rows = counts.agg(F.sum("count")).first()[0] or 0
    # At most `salts` values.
    hot = [r[key] for r in counts.where(F.col("count") * salts >= max(rows, 1)).collect()]
    is_hot = F.col(f"`{key}`").isin(hot) if hot else F.lit(False)
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    salted = lookup.withColumn("_salt", F.explode(copies))
    spread = F.expr(f"CAST(pmod(xxhash64({listed(left.columns)}), {salts}) AS INT)")
    salt = F.when(is_hot | F.col(f"`{key}`").isNull(), spread).otherwise(F.lit(0))
    return left.withColumn("_salt", salt).join(salted, [key, "_salt"], "left").drop("_salt")
