"""Whitened embeddings by distributed block matrices.

Centred rows are cut into blocks of a ``BlockMatrix``; its transpose times itself is the scatter,
whose eigenvectors are found locally (a matrix as wide as a vector), and multiplying the blocks by
the whitening matrix projects the rows.

Two layouts keep every product spread over all tasks. For the scatter, blocks stand one below the
other and the product's inner dimension is dealt into splits. For the projection they stand in a
square grid, and the whitening matrix is repeated along the diagonal: each block then meets its own
copy alone, and the grid's partitions grow with the number of blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix, MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftline.llm.workspace import Workspace, ship

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
BLOCK_VALUES = 1 << 18  # of one block: 2 MB of doubles
SPLIT_BLOCKS = 16  # blocks that one task of the scatter multiplies
_EDGE = 1 << 52  # doubles are whole numbers from here on
_LOW_BITS = 26  # sums are kept in two parts, so that they cannot overflow
_ROW_BITS = 33  # monotonically_increasing_id keeps the partition number above
_SCHEMA = (
    "vec_id long, component int, n long, deviation decimal(38,0), whitened double, "
    "explained double, identity_error double"
)
_BLOCKS = T.StructType(
    [T.StructField("block", T.LongType()), T.StructField("rows", MatrixUDT())]
)


def _numbered(df: DataFrame, work: Workspace, table: str) -> tuple[DataFrame, int]:
    """``df`` written, with a consecutive ``at`` from 0; and the number of rows."""
    made = work.write(df.withColumn("_at", F.monotonically_increasing_id()), table)
    made = made.withColumn("_range", F.shiftright("_at", _ROW_BITS))
    counts = made.groupBy("_range").agg(F.count("*").alias("n")).collect()  # one per range
    bases, total = [], 0
    for row in sorted(counts):
        bases.append((row["_range"], total - (row["_range"] << _ROW_BITS)))
        total += row["n"]
    bases = df.sparkSession.createDataFrame(bases, "_range long, _base long")
    at = (F.col("_at") + F.col("_base")).alias("at")
    return made.join(F.broadcast(bases), "_range").select(*df.columns, at), total


class _Centre:
    """Distances of whole numbers x from their mean S/n, exact before they are divided."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self.whole = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([s % n for s in sums], np.int64)

    def scaled(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, in Python's numbers where 64 bits are too few."""
        off = x - self.whole
        if len(off) and int(np.abs(off).max() + 1) * self.n >= 1 << 62:
            off = off.astype(object)
        return off * self.n - self.rest

    def rows(self, x: np.ndarray) -> np.ndarray:
        return (self.scaled(x) / self.n).astype(float)

    def deviations(self, x: np.ndarray) -> list[str]:
        off = self.scaled(x)
        if off.dtype != object and len(off) and int(np.abs(off).max()) ** 2 * off.shape[1] >= 1 << 63:
            off = off.astype(object)
        return [str(d) for d in (off * off).sum(axis=1)]


def _blocks(rows: DataFrame, height: int, width: int, centre: _Centre) -> DataFrame:
    """Per block of ``rows`` (at, x, perhaps vec_id): its centred rows, and what they belong to."""

    def stacked(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("at")
        x = np.stack(part["x"].to_numpy())
        made = {"block": part["block"].iloc[:1], "values": [centre.rows(x).tobytes()]}
        if "vec_id" in part:
            ids = [None if pd.isna(i) else int(i) for i in part["vec_id"].astype("Int64")]
            made |= {"vec_ids": [ids], "deviations": [centre.deviations(x)]}
        return pd.DataFrame(made)

    schema = "block long, values binary"
    if "vec_id" in rows.columns:
        # A string keeps ids exact beside nulls.
        rows = rows.withColumn("vec_id", F.col("vec_id").cast("string"))
        schema += ", vec_ids array<long>, deviations array<string>"
    by_block = rows.withColumn("block", F.expr(f"at DIV {height}")).groupBy("block")
    return by_block.applyInPandas(stacked, schema)


def _matrices(blocks: DataFrame, width: int) -> DataFrame:
    """(block, rows) with the block's rows as a matrix."""

    def matrix(row):
        values = np.frombuffer(row["values"]).reshape(-1, width)
        return row["block"], DenseMatrix(len(values), width, values.ravel(order="F"))

    found = blocks.select("block", "values").rdd.map(matrix)
    return blocks.sparkSession.createDataFrame(found, _BLOCKS, verifySchema=False)


def _block_matrix(
    blocks: DataFrame, across: int, height: int, width: int, shape: tuple[int, int]
) -> BlockMatrix:
    """The blocks in their order, ``across`` beside each other. They stay in the JVM."""
    placed = blocks.select(
        F.expr(f"struct(block DIV {across}L, block % {across}L)").alias("place"), "rows"
    )
    return BlockMatrix(
        callMLlibFunc("createBlockMatrix", placed, height, width, *shape), height, width
    )


def _scatter(blocks: DataFrame, n: int, height: int, width: int) -> np.ndarray:
    """The transpose of all rows times themselves."""
    column = _block_matrix(blocks, 1, height, width, (n, width))
    # The inner dimension is one long sum; Python's method would leave it to a single task.
    splits = max(1, -(-n // (height * SPLIT_BLOCKS)))
    product = column.transpose()._java_matrix_wrapper.call(
        "multiply", column._java_matrix_wrapper._java_model, splits
    )
    return BlockMatrix(product, width, width).toLocalMatrix().toArray()


def _projected(blocks: DataFrame, n: int, height: int, matrix: np.ndarray) -> DataFrame:
    """(block, rows) with the rows of every block times ``matrix``."""
    width, kept = matrix.shape
    side = math.isqrt(-(-n // height) - 1) + 1
    grid = _block_matrix(blocks, side, height, width, (side * height, side * width))
    flat, spark = matrix.ravel(order="F"), blocks.sparkSession
    copies = spark.sparkContext.parallelize(range(side)).map(
        lambda i: (i * side + i, DenseMatrix(width, kept, flat))
    )
    copies = spark.createDataFrame(copies, _BLOCKS, verifySchema=False)
    diagonal = _block_matrix(copies, side, width, kept, (side * width, side * kept))
    product = grid.multiply(diagonal)
    found = callMLlibFunc("getMatrixBlocks", product._java_matrix_wrapper._java_model)
    place = [found[found.columns[0]][name].cast("long") for name in ("_1", "_2")]
    return found.select(
        (place[0] * side + place[1]).alias("block"), F.col(found.columns[1]).alias("rows")
    ).where(F.col("block") <= (n - 1) // height)


def _rows_of(projected: DataFrame, blocks: DataFrame) -> DataFrame:
    """(vec_id, component, deviation, whitened) of every row of the blocks."""

    def flat(row):
        return row["block"], bytearray(np.ascontiguousarray(row["rows"].toArray()).tobytes())

    spark = blocks.sparkSession
    made = spark.createDataFrame(projected.rdd.map(flat), "block long, whitened binary", False)

    def unpacked(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for row in part.itertuples():
                values = np.frombuffer(row.whitened).reshape(len(row.deviations), -1)
                kept = values.shape[1]
                yield pd.DataFrame(
                    {
                        "vec_id": pd.Series(row.vec_ids, dtype="Int64").repeat(kept).array,
                        "component": np.tile(np.arange(1, kept + 1), len(values)),
                        "deviation": np.repeat(row.deviations, kept),
                        "whitened": values.ravel(),
                    }
                )

    ids = blocks.select("block", F.col("vec_ids").cast("array<string>").alias("vec_ids"), "deviations")
    return made.join(ids, "block").mapInPandas(
        unpacked, "vec_id long, component int, deviation string, whitened double"
    )


def _whole_numbers(scale: float, shift: int) -> F.Column:
    """floor(scale * c) + shift of every entry, bounded where doubles have no fractions."""
    return F.transform(
        F.col("embedding").cast("array<double>"),
        lambda c: F.floor(F.greatest(F.least(c * float(scale), F.lit(float(_EDGE))), F.lit(float(-_EDGE))))
        + F.lit(shift).cast("long"),
    )


def _whiten_alike(rows: DataFrame, width: int, components: int, work: Workspace) -> DataFrame | None:
    """Whitening of vectors of one dimension; None if they do not vary."""
    spark = rows.sparkSession
    height = max(1, BLOCK_VALUES // width)
    fit, n = _numbered(rows.select("x").distinct(), work, f"fit-{width}")
    parts = fit.select(F.posexplode("x").alias("k", "v")).groupBy("k")
    parts = parts.agg(
        F.sum(F.shiftright("v", _LOW_BITS)).alias("high"),
        F.sum(F.col("v").bitwiseAND((1 << _LOW_BITS) - 1)).alias("low"),
    )
    sums = [(r["high"] << _LOW_BITS) + r["low"] for r in sorted(parts.collect())]  # one per entry
    centre = _Centre(n, sums)

    blocks = _matrices(_blocks(fit, height, width, centre), width)
    blocks = work.write(blocks, f"fit-blocks-{width}")
    covariance = _scatter(blocks, n, height, width) / n
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    values, vectors = values[::-1], vectors[:, ::-1]
    # What is below the rounding of the largest has no direction.
    varying = values > max(values[0], 0.0) * width * np.finfo(float).eps
    kept = min(components, int(varying.sum()))
    if kept == 0:
        return None
    matrix = vectors[:, :kept] / np.sqrt(values[:kept])
    shares = [float(x) for x in values[:kept] / np.trace(covariance)]

    whitened = work.write(_projected(blocks, n, height, matrix), f"fit-whitened-{width}")
    error = np.abs(_scatter(whitened, n, height, kept) / n - np.eye(kept)).max()

    own, total = _numbered(rows, work, f"rows-{width}")
    own = work.write(_blocks(own, height, width, centre), f"row-blocks-{width}")
    projected = _projected(_matrices(own, width), total, height, matrix)
    found = _rows_of(projected, own)
    return found.join(
        F.broadcast(
            spark.createDataFrame(list(enumerate(shares, 1)), "component int, explained double")
        ),
        "component",
    ).select(
        "vec_id",
        "component",
        F.lit(n).cast("long").alias("n"),
        F.col("deviation").cast("decimal(38,0)").alias("deviation"),
        "whitened",
        "explained",
        F.lit(float(error)).alias("identity_error"),
    )


def whiten(
    vectors: DataFrame, components: int = COMPONENTS, scale: float = SCALE, shift: int = SHIFT
) -> DataFrame:
    """One row for each vector of ``vectors`` (vec_id, embedding) and each principal component.

    An entry c counts as the whole number x = floor(scale * c) + shift. Sums S, the covariance V and
    its unit eigenvectors come from the n distinct vectors x, centred before they are multiplied.
    ``whitened`` is x - S/n projected on a component and divided by the root of its eigenvalue,
    ``explained`` the eigenvalue's share of V's trace, ``deviation`` the sum of (n * x - S)^2 over the
    entries, exactly. ``component`` counts from 1 by falling eigenvalue; an eigenvector's sign is
    either, the same for all rows. ``identity_error`` is the largest absolute entry of the whitened
    distinct vectors' covariance minus the identity.

    Vectors that are null, empty or hold null or non-finite entries have no rows; entries whose
    scaled value is beyond 2^52 count as that. Vectors of different dimensions are whitened apart.
    Components whose eigenvalue is zero, up to rounding, have no rows, so a single distinct vector
    has none. Rows that repeat, also with one vec_id or none, each get their rows. Other columns are
    not read. An empty table gives an empty table.
    """
    spark = vectors.sparkSession
    ship(spark)
    work = Workspace(spark, "whitening")
    finite = F.forall(
        F.col("embedding").cast("array<double>"),
        lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))),
    )
    rows = vectors.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & finite).select(
        F.col("vec_id").cast("long").alias("vec_id"), _whole_numbers(scale, shift).alias("x")
    )
    rows = work.write(rows, "valid")
    widths = sorted(r[0] for r in rows.select(F.size("x")).distinct().collect())
    made = [_whiten_alike(rows.where(F.size("x") == w), w, components, work) for w in widths]
    whole = spark.createDataFrame([], _SCHEMA)
    for part in made:
        if part is not None:
            whole = whole.unionAll(part)
    return whole
