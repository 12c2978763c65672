"""Exact top-k search by inner product with a pivot-distance index.

Vectors are lifted by one coordinate so that all get the same length; then the largest inner
products are the smallest distances. Pivots are the centers of a bounded sample. Every vector is
keyed by its nearest pivot and its distance to it, and the index is sorted by that key, so that a
segment of ``SEGMENT`` rows is an annulus around a pivot (or part of one). Queries are sorted the
same way and cut into blocks.

A first round lets every query search the annulus it would lie in, which gives a bound on its k-th
distance. By the triangle inequality a vector within that distance has a distance to each pivot that
differs from the query's by no more. The second round joins blocks of queries with the annuli that
some query of the block can reach, and in an annulus expands the sorted distances only between those
bounds. A pair of a block and an annulus is one small task, however many vectors are equal.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shiftline.llm.ranks import ranked
from shiftline.llm.vectors import valid_rows
from shiftline.llm.workspace import Workspace, ship

SCALE = 256
PIVOTS = 32
SAMPLE = 2048  # vectors that pivots are chosen from, in expectation
SEGMENT = 4096
BLOCK = 12  # segments whose queries form one block
SLACK = 1e-9  # relative, for rounding of distances

_SCALED = "vec_id long, vector binary, size int, norm double"
_KEYED = "vec_id long, vector binary, pivot int, dist double, dists array<double>, norm double"


def scaled_vectors(vectors: DataFrame, scale: float = SCALE) -> DataFrame:
    """vec_id, vector (floor(scale * x) as doubles), size and norm; rows without numbers are left
    out.
    """

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for size, (places, matrix) in valid_rows(batch.column(1)).items():
                whole = np.floor(matrix * scale) + 0.0
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(places)),
                        pa.array([v.tobytes() for v in whole], pa.binary()),
                        pa.array(np.full(len(places), size), pa.int32()),
                        pa.array((whole * whole).sum(axis=1), pa.float64()),
                    ],
                    names=["vec_id", "vector", "size", "norm"],
                )

    return vectors.mapInArrow(compute, _SCALED)


def _centers(rows: np.ndarray, wanted: int) -> np.ndarray:
    """Centers of the sample by k-means; starts are spread, and there is no random part."""
    centers = [rows[0]]
    nearest = ((rows - rows[0]) ** 2).sum(axis=1)
    while len(centers) < wanted and nearest.max() > 0:
        centers.append(rows[nearest.argmax()])
        nearest = np.minimum(nearest, ((rows - centers[-1]) ** 2).sum(axis=1))
    centers = np.array(centers)
    for _ in range(8):
        member = _distances(rows, centers).argmin(axis=1)
        for k in range(len(centers)):
            if (member == k).any():
                centers[k] = rows[member == k].mean(axis=0)
    return centers


def _distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.column_stack([((rows - p) ** 2).sum(axis=1) for p in pivots]))


def _lifted(vectors: list[bytes], size: int, top: float, norm: np.ndarray) -> np.ndarray:
    matrix = np.array([np.frombuffer(v) for v in vectors]).reshape(-1, size)
    return np.column_stack([matrix, np.sqrt(np.maximum(top - norm, 0))])


def _keyed(rows: DataFrame, pivots: np.ndarray, top: float, as_query: bool) -> DataFrame:
    """Nearest pivot, distance to it, and for queries the distances to all."""
    size = pivots.shape[1] - 1

    def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 1024):
                part = batch.iloc[at : at + 1024].reset_index(drop=True)
                norm = part["norm"].to_numpy()
                height = np.full(len(part), top) if as_query else norm
                dists = _distances(_lifted(list(part["vector"]), size, top, height), pivots)
                yield pd.DataFrame(
                    {
                        "vec_id": part["vec_id"],
                        "vector": part["vector"],
                        "pivot": dists.argmin(axis=1),
                        "dist": dists.min(axis=1),
                        "dists": list(dists) if as_query else None,
                        "norm": norm,
                    }
                )

    return rows.mapInPandas(compute, _KEYED)


def _best(k: int):
    """Top k of one block of queries within one annulus."""

    def search(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        empty = {"query_id": [], "vec_id": [], "score": []}
        if queries.empty or rows.empty:
            return pd.DataFrame(empty, dtype=np.int64)
        rows = rows.sort_values(["dist", "vec_id"])
        dist = rows["dist"].to_numpy()
        low = np.searchsorted(dist, queries["low"].min(), side="left")
        high = np.searchsorted(dist, queries["high"].max(), side="right")
        rows = rows.iloc[low:high].sort_values("vec_id")
        if rows.empty:
            return pd.DataFrame(empty, dtype=np.int64)
        matrix = np.array([np.frombuffer(v) for v in rows["vector"]])
        ids = rows["vec_id"].to_numpy()
        found = []
        for at in range(0, len(queries), 256):
            part = queries.iloc[at : at + 256]
            own = part["vec_id"].to_numpy()
            scores = np.array([np.frombuffer(v) for v in part["vector"]]) @ matrix.T
            scores[own[:, None] == ids[None, :]] = -np.inf
            # Rows are in order of vec_id, so a stable sort breaks ties as it should.
            if len(ids) > 4 * k:
                cut = -np.partition(-scores, k - 1, axis=1)[:, k - 1 : k]
            else:
                cut = np.full((len(part), 1), -np.inf)
            for i, line in enumerate(scores):
                near = np.flatnonzero(line >= cut[i])
                near = near[np.argsort(-line[near], kind="stable")[: k + 1]]
                near = near[np.isfinite(line[near])][:k]
                found.append(
                    pd.DataFrame({"query_id": own[i], "vec_id": ids[near], "score": line[near]})
                )
        return pd.concat(found, ignore_index=True).astype(np.int64)

    return search


def _searched(queries: DataFrame, index: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    """Best rows of each query in the (block, segment) pairs; queries bring low and high per pair.
    """
    left = queries.groupBy("block", "segment")
    # New names for the columns: both sides may stem from one table.
    pairs = pairs.select(F.col("block").alias("b"), F.col("segment").alias("s"))
    right = index.join(pairs, F.col("segment") == F.col("s")).drop("segment").groupBy("b", "s")
    return left.cogroup(right).applyInPandas(
        _best(k), "query_id long, vec_id long, score long"
    )


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search_top(
    vectors: DataFrame, is_query: str = "vec_id % 50 = 0", k: int = 5, scale: float = SCALE
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` largest inner products of each query.

    ``vectors`` has vec_id (integer) and embedding. Components become floor(scale * x); scores are
    whole numbers and exact below 2 ** 53. Queries are the rows that fulfil ``is_query``; a row is
    no candidate for itself. Ties go to the smaller vec_id; with fewer than ``k`` candidates all are
    returned. Rows that are null or empty or hold null or non-finite components, and rows without a
    vec_id, take no part; only vectors of one dimension are compared. Rows that repeat a vec_id
    count once. An empty table gives an empty table. The index is fitted on a sample and holds every
    row; the result does not depend on the sample.
    """
    spark = vectors.sparkSession
    ship(spark)
    work = Workspace(spark, "pivot-search")
    vectors = vectors.where("vec_id IS NOT NULL").select(
        F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")
    )
    rows = work.write(scaled_vectors(vectors.dropDuplicates(["vec_id"]), scale), "rows")
    kinds = rows.groupBy("size").agg(F.count("*").alias("n"), F.max("norm").alias("top"))
    parts = [
        _searched_size(rows.where(F.col("size") == r["size"]), r, is_query, k, work)
        for r in sorted(kinds.collect())  # one row per dimension
    ]
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    found = parts[0]
    for more in parts[1:]:
        found = found.unionAll(more)
    return found.select("query_id", "rank", "vec_id", "score")


def _searched_size(rows: DataFrame, kind, is_query: str, k: int, work: Workspace) -> DataFrame:
    size, top = kind["size"], kind["top"]
    draw = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 40)) / float(1 << 40)
    sample = rows.where(draw < SAMPLE / kind["n"]).select("vector", "norm").toPandas()
    if sample.empty:
        sample = rows.select("vector", "norm").limit(1).toPandas()
    sample = sample.sort_values("vector")
    pivots = _centers(
        _lifted(list(sample["vector"]), size, top, sample["norm"].to_numpy()), PIVOTS
    )
    keyed = _keyed(rows, pivots, top, as_query=False).drop("dists", "norm")
    index = ranked(keyed, ["pivot", "dist", "vec_id"], work, f"index-{size}")
    # A segment ends with its pivot, so its key is an interval of distances.
    index = index.withColumn(
        "segment", F.floor(F.col("rank") / SEGMENT) * len(pivots) + F.col("pivot")
    ).drop("rank")
    directory = work.write(
        index.groupBy("segment", "pivot").agg(F.min("dist").alias("near"), F.max("dist").alias("far")),
        f"directory-{size}",
    )

    queries = _keyed(rows.where(is_query), pivots, top, as_query=True)
    queries = ranked(queries, ["pivot", "dist", "vec_id"], work, f"queries-{size}")
    block = F.floor(F.col("rank") / (SEGMENT * BLOCK // 50)).alias("block")
    queries = queries.select("vec_id", "vector", "pivot", "dist", "dists", "norm", block)

    # First round: the annulus nearest to the query.
    away = F.greatest(F.col("near") - F.col("dist"), F.col("dist") - F.col("far"), F.lit(0.0))
    home = (
        queries.select("vec_id", "pivot", "dist")
        .join(directory, "pivot")
        .groupBy("vec_id")
        .agg(F.min(F.struct(away.alias("away"), "segment")).alias("home"))
        .select("vec_id", "home.segment")
    )
    everywhere = [F.lit(float("-inf")).alias("low"), F.lit(float("inf")).alias("high")]
    first = queries.join(home, "vec_id").select("vec_id", "vector", "block", "segment", *everywhere)
    pairs = first.select("block", "segment").distinct()
    near = work.write(_searched(first, index, pairs, k), f"first-{size}")
    bound = near.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    square = F.col("norm") + F.lit(float(top)) - 2 * F.col("least")
    radius = F.sqrt(F.greatest(square, F.lit(0.0))) + F.lit(SLACK * (1 + abs(top)))
    reach = queries.join(bound, F.col("vec_id") == F.col("query_id"), "left").withColumn(
        "radius", F.when(F.col("n") >= k, radius).otherwise(F.lit(float("inf")))
    )
    reach = work.write(reach.select("vec_id", "vector", "block", "dists", "radius"), f"reach-{size}")

    # Second round: what the block's queries can reach.
    rings = reach.select("vec_id", "block", "radius", F.posexplode("dists").alias("pivot", "d"))
    rings = rings.withColumn("low", F.col("d") - F.col("radius")).withColumn(
        "high", F.col("d") + F.col("radius")
    )
    wide = rings.groupBy("block", "pivot").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    pairs = (
        wide.join(directory, "pivot")
        .where("near <= high AND far >= low")
        .select("block", "segment", "pivot", "near", "far")
    )
    pairs = work.write(pairs, f"pairs-{size}")
    second = (
        rings.select("vec_id", "block", "pivot", "low", "high")
        .join(pairs, ["block", "pivot"])
        .where("near <= high AND far >= low")
        .select("vec_id", "block", "segment", "low", "high")
        .join(reach.select("vec_id", "vector"), "vec_id")
    )
    found = _searched(second, index, pairs.select("block", "segment"), k)
    return _top(found, k)
