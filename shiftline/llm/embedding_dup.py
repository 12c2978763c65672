"""Near-duplicate embeddings by random-hyperplane signs in several tables.

Equal vectors form one class. A class gets, per table, the signs of its vector against random
hyperplanes, and classes with equal signs in a table share a bucket. Within a bucket all cosines are
computed in double precision. A pair is counted in the first table whose bucket it shares, which
each side's signs tell, so links are summed without listing pairs. Buckets of more than ``BUCKET``
classes are compared in pairs of blocks. Signs per table grow with the logarithm of the number of
rows, so that buckets of unlike vectors stay small, and tables follow from the recall asked for at
the threshold.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftline.llm.components import connected_components
from shiftline.llm.vectors import valid_rows
from shiftline.llm.workspace import Workspace, ship

COSINE = 0.95
RECALL = 0.9995  # of links exactly at the threshold; above it more are found
BUCKET = 1024
GROUP_ROWS = 4096
FILL = 48  # rows per bucket if vectors were spread evenly


def table_shape(rows: int, cosine: float = COSINE, recall: float = RECALL) -> tuple[int, int]:
    """Signs per table and tables."""
    signs = min(max(math.ceil(math.log2(max(rows, 1) / FILL)), 4), 48)
    same = (1 - math.acos(cosine) / math.pi) ** signs
    return signs, math.ceil(math.log(1 - recall) / math.log(1 - same))


def _signatures(vectors: DataFrame, signs: int, tables: int) -> DataFrame:
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        weights = np.int64(1) << np.arange(signs, dtype=np.int64)
        for batch in batches:
            keys: list = [None] * len(batch)
            rows: list = [None] * len(batch)
            signatures: list = [None] * len(batch)
            for size, (places, matrix) in valid_rows(batch.column(1)).items():
                if size not in planes:
                    random = np.random.default_rng([20240607, size])
                    planes[size] = random.standard_normal((size, tables * signs))
                bits = (matrix @ planes[size] > 0).reshape(-1, tables, signs)
                numbers = bits @ weights | (size & 0x7FFF) << 48  # dimensions do not meet
                some = matrix.any(axis=1)
                for place, vector, number, ok in zip(places, matrix, numbers, some, strict=True):
                    if ok:
                        data = vector.tobytes()
                        keys[place] = hashlib.blake2b(data, digest_size=16).digest()
                        rows[place], signatures[place] = data, number
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(keys, pa.binary()),
                    pa.array(rows, pa.binary()),
                    pa.array(signatures, pa.list_(pa.int64())),
                ],
                names=["vec_id", "key", "vector", "signs"],
            )

    return vectors.mapInArrow(
        compute, "vec_id long, key binary, vector binary, signs array<long>"
    )


def _lowest(linked: np.ndarray) -> np.ndarray:
    """Smallest row number in each row's component of a symmetric matrix."""
    label = np.arange(len(linked))
    while True:
        near = np.where(linked, label[None, :], len(label)).min(axis=1, initial=len(label))
        new = np.minimum(label, near)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _links_within(cosine: float):
    def compare(group: pd.DataFrame) -> pd.DataFrame:
        ids, more, roots = [], [], []
        for (table, _), bucket in group.groupby(["table", "bucket"]):
            if len(bucket) < 2:
                continue
            bucket = bucket.sort_values("rep")
            matrix = np.array([np.frombuffer(v) for v in bucket["vector"]])
            length = np.sqrt((matrix * matrix).sum(axis=1))
            linked = matrix @ matrix.T / np.multiply.outer(length, length) >= cosine
            np.fill_diagonal(linked, False)
            own, other = bucket["own"].to_numpy(), bucket["other"].to_numpy()
            if (own != other).any():  # two blocks: pairs within either are compared elsewhere
                linked &= own[:, None] != own[None, :]
            if not linked.any():
                continue
            signs = np.stack(bucket["signs"].to_numpy())[:, : int(table)]
            i, j = np.nonzero(linked)
            fresh = np.ones(len(i), bool)
            for t in range(signs.shape[1]):
                fresh &= signs[i, t] != signs[j, t]
            copies = bucket["copies"].to_numpy()
            found = np.bincount(i[fresh], copies[j[fresh]], len(bucket)).astype(np.int64)
            reps = bucket["rep"].to_numpy()
            some = linked.any(axis=1)
            ids.append(reps[some])
            more.append(found[some])
            roots.append(reps[_lowest(linked)[some]])
        if not ids:
            return pd.DataFrame({"rep": [], "links": [], "root": []}, dtype=np.int64)
        return pd.DataFrame(
            {
                "rep": np.concatenate(ids),
                "links": np.concatenate(more),
                "root": np.concatenate(roots),
            }
        )

    return compare


def near_embeddings(
    vectors: DataFrame, cosine: float = COSINE, recall: float = RECALL
) -> DataFrame:
    """vec_id, n_links and component_id for every row of ``vectors`` (vec_id, embedding).

    Vectors of one dimension are linked from a cosine of ``cosine`` on; those that are null, empty
    or zero or hold null or non-finite components are linked with nothing. ``n_links`` counts the
    other rows that are linked directly; ``component_id`` is the smallest vec_id that links reach,
    the own one included. No pair below the threshold is linked; a pair at the threshold is found
    with probability ``recall``. Rows that repeat count as rows. A row without a vec_id is compared
    and counted, and gets the component of what it is linked with, or null if that has no vec_id
    either; with such rows, ids are to be below 2^62. Other columns are not read. An
    empty table gives an empty table.
    """
    spark = vectors.sparkSession
    ship(spark)
    work = Workspace(spark, "embedding-dup")
    vectors = vectors.select(
        F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")
    )
    signs, tables = table_shape(vectors.count(), cosine, recall)
    rows = work.write(_signatures(vectors, signs, tables), "signatures")
    # Classes without a vec_id get numbers above all others, so no component is named after them
    # that holds a vec_id.
    top = rows.agg(F.max("vec_id")).first()[0] or 0
    number = F.lit(top + 1) + F.monotonically_increasing_id()
    classes = (
        rows.where("key IS NOT NULL")
        .groupBy("key")
        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
        .withColumn("rep", F.coalesce("rep", number))
    )
    classes = work.write(classes, "classes")
    full = work.write(
        rows.join(classes, "key")
        .where("coalesce(vec_id, rep) = rep")
        .dropDuplicates(["rep"])
        .select("rep", "copies", "vector", "signs"),
        "vectors",
    )
    spread = full.select("rep", F.posexplode("signs").alias("table", "sign"))
    sizes = spread.groupBy("table", "sign").agg(F.count("*").alias("size")).where("size > 1")
    shared = spread.join(sizes, ["table", "sign"])
    blocks = F.expr(f"IF(size > {BUCKET}, CAST(ceil(size / {BUCKET // 2}) AS LONG), 1L)")
    placed = (
        shared.withColumn("blocks", blocks)
        .withColumn("own", F.pmod(F.xxhash64("rep", "table"), "blocks"))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .withColumn(
            "bucket",
            F.xxhash64("table", "sign", F.least("own", "other"), F.greatest("own", "other")),
        )
    )
    placed = work.write(placed.select("rep", "table", "own", "other", "bucket"), "buckets")
    groups = max(1, -(-placed.count() // GROUP_ROWS))
    found = (
        placed.join(full, "rep")
        .withColumn("part", F.pmod(F.xxhash64("bucket"), F.lit(groups)))
        .groupBy("part")
        .applyInPandas(_links_within(cosine), "rep long, links long, root long")
    )
    found = work.write(found, "found")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    edges = found.where("rep <> root").select(F.col("rep").alias("a"), F.col("root").alias("b"))
    components = connected_components(edges.distinct(), work, "links")
    components = work.write(components, "components")
    per_class = (
        classes.join(links, "rep", "left")
        .join(components.withColumnRenamed("id", "rep"), "rep", "left")
        .select(
            "key",
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
        .withColumn("component_id", F.when(F.col("component_id") <= top, F.col("component_id")))
    )
    return rows.join(per_class, "key", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    )
