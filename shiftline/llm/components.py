"""Connected components of a graph that is given as links between ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftline.llm.workspace import Workspace


def connected_components(links: DataFrame, work: Workspace, name: str) -> DataFrame:
    """(id, component) for every id in ``links`` (a, b: long); a component's smallest id names it.

    Alternates two steps until nothing changes: every id hands its larger neighbours to its smallest
    neighbour, then its smaller ones. Long chains shrink by a constant factor a round. Each step is
    a minimum per id, summed up before the shuffle, and a join, so an id with very many links is no
    bottleneck. Links of an id with itself do not count.
    """
    edges = (
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    table, state = f"{name}-0", None
    edges = work.write(edges, table)
    for step in range(1, 1000):
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.min("v").alias("m"))
        smallest = smallest.select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        # v > u hangs from the smallest id around u; links are stored once, so u is the lesser end.
        larger = (
            edges.join(smallest, F.col("v") == F.col("w"))
            .select("u", F.col("m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        least = larger.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
        hung = larger.join(least, F.col("u") == F.col("w")).select("u", "v", "m")
        smaller = (
            hung.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionAll(hung.select("u", F.col("m").alias("v")))
            .where("u <> v")
            .distinct()
        )
        following = f"{name}-{step}"
        edges = work.write(smaller, following)
        work.drop(table)
        table = following
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionAll(roots)
