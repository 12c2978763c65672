"""Near-duplicate documents by a chosen-path similarity join over word shingles.

Documents with equal shingle sets form one class, and classes are joined. Each class has minwise
values of its set. A tree of the join branches the classes by the minwise value at a place that
depends on the node, so similar sets go down the same path; a node that is small enough is compared
exhaustively. A pair of similarity s shares a node of a tree's first level with probability s, and
every node that is too large branches at two places, so the pair shares 2 * s children of it on
average. However deep a tree is, it misses the pair with probability (1 - s) / s at most: the chance x
to share no small node below a shared one is a solution of x = (1 - s + s * x) ** 2. Trees are
independent, and there are as many as ``MISSED`` asks for.

A node is compared on the sets' ``SKETCH`` smallest hashes, which for most documents are the whole
set, by counting along lists of the classes that hold a hash. What leaves the node is no more than
one link per class: a spanning forest of the links it found, so a large group of near copies never
becomes a list of pairs. Links that leave a node are confirmed on the full sets. Sets are worked out
from the texts, a second time, for the classes that share a node with another one only.

There are two rounds. The first takes two trees and cuts large nodes into blocks that share one
member; its links give first components. The second takes the other trees. A node whose classes are
all connected has nothing left to tell and ends; the others branch until they are small, and give
links across components.
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
from shiftline.llm.words import mixed, shingle_set, word_hashes
from shiftline.llm.workspace import Workspace, ship

SHINGLE = 5
PERCENT = 75  # links have 100 * intersection >= PERCENT * union
FIRST_TREES = 2
MISSED = 2e-6  # chance that the second round's trees miss a pair at the threshold, over all levels
TREES = math.ceil(math.log(MISSED) / math.log((100 - PERCENT) / PERCENT))  # of the second round
PLACES = 128  # minwise values of a set, one per interval of hashes
SKETCH = 1024
# Similarity on sketches from which sets that are larger than a sketch may be linked, and from which they
# surely are: four standard deviations from the threshold.
LIKELY, SURE = 0.695, 0.805
NODE = 2048  # classes that are compared exhaustively
DEPTH = 12
GROUP_ROWS = 4096
FILTER_BITS = 25  # of the filter that tells which texts are needed

_FEATURES = (
    "doc_id long, n_shingles long, set_key binary, paths array<long>, values array<short>"
)
_BELOW = np.uint64(1) << np.uint64(57)
_EDGES = np.arange(PLACES, dtype=np.uint64) * _BELOW
# Where an empty place looks for a value: the same sequence of places for every set.
_ORDER = np.random.default_rng(7).integers(0, PLACES, size=(4 * PLACES, PLACES))


def minwise(shingles: np.ndarray) -> np.ndarray:
    """One minimum per interval of the hashes; empty places borrow from others, alike for all sets.
    """
    at = np.searchsorted(shingles, _EDGES)
    full = at < len(shingles)
    value = shingles[np.where(full, at, 0)]
    full &= (value >> np.uint64(57)) == np.arange(PLACES)
    value = mixed(value)
    if not full.all():
        source = full[_ORDER].argmax(axis=0)
        borrowed = value[_ORDER[source, np.arange(PLACES)]]
        value = np.where(full, value, borrowed)
    return value


def set_features(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set_key (equal for equal sets), paths and values, per document."""
    ship(docs.sparkSession)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, keys, paths, values = [], [], [], []
            for first, end, words, bounds in word_hashes(batch.column(1)):
                for k in range(end - first):
                    shingles = shingle_set(words[bounds[k] : bounds[k + 1]], SHINGLE)
                    counts.append(len(shingles))
                    if len(shingles) == 0:
                        keys.append(None)
                        paths.append(None)
                        values.append(None)
                        continue
                    keys.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
                    least = minwise(shingles)
                    paths.append(least[: FIRST_TREES + TREES].view(np.int64))
                    values.append(least.astype(np.uint16).view(np.int16))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(counts, pa.int64()),
                    pa.array(keys, pa.binary()),
                    pa.array(paths, pa.list_(pa.int64())),
                    pa.array(values, pa.list_(pa.int16())),
                ],
                names=["doc_id", "n_shingles", "set_key", "paths", "values"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(features, _FEATURES)


# --- comparing nodes --------------------------------------------------------------------------


def _similarities(sketches: list[np.ndarray], sizes: np.ndarray) -> np.ndarray:
    """Similarity of all pairs as far as sketches tell; 0 where sizes rule a link out."""
    k = len(sketches)
    held = np.array([len(x) for x in sketches])
    last = np.array([x[-1] for x in sketches])
    _, code = np.unique(np.concatenate(sketches), return_inverse=True)
    lists = np.argsort(code, kind="stable")
    owner = np.repeat(np.arange(k), held)[lists]
    length = np.bincount(code)
    first = np.cumsum(length) - length
    result = np.zeros((k, k), np.float32)
    starts = np.cumsum(held) - held
    for i in range(k):
        own = code[starts[i] : starts[i] + held[i]]
        own = own[length[own] > 1]
        many = length[own]
        end = np.cumsum(many)
        if len(own) == 0:
            continue
        at = np.arange(end[-1]) + np.repeat(first[own] - (end - many), many)
        common = np.bincount(owner[at], minlength=k)
        near = 100 * np.minimum(sizes, sizes[i]) >= PERCENT * np.maximum(sizes, sizes[i])
        near &= common > 0
        here, there = np.full(k, held[i]), held.copy()
        for j in np.flatnonzero(near & ((sizes > held) | (sizes[i] > held[i]))):
            # Up to the smaller of the largest hashes both sets are known in full.
            bounds = [last[x] for x in (i, j) if sizes[x] > held[x]]
            here[j] = np.searchsorted(sketches[i], min(bounds), side="right")
            there[j] = np.searchsorted(sketches[j], min(bounds), side="right")
        result[i] = np.where(near, common / np.maximum(here + there - common, 1), 0)
    np.fill_diagonal(result, 0)
    return result


def _forest(links: np.ndarray, labels: np.ndarray) -> tuple[list[tuple[int, int]], np.ndarray]:
    """A spanning forest of the links, the closest first, where equal labels are connected already.

    Also returns the number of the tree that each member is in.
    """
    k = len(links)
    rest, free = np.ones(k, bool), np.zeros(k, bool)
    best, source = np.zeros(k, np.float32), np.zeros(k, np.int64)
    tree, trees, pairs = np.zeros(k, np.int64), 0, []
    while rest.any():
        i = int(np.where(rest, best, -1).argmax())
        if best[i] == 0:
            trees += 1
        elif not free[i]:
            pairs.append((int(source[i]), i))
        tree[i], rest[i] = trees, False
        alike = rest & (labels == labels[i])
        best[alike], free[alike] = 2, True
        closer = rest & (links[i] > best)
        best[closer], source[closer] = links[i][closer], i
    return pairs, tree


def _node_links(
    sketches: list[np.ndarray], sizes: np.ndarray, labels: np.ndarray
) -> list[tuple[int, int]]:
    close = _similarities(sketches, sizes)
    whole = sizes <= [len(x) for x in sketches]
    exact = whole[:, None] & whole[None, :]
    sure = np.where(exact, close >= (PERCENT - 1e-4) / 100, close >= SURE)
    maybe = ~exact & ~sure & (close >= LIKELY)
    close[~sure] = 0  # in place: the matrix is the largest thing here
    pairs, tree = _forest(close, labels)
    maybe &= tree[:, None] != tree[None, :]
    return pairs + list(zip(*np.nonzero(np.triu(maybe)), strict=True))


def _links_of(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values(["node", "rep"])
    nodes = group["node"].to_numpy()
    cuts = np.flatnonzero(np.concatenate([[True], nodes[1:] != nodes[:-1]]))
    reps, sizes = group["rep"].to_numpy(), group["n_shingles"].to_numpy()
    labels = group["label"].to_numpy()
    sketches = [np.frombuffer(x, "<u4") for x in group["sketch"]]
    found: list[tuple[int, int]] = []
    for a, b in zip(cuts, [*cuts[1:], len(nodes)], strict=True):
        if b - a > 1:
            pairs = _node_links(sketches[a:b], sizes[a:b], labels[a:b])
            found += [(reps[a + i], reps[a + j]) for i, j in pairs]
    pairs = np.array(found, np.int64).reshape(-1, 2)
    return pd.DataFrame({"a": pairs.min(axis=1), "b": pairs.max(axis=1)}).drop_duplicates()


def _compared(members: DataFrame, sets: DataFrame, rows: int) -> DataFrame:
    """Links between classes within the nodes of ``members`` (node, rep, label), yet to be
    confirmed.
    """
    groups = max(1, -(-rows // GROUP_ROWS))
    full = members.join(sets.select("rep", "n_shingles", "sketch"), "rep")
    bucket = F.pmod(F.xxhash64("node"), F.lit(groups)).alias("bucket")
    return (
        full.select(bucket, "node", "rep", "label", "n_shingles", "sketch")
        .groupBy("bucket")
        .applyInPandas(_links_of, "a long, b long")
        .distinct()
    )


# --- sets of the classes that share a node -------------------------------------------------------


def _needed_filter(reps: DataFrame) -> np.ndarray:
    """A fixed-size bit filter of the ids in ``reps``: 4 MiB, whatever the number of ids."""
    place = F.pmod(F.xxhash64("rep"), F.lit(1 << FILTER_BITS))
    bits = (
        reps.select(F.shiftright(place, 6).alias("word"), F.pmod(place, F.lit(64)).alias("bit"))
        .groupBy("word")
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(bit AS INT))")).alias("bits"))
        .toArrow()
    )
    table = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    table[bits["word"].to_numpy()] = bits["bits"].to_numpy()
    return table


def _sets(docs: DataFrame, reps: DataFrame) -> DataFrame:
    """(rep, n_shingles, sketch, shingles) of the documents in ``reps`` and a few more: the filter
    may let others pass, which later joins drop.
    """
    table = docs.sparkSession.sparkContext.broadcast(_needed_filter(reps))
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(1 << FILTER_BITS))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(2).to_numpy()
            chosen = (table.value[at >> 6] >> (at & 63)) & 1 == 1
            batch = batch.filter(pa.array(chosen))
            ids = batch.column(0).to_pylist()
            for first, end, words, bounds in word_hashes(batch.column(1)):
                found = [
                    shingle_set(words[bounds[k] : bounds[k + 1]], SHINGLE)
                    for k in range(end - first)
                ]
                sketches = [(x[:SKETCH] >> np.uint64(32)).astype("<u4").tobytes() for x in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[first:end], pa.int64()),
                        pa.array([len(x) for x in found], pa.int64()),
                        pa.array(sketches, pa.binary()),
                        pa.array([x.tobytes() for x in found], pa.binary()),
                    ],
                    names=["rep", "n_shingles", "sketch", "shingles"],
                )

    schema = "rep long, n_shingles long, sketch binary, shingles binary"
    return (
        docs.where("doc_id IS NOT NULL")
        .select(F.col("doc_id").cast("long").alias("rep"), "text", place.alias("place"))
        .mapInArrow(sets, schema)
    )


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The links among ``pairs``, by the full sets."""

    @F.pandas_udf("boolean")
    def linked(left: pd.Series, right: pd.Series) -> pd.Series:
        result = np.zeros(len(left), bool)
        for i, (a, b) in enumerate(zip(left, right, strict=True)):
            a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
            at = np.searchsorted(a, b)
            common = int((a[np.minimum(at, len(a) - 1)] == b).sum())
            result[i] = 100 * common >= PERCENT * (len(a) + len(b) - common)
        return pd.Series(result)

    one, other = (sets.select(F.col("rep").alias(x), F.col("shingles").alias(f"set_{x}")) for x in "ab")
    both = pairs.join(one, "a").join(other, "b")
    # A doc_id may stand in several rows, which then give the link several times.
    return both.where(linked("set_a", "set_b")).select("a", "b").distinct()


# --- trees ------------------------------------------------------------------------------------


def _first_level(classes: DataFrame) -> DataFrame:
    """(tree, node, rep), one row per tree and class."""
    roots = F.array(
        *(
            F.struct(
                F.lit(t).alias("tree"),
                F.xxhash64(F.lit(t), F.element_at("paths", t + 1)).alias("node"),
            )
            for t in range(FIRST_TREES + TREES)
        )
    )
    return classes.select("rep", F.explode(roots).alias("root")).select("root.*", "rep")


def _open_nodes(members: DataFrame) -> DataFrame:
    """``members`` with ``size``, without nodes that hold a single label."""
    counts = members.groupBy("node").agg(
        F.count("*").alias("size"), F.min("label").alias("low"), F.max("label").alias("high")
    )
    return members.join(counts.where("low <> high").select("node", "size"), "node")


def _blocks(members: DataFrame) -> DataFrame:
    """Large nodes as blocks by hash of the member; the node's first member is in all of them."""
    first = members.where(f"size > {NODE}").groupBy("node").agg(F.min("rep").alias("first"))
    count = F.expr(f"CAST(ceil(size / {NODE * 3 // 4}) AS LONG)")
    every = F.transform(F.sequence(F.lit(0).cast("long"), count - 1), lambda i: i)
    own = F.array(F.pmod(F.xxhash64("rep"), count))
    cut = members.join(first, "node", "left").withColumn(
        "block",
        F.explode(
            F.when(F.col("size") <= NODE, F.array(F.lit(0).cast("long")))
            .when(F.col("rep") == F.col("first"), every)
            .otherwise(own)
        ),
    )
    return cut.select(F.xxhash64("node", "block").alias("node"), "rep", "label")


def _small_nodes(roots: DataFrame, classes: DataFrame, work: Workspace) -> DataFrame:
    """All nodes of the trees below ``roots`` that are to be compared, branched until small."""
    level = work.write(_open_nodes(roots), "level-0")
    ready = [level.where(f"size <= {NODE}").select("node", "rep", "label")]
    values = classes.select("rep", "values")
    for depth in range(1, DEPTH + 1):
        large = level.where(f"size > {NODE}")
        if large.isEmpty():
            break
        # Two different places per node.
        place = F.expr(f"pmod(xxhash64(node, 0), {PLACES})")
        step = F.expr(f"1 + pmod(xxhash64(node, 1), {PLACES - 1})")
        children = F.array(
            *(
                F.xxhash64("node", F.lit(b), F.element_at("values", (at % PLACES + 1).cast("int")))
                for b, at in enumerate([place, place + step])
            )
        )
        grown = large.join(values, "rep").select("rep", "label", F.explode(children).alias("node"))
        level = work.write(_open_nodes(grown.select("node", "rep", "label")), f"level-{depth}")
        ready.append(level.where(f"size <= {NODE}").select("node", "rep", "label"))
    else:
        # Nodes that no branching splits: all pairs of their blocks.
        large = level.where(f"size > {NODE}")
        count = F.expr(f"CAST(ceil(size / {NODE // 3}) AS LONG)")
        own = F.pmod(F.xxhash64("rep"), count)
        pairs = large.withColumn("own", own).withColumn(
            "other", F.explode(F.sequence(F.lit(0).cast("long"), count - 1))
        )
        ready.append(
            pairs.select(
                F.xxhash64("node", F.least("own", "other"), F.greatest("own", "other")).alias("node"),
                "rep",
                "label",
            )
        )
    members = ready[0]
    for more in ready[1:]:
        members = members.unionAll(more)
    return members


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id for every row of ``docs`` (doc_id: integer, text).

    A document's set holds its distinct runs of five words (A-Z as a-z), or its whole word sequence
    if it has fewer. Documents are linked from a Jaccard similarity of 0.75. ``component_id`` is the
    smallest doc_id that can be reached by links, the own one included. A null or empty text has no
    set and no links. Rows that repeat a doc_id count as one document in the links, and each is
    returned; so a doc_id must not stand for different texts. A row without a doc_id gets no
    component. Other columns are not read. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "near-dup")
    docs = docs.select("doc_id", "text")
    features = work.write(set_features(docs), "features")
    named = features.where("doc_id IS NOT NULL AND set_key IS NOT NULL")
    keys = work.write(named.groupBy("set_key").agg(F.min("doc_id").alias("rep")), "keys")
    reps = named.join(keys, "set_key").where("doc_id = rep")
    classes = reps.select("rep", "paths", "values").dropDuplicates(["rep"])
    classes = work.write(classes, "classes")

    # Nodes of the first level with more than one class; only their classes' sets are needed.
    roots = _first_level(classes)
    shared = roots.groupBy("node").agg(F.count("*").alias("n")).where("n > 1").select("node")
    roots = work.write(roots.join(shared, "node"), "roots")
    sets = work.write(_sets(docs, roots.select("rep").distinct()), "sets")

    first = roots.where(F.col("tree") < FIRST_TREES).select("node", "rep", F.col("rep").alias("label"))
    blocks = work.write(_blocks(_open_nodes(first)), "first-blocks")
    pairs = work.write(_compared(blocks, sets, blocks.count()), "first-pairs")
    work.drop("first-blocks")
    links = work.write(_confirmed(pairs, sets), "first-links")
    known = work.write(connected_components(links, work, "first"), "first-components")

    second = (
        roots.where(F.col("tree") >= FIRST_TREES)
        .join(known.withColumnRenamed("id", "rep"), "rep", "left")
        .select("node", "rep", F.coalesce("component", "rep").alias("label"))
    )
    members = work.write(_small_nodes(second, classes, work), "members")
    for table in ("classes", "roots", *(f"level-{depth}" for depth in range(DEPTH + 1))):
        work.drop(table)
    more = _compared(members, sets, members.count())
    more = work.write(more.join(pairs, ["a", "b"], "left_anti"), "more-pairs")
    work.drop("members")
    more_links = work.write(_confirmed(more, sets), "more-links")
    for table in ("sets", "first-pairs", "more-pairs"):
        work.drop(table)
    every = links.unionAll(more_links)
    found = work.write(connected_components(every, work, "all"), "components")

    return (
        features.join(keys, "set_key", "left")
        .join(found.withColumnRenamed("id", "rep"), "rep", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(
                F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id")
            ).alias("component_id"),
        )
    )
