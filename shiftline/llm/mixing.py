"""Mix sources to target weights by pivotal dependent rounding. DataFrame operations only.

Every document of a source starts with the same copy number, target / source size. Its whole part is
taken outright; its fraction is a probability that has to become 0 or 1. Two documents meet, and
words move from one probability to the other until one of them is settled: the direction is drawn
so that each probability keeps its expected value, and the expected words of the pair never change.
What is unsettled moves on. Documents meet in groups of about ``GROUP``, then the one left over from
each group meets those of other groups, and so on up a tree. At the root one document of a source is
left and drawn, so that a source's words differ from its target by less than one document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shiftline.llm.columns import all_but, free
from shiftline.llm.workspace import Workspace

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST_COPIES = 2.0
GROUP = 48
WORD = r"[^\x20\x09-\x0D]+"

# Groups meet in this order, long documents first: then a short one is what stays unsettled.
_ITEM = ("order", "draw", "doc_id", "text_key", "size", "p")
_UNIT = ("source", "doc_id", "text_key")


def document_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, text_key (tells rows with one doc_id apart) and size in words."""
    return docs.select(
        "doc_id",
        "source",
        F.xxhash64("text").alias("text_key"),
        F.coalesce(F.size(F.regexp_extract_all("text", F.lit(WORD), F.lit(0))), F.lit(0))
        .cast("long")
        .alias("size"),
    ).withColumn("size", F.greatest("size", F.lit(0)))


def source_targets(
    sizes: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most_copies: float = MOST_COPIES,
) -> DataFrame:
    """source, source_size and target, one row per source.

    Targets are level * weight, or most_copies * source_size where that is less. The level follows
    from the sources in order of the level at which they fill up. The windows go over one row per
    source.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    position = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(
        F.array(*map(F.lit, weights)), (position % len(weights) + 1).cast("int")
    )
    full = totals.withColumn("weight", weight).withColumn("most", F.col("source_size") * most_copies)
    filling = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    onward = filling.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(0)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    left = share * F.sum("source_size").over(everything) - F.coalesce(
        F.sum("most").over(before), F.lit(0.0)
    )
    levels = full.withColumn("level", left / F.sum("weight").over(onward)).withColumn(
        "final",
        F.min(F.when(F.col("most") / F.col("weight") > F.col("level"), F.struct(
            (F.col("most") / F.col("weight")).alias("fills"), "level"))).over(everything),
    )
    return levels.select(
        "source",
        "source_size",
        F.least(
            "most", F.coalesce(F.col("final.level") * F.col("weight"), F.col("most"))
        ).alias("target"),
    )


# One meeting of the group's unsettled document a.left with the next one x. d1: words that the
# first can gain, d2: words that the second can gain.
_MEET = """
aggregate(slice(items, 2, greatest(size(items) - 1, 0)),
  named_struct('left', items[0], 'settled', CAST(array() AS array<{settled}>)),
  (a, x) -> transform(
    array(named_struct(
      'up1', a.left.size * (1 - a.left.p), 'down1', a.left.size * a.left.p,
      'up2', x.size * (1 - x.p), 'down2', x.size * x.p,
      'draw', {draw})),
    v -> CASE
      WHEN v.draw * (least(v.up1, v.down2) + least(v.down1, v.up2)) < least(v.down1, v.up2)
      THEN IF(v.up1 <= v.down2,
        named_struct('left', {x_less}, 'settled', {first_1}),
        named_struct('left', {left_more}, 'settled', {second_0}))
      ELSE IF(v.down1 <= v.up2,
        named_struct('left', {x_more}, 'settled', {first_0}),
        named_struct('left', {left_less}, 'settled', {second_1})) END)[0])
"""


def _draw(*names: str) -> str:
    """A uniform number in [0, 1) that depends on the documents and the seed alone."""
    return f"(xxhash64({', '.join(names)}) & 4503599627370495) / 4503599627370496D"


def _meet(seed: int) -> str:
    def changed(who: str, p: str) -> str:
        return (
            f"named_struct('order', {who}.order, 'draw', {who}.draw, 'doc_id', {who}.doc_id, "
            f"'text_key', {who}.text_key, 'size', {who}.size, 'p', {p})"
        )

    def settled(who: str, up: int) -> str:
        return (
            f"array_append(a.settled, named_struct('doc_id', {who}.doc_id, "
            f"'text_key', {who}.text_key, 'up', {up}))"
        )

    return _MEET.format(
        settled="struct<doc_id: {id_type}, text_key: bigint, up: int>",
        draw=_draw("a.left.doc_id", "a.left.text_key", "x.doc_id", "x.text_key", str(seed)),
        x_less=changed("x", "greatest(x.p - v.up1 / x.size, 0D)"),
        left_more=changed("a.left", "least(a.left.p + v.down2 / a.left.size, 1D)"),
        x_more=changed("x", "least(x.p + v.down1 / x.size, 1D)"),
        left_less=changed("a.left", "greatest(a.left.p - v.up2 / a.left.size, 0D)"),
        first_1=settled("a.left", 1),
        first_0=settled("a.left", 0),
        second_1=settled("x", 1),
        second_0=settled("x", 0),
    )


def rounded_copies(sizes: DataFrame, targets: DataFrame, work: Workspace, seed: int = 0) -> DataFrame:
    """source, doc_id, text_key, copies: one row per unit of ``sizes`` whose fraction is not 0.

    Rows that agree in source, doc_id and text are one unit: each is taken equally often.
    """
    id_type = dict(sizes.dtypes)["doc_id"]
    shares = targets.select(
        F.col("source").alias("_source"),
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
        .otherwise(0.0)
        .alias("share"),
    )
    units = sizes.groupBy(*_UNIT).agg(F.sum("size").cast("double").alias("size"))
    units = (
        units.join(shares, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("p", F.col("share") - F.floor("share"))
        .where("p > 0 AND size > 0")
        .select("source", "doc_id", "text_key", "size", "p")
    )
    units = work.write(units, "units")
    nodes = units.groupBy("source").agg(
        F.ceil(F.count("*") / GROUP).cast("long").alias("nodes")
    )
    nodes = work.write(nodes, "nodes")
    most = nodes.agg(F.max("nodes")).first()[0] or 0
    level = (
        units.join(
            nodes.withColumnRenamed("source", "_source"),
            F.col("source").eqNullSafe(F.col("_source")),
        )
        .withColumn("draw", F.xxhash64("doc_id", "text_key", F.lit(seed)))
        .withColumn("order", -F.col("size"))
        .withColumn("node", F.pmod(F.xxhash64("draw"), "nodes"))
        .select("source", "nodes", "node", F.struct(*_ITEM).alias("item"))
    )
    settled, step = [], 0
    meet = _meet(seed).replace("{id_type}", id_type)
    while most:
        met = (
            level.groupBy("source", "nodes", "node")
            .agg(F.sort_array(F.collect_list("item")).alias("items"))
            .select("source", "nodes", "node", F.expr(meet).alias("met"))
        )
        met = work.write(met, f"level-{step}")
        settled.append(met.select("source", F.explode("met.settled").alias("s")))
        last = met.where("nodes = 1").select("source", "met.left.*")
        settled.append(
            last.select(
                "source",
                F.struct(
                    "doc_id",
                    "text_key",
                    F.expr(f"IF({_draw('draw', str(seed))} < p, 1, 0)").alias("up"),
                ).alias("s"),
            )
        )
        level = (
            met.where("nodes > 1")
            .withColumn("nodes", F.ceil(F.col("nodes") / GROUP).cast("long"))
            .withColumn("node", F.pmod(F.xxhash64("node", F.lit(step)), "nodes"))
            .select("source", "nodes", "node", F.col("met.left").alias("item"))
        )
        most = 0 if most == 1 else -(-most // GROUP)
        step += 1
    if not settled:
        return units.select(*_UNIT, F.lit(0).alias("up"))
    every = settled[0]
    for part in settled[1:]:
        every = every.unionAll(part)
    return every.select("source", "s.doc_id", "s.text_key", "s.up")


def mix_sizes(sizes: DataFrame, work: Workspace, seed: int = 0, **targets) -> DataFrame:
    """``sizes`` with source_size, target, copies and taken."""
    goals = work.write(source_targets(sizes, **targets), "targets")
    ups = rounded_copies(sizes, goals, work, seed)
    goals = goals.withColumnRenamed("source", "_source")
    ups = ups.toDF("_source_of", "_doc_id", "_text_key", "up")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    return (
        sizes.join(goals, F.col("source").eqNullSafe(F.col("_source")))
        .join(
            ups,
            F.col("source").eqNullSafe(F.col("_source_of"))
            & F.col("doc_id").eqNullSafe(F.col("_doc_id"))
            & F.col("text_key").eqNullSafe(F.col("_text_key")),
            "left",
        )
        .withColumn("copies", F.coalesce(whole, F.lit(0)) + F.coalesce("up", F.lit(0)))
        .select(
            "doc_id", "source", "text_key", "size", "source_size", "target", "copies",
            (F.col("size") * F.col("copies")).alias("taken"),
        )
    )


_RESULT = ("size", "source_size", "target", "copies", "taken")


def with_mix(docs: DataFrame, result: str, seed: int = 0, **targets) -> DataFrame:
    """``docs`` with the results of ``mix_to_weights`` as the fields of a new column ``result``."""
    doc_id, source, text_key = (free(docs.columns, n) for n in ("_doc_id", "_source", "_text_key"))
    work = Workspace(docs.sparkSession, "mixing")
    mixed = mix_sizes(work.write(document_sizes(docs), "sizes"), work, seed, **targets)
    # Rows that agree in the key have equal results.
    mixed = mixed.dropDuplicates(list(_UNIT)).select(
        F.col("doc_id").alias(doc_id),
        F.col("source").alias(source),
        F.col("text_key").alias(text_key),
        F.struct(*_RESULT).alias(result),
    )
    return docs.join(
        mixed,
        F.col("doc_id").eqNullSafe(F.col(doc_id))
        & F.col("source").eqNullSafe(F.col(source))
        & F.xxhash64("text").eqNullSafe(F.col(text_key)),
    ).select(*all_but(docs.columns), result)


def mix_to_weights(docs: DataFrame, seed: int = 0, **targets) -> DataFrame:
    """Add size, source_size, target, copies and taken to ``docs`` (doc_id, text, source, ...).

    ``copies`` says how often the mix takes the row: 0, 1 or 2 at the default bound. Sources are
    weighed by ``weights`` in order of their names (null is a source, the last), share ``share`` of
    all words, and stop at ``most_copies`` times their size. Null and empty texts have size 0 and
    the whole part of their source's copy number. Rows that agree in doc_id, source and text are
    taken equally often. An empty table gives an empty table. Input columns that bear a result's
    name are replaced.
    """
    kept = all_but(docs.columns, _RESULT)
    result = free(docs.columns, "_mixed")
    return with_mix(docs.select(*kept), result, seed, **targets).select(*kept, f"{result}.*")
