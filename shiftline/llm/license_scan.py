"""License scan by ordered signature rules. DataFrame operations only, and no shuffle.

A text is lower-cased (A-Z) and its words are joined by one blank. Rules (``license_rules``) are
tried where their keyword occurs. A detection is a run of words. Of two detections of which one
contains the other, the one of higher priority stays; at equal priority the longer one, then the
earlier rule. Rows without any gate literal, the great majority, are only counted.
"""

from __future__ import annotations

import string
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftline.llm.columns import all_but, free
from shiftline.llm.license_rules import GATES, Rule, rules

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

BASE = (
    ("cc-by", "cc by"),
    ("gpl", "general public license"),
    ("reserved", "all rights reserved"),
)


def _normal(text: Column) -> Column:
    """' word word ... word ': every word stands between blanks."""
    lower = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    words = F.trim(F.regexp_replace(lower, _BETWEEN, " "))
    return F.when(words == "", F.lit("")).otherwise(F.concat(F.lit(" "), words, F.lit(" ")))


def _places(normal: Column, pattern: Column) -> Column:
    """Array of (start, end): word numbers from 0, the end exclusive, of all leftmost matches."""
    marked = F.regexp_replace(
        normal, F.concat(F.lit(" ("), pattern, F.lit(")(?= )")), F.lit(" \u0001$1\u0002")
    )
    words = F.split(marked, " ")

    def numbered(mark: str, shift: int) -> Column:
        at = F.transform(words, lambda w, i: F.when(F.contains(w, F.lit(mark)), i + shift))
        return F.filter(at, lambda i: i.isNotNull())

    # The split's first item is the empty text before the first blank.
    return F.zip_with(
        numbered("\u0001", -1),
        numbered("\u0002", 0),
        lambda a, b: F.struct(a.cast("long").alias("start"), b.cast("long").alias("end")),
    )


def _rule_table(table: list[Rule]) -> Column:
    return F.array(
        *(
            F.struct(
                F.lit(i).alias("number"),
                F.lit(r.label).alias("label"),
                F.lit(r.keyword).alias("keyword"),
                F.lit(f"(?:{r.pattern})").alias("pattern"),
                F.lit(r.priority).alias("priority"),
            )
            for i, r in enumerate(table)
        )
    )


def _farthest_before(ends: Column) -> Column:
    """For every item the largest one before it, -1 for the first.

    Each round doubles the distance that a maximum has come, so n items take log2(n) rounds.
    """
    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.size(ends) + 1)).cast("int"))

    def moved(items: Column, by: Column) -> Column:
        by = F.least(by, F.size(items))
        return F.concat(F.array_repeat(F.lit(-1).cast("long"), by), F.slice(items, 1, F.size(items) - by))

    return F.aggregate(
        rounds,
        moved(ends, F.lit(1)),
        lambda items, k: F.zip_with(
            items, moved(items, F.call_function("shiftleft", F.lit(1), k)), lambda a, b: F.greatest(a, b)
        ),
    )


def _not_contained(found: Column, priorities: list[int]) -> Column:
    """The detections that no stronger one contains, by place.

    In the order by start, then falling end, falling priority and rule, whatever can take a
    detection's place comes before it. So one goes if one of its priority or a higher one before it
    reaches as far.
    """

    def key(d: Column) -> Column:
        return F.struct(
            d["start"].alias("start"), (-d["end"]).alias("end"), (-d["priority"]).alias("priority"),
            d["number"].alias("number"), d["label"].alias("label"),
        )

    ordered = F.transform(
        F.array_sort(F.transform(found, key)),
        lambda d: F.struct(
            d["start"].alias("start"), (-d["end"]).alias("end"), d["label"].alias("label"),
            (-d["priority"]).alias("priority"), d["number"].alias("number"),
        ),
    )

    def kept_of(every: Column, priority: Column) -> Column:
        ends = F.transform(every, lambda d: F.when(d["priority"] >= priority, d["end"]).otherwise(-1))
        left = F.zip_with(every, _farthest_before(ends), lambda d, far: F.when(
            (d["priority"] == priority) & (far < d["end"]), d))
        return F.when(
            F.exists(every, lambda d: d["priority"] == priority),
            F.filter(left, lambda d: d.isNotNull()),
        ).otherwise(F.slice(every, 1, 0))

    def kept(every: Column) -> Column:
        levels = F.array(*map(F.lit, priorities))
        return F.array_sort(F.flatten(F.transform(levels, lambda p: kept_of(every, p))))

    # Most texts have one detection or none. The order is worked out once, as a list's only item.
    return F.when(F.size(found) < 2, found).otherwise(
        F.flatten(F.transform(F.array(ordered), kept))
    )


def scan_licenses(docs: DataFrame, table: list[Rule] | None = None, text: str = "text") -> DataFrame:
    """Add to ``docs``: n_words, license_base, license_spans, license_labels and license_score.

    ``license_base``: (label, start, end) of the base phrases. ``license_spans``: (start, end,
    label, priority, number) of what the rules found and no stronger detection contains, by place.
    ``license_labels``: the distinct labels of both, sorted. ``license_score``: the highest priority
    / 100 among the detections, else 0. Word numbers count from 0, ends are exclusive. Null and
    empty texts have no words and no detections. Equal rows give equal rows; an empty table gives an
    empty table. Input columns that bear a result's name are replaced.
    """
    table = rules() if table is None else table
    results = ("n_words", "license_base", "license_spans", "license_labels", "license_score")
    kept = all_but(docs.columns, results)
    in_normal, in_base, in_all = (free(docs.columns, c) for c in ("_normal", "_base", "_all"))
    raw = F.coalesce(F.col(text), F.lit(""))
    lowered = F.lower(raw)
    gated = reduce(or_, (F.contains(lowered, F.lit(g)) for g in GATES))
    base_type = "array<struct<label:string,start:bigint,end:bigint>>"
    # Within the array, so that only gated rows compute it and they do so once.
    normal = F.when(gated, F.array(_normal(raw))).otherwise(F.array().cast("array<string>"))
    words = F.size(F.regexp_extract_all(raw, F.lit(_WORD_ANY_CASE), F.lit(0)))
    step = docs.select(*kept, words.cast("long").alias("n_words"), normal.alias(in_normal))

    def phrase_places(n: Column, label: str, phrase: str) -> Column:
        def named(p: Column) -> Column:
            return F.struct(
                F.lit(label).alias("label"), p["start"].alias("start"), p["end"].alias("end")
            )

        found = F.transform(_places(n, F.lit(phrase)), named)
        return F.when(F.contains(n, F.lit(f" {phrase} ")), found).otherwise(
            F.array().cast(base_type)
        )

    def base_places(n: Column) -> Column:
        return F.concat(*(phrase_places(n, label, phrase) for label, phrase in BASE))

    def detections(n: Column) -> Column:
        likely = F.filter(
            _rule_table(table),
            lambda r: F.contains(n, r["keyword"])
            & F.rlike(n, F.concat(F.lit(" "), r["pattern"], F.lit(" "))),
        )
        return F.flatten(
            F.transform(
                likely,
                lambda r: F.transform(
                    _places(n, r["pattern"]),
                    lambda p: F.struct(
                        p["start"].alias("start"),
                        p["end"].alias("end"),
                        r["label"].alias("label"),
                        r["priority"].alias("priority"),
                        r["number"].alias("number"),
                    ),
                ),
            )
        )

    step = step.withColumn(in_base, F.transform(in_normal, base_places)).withColumn(
        in_all, F.transform(in_normal, detections)
    )
    priorities = sorted({r.priority for r in table})
    step = step.select(
        *kept,
        "n_words",
        F.array_sort(F.flatten(in_base)).alias("license_base"),
        F.flatten(
            F.transform(in_all, lambda every: _not_contained(every, priorities))
        ).alias("license_spans"),
    )
    labels = F.concat(
        F.transform("license_base", lambda b: b["label"]),
        F.transform("license_spans", lambda d: d["label"]),
    )
    return step.withColumn("license_labels", F.array_sort(F.array_distinct(labels))).withColumn(
        "license_score",
        F.coalesce(
            F.array_max(F.transform("license_spans", lambda d: d["priority"])) / 100, F.lit(0.0)
        ),
    )
