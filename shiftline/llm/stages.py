"""The stages of the corpus pipeline. Each takes (spark, docs, sf_dir) and returns a DataFrame.

All but the last return the columns they were given, whatever else they hold. Documents need doc_id,
text, lang and source, and may hold any other columns: names that a stage needs for itself are
chosen apart from theirs. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftline.llm import language_id
from shiftline.llm.columns import all_but, free
from shiftline.llm.mixing import with_mix
from shiftline.llm.near_dup import near_duplicates
from shiftline.llm.packing import pack_documents
from shiftline.llm.pii import mask_spans


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that language identification rejects: those without a letter (null and
    empty texts among them), and those far from every language that the labelled rows teach.

    Rows that repeat each other stay or go together; a null in another column changes nothing.
    """
    found = free(docs.columns, "_found")
    judged = docs.withColumn(found, language_id.predicted(language_id.fit(docs)))
    return judged.where(~F.col(f"{found}.rejected")).select(*all_but(docs.columns))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near duplicates.

    Rows that repeat a doc_id are one document. Rows without a doc_id are not compared and stay.
    """
    found = near_duplicates(docs).where("doc_id = component_id").select("doc_id").distinct()
    named = docs.where("doc_id IS NOT NULL")
    first = named.join(found, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return first.select(*all_but(docs.columns)).unionAll(docs.where("doc_id IS NULL"))


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by [EMAIL], [IP], [CARD] and [PHONE]; n_chars, if there, follows.

    Every row stays. Null and empty texts stay as they are; equal texts are masked alike.
    """
    result = free(docs.columns, "_masked")
    changed = docs.withColumn(result, mask_spans("text"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        # What is masked holds a digit or an @, which its mask does not, so a masked text differs.
        length = F.when(~F.col("text").eqNullSafe(F.col(result)), F.char_length(result).cast(kind))
        changed = changed.withColumn("n_chars", length.otherwise(F.col("n_chars")))
    return changed.withColumn("text", F.col(result)).select(*all_but(docs.columns))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; those taken 0 times go.

    A null source is a source of its own; null and empty texts have size 0 and come as often as the
    whole part of their source's copy number says. Rows that agree in doc_id, source and text are
    taken equally often.
    """
    result = free(docs.columns, "_mixed")
    copies = F.col(f"{result}.copies").cast("int")
    return (
        with_mix(docs, result)
        .where(copies > 0)
        .withColumn(free(docs.columns, "_copy"), F.explode(F.sequence(F.lit(1), copies)))
        .select(*all_but(docs.columns))
    )


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows with their places in sequences; the columns are those of packing.

    Null and empty texts are documents of the end id alone. Rows that repeat are packed each for itself.
    """
    return pack_documents(docs).drop("ids")
