"""The queries of the numbered operators: thin forms with fixed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftline.llm import language_id
from shiftline.llm.conversations import damaged, repair_report
from shiftline.llm.license_scan import scan_licenses
from shiftline.llm.embedding_dup import near_embeddings
from shiftline.llm.html_text import extract_main_text
from shiftline.llm.mixing import document_sizes, mix_sizes
from shiftline.llm.near_dup import near_duplicates
from shiftline.llm.oracle import ORACLE_SQL
from shiftline.llm.packing import pack_documents
from shiftline.llm.pii import KINDS, find_personal_data
from shiftline.llm.pivot_search import search_top
from shiftline.llm.repeated_bytes import remove_repeats
from shiftline.llm.suffix_tree import score_texts
from shiftline.llm.whitening import whiten
from shiftline.llm.workspace import Workspace


def _table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet").select(*columns)


def _held_out(parts: int) -> Column:
    """Whether crc32 of the doc_id as text leaves 2; rows without an id are not held out."""
    remainder = F.crc32(F.col("doc_id").cast("string")) % parts
    return F.coalesce(remainder == 2, F.lit(False))


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents", "doc_id", "text", "lang")
    model = language_id.fit(docs.where(~_held_out(4)))
    return language_id.identify(docs, model).select(
        "doc_id", _held_out(4).alias("held_out"), "lang_pred", "score", "rejected"
    )


def op2_html_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages", "page_id", "url", "html")
    return extract_main_text(pages).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars")
    )


def op3_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates(_table(spark, folder, "documents", "doc_id", "text"))
    return found.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def op4_near_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    found = near_embeddings(_table(spark, folder, "embeddings", "vec_id", "embedding"))
    return found.withColumn("kept", F.col("vec_id") == F.col("component_id"))


def op5_mix_to_weights(spark: SparkSession, folder: str) -> DataFrame:
    work = Workspace(spark, "mixing")
    docs = _table(spark, folder, "documents", "doc_id", "text", "source")
    mixed = mix_sizes(work.write(document_sizes(docs), "sizes"), work)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op6_suffix_tree(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents", "doc_id", "text")
    scored = score_texts(docs, ~_held_out(7))
    return scored.select("doc_id", _held_out(7).alias("held_out"), *scored.columns[1:])


def op7_pivot_search(spark: SparkSession, folder: str) -> DataFrame:
    return search_top(_table(spark, folder, "embeddings", "vec_id", "embedding"))


def op8_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents", "doc_id", "text")
    starts = F.transform("license_base", lambda b: b["start"])
    names = F.transform("license_base", lambda b: b["label"])
    return scan_licenses(docs).select(
        "doc_id",
        "n_words",
        F.size("license_base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(names)), ",").alias("base_labels"),
        F.array_join("license_labels", ",").alias("labels"),
        F.col("license_score").alias("score"),
        F.col("license_spans").alias("spans"),
    )


def op9_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    packed = pack_documents(_table(spark, folder, "documents", "doc_id", "text"))
    return packed.select(
        "doc_id",
        "piece",
        "start",
        F.col("length").cast("long").alias("length"),
        "ids_crc32",
        F.col("sequence_id").cast("long").alias("sequence_id"),
        F.col("offset").cast("long").alias("offset"),
    )


def op10_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents", "doc_id", "text")

    def listed(spans: Column) -> Column:
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    base = F.filter("pii_spans", lambda s: s["base"])

    def count(kind: str) -> Column:
        own = F.filter(base, lambda s: s["kind"] == kind)
        return F.size(own).cast("long").alias(f"n_{kind}")

    return find_personal_data(docs).select(
        "doc_id",
        *map(count, KINDS),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("pii_spans")).alias("spans"),
    )


def op11_repeated_bytes(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(_table(spark, folder, "documents", "doc_id", "text"))


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    turns = _table(spark, folder, "conversations", "conv_id", "turn", "role", "text")
    return repair_report(damaged(turns), turns)


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    found = whiten(_table(spark, folder, "embeddings", "vec_id", "embedding"))
    return found.withColumn("deviation", F.col("deviation").cast("long"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_html_text": op2_html_text,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_near_embeddings": op4_near_embeddings,
    "op5_mix_to_weights": op5_mix_to_weights,
    "op6_suffix_tree": op6_suffix_tree,
    "op7_pivot_search": op7_pivot_search,
    "op8_license_scan": op8_license_scan,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_personal_data": op10_personal_data,
    "op11_repeated_bytes": op11_repeated_bytes,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_whitening": op13_whitening,
}

__all__ = ["ORACLE_SQL", "QUERIES"]
