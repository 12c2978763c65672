"""The pipeline's stages on a small table, and that nothing else needs the package."""

import re
import subprocess
import sys
from pathlib import Path

import corpus_pipeline
from pyspark.sql import functions as F

from shiftline.llm import pii, stages
from shiftline.llm.workspace import release
from test_documents import DOCS

ROOT = Path(__file__).resolve().parents[2]


def test_stages(spark, tmp_path):
    words = {"en": "the of and to in that was", "de": "der die und das nicht ist ein"}
    rows = []
    for i in range(60):
        lang = sorted(words)[i % 2]
        own = words[lang].split()
        text = " ".join(own[(i * k + k * k) % 7] + str(i % 5) * (k % 2) for k in range(40 + i))
        rows.append((i, f"{text} mail{i}@example.com", lang, f"s{i % 3}", len(text)))
    rows += [(100 + i, rows[4][1], "en", "s9", 1) for i in range(20)]
    rows += [(200, None, None, None, None), (201, "12 34", "en", "s1", 5), (202, "", "de", "s1", 0)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if name != "packing":
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        if name == "language_id":
            assert docs.count() == 80
        if name == "near_duplicates":
            assert docs.where("doc_id >= 100").count() == 0
            assert docs.where("doc_id = 4").count() == 1
        if name == "personal_data":
            assert docs.where("text LIKE '%@%'").count() == 0
    assert docs.agg(F.max(F.col("offset") + F.col("length"))).first()[0] <= 4096
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == docs.count()
    release(spark)


def test_stages_keep_other_columns(spark):
    """Nulls, repeated rows, an empty table, and columns named like those that stages add."""
    words = "the of and to in that was on for with as by".split()
    texts = [" ".join(words[(i * k + k) % len(words)] + str(i) * (k % 2) for k in range(30)) for i in range(8)]
    rows = [(i, t, "en", f"s{i % 2}", len(t)) for i, t in enumerate(texts)]
    rows += [(7, texts[7], "en", "s1", len(texts[7])), (None, texts[2], "en", None, None), (20, None, None, None, None), (21, "", "en", "s0", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    names = ("_found", "_Spans", "_mixed", "_doc_id", "_source", "_text_key", "_copy", "copies", "size", "kept", "odd.name")
    wide = docs.select("*", *(F.concat(F.lit(f"{n} "), "doc_id").alias(n) for n in names))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        plain = stage(spark, docs, "").collect()
        found = stage(spark, wide, "")
        assert found.columns == wide.columns
        found = found.collect()
        assert sorted(map(str, (r[:5] for r in found))) == sorted(map(str, (r[:] for r in plain))), name
        for row in found:
            assert all(row[n] == (None if row.doc_id is None else f"{n} {row.doc_id}") for n in names), name
        empty = stage(spark, wide.limit(0), "")
        assert (empty.columns, empty.count()) == (wide.columns, 0)
    packed = corpus_pipeline.STAGES[-1][1]
    assert packed(spark, wide, "").count() == len(rows)
    assert packed(spark, wide.limit(0), "").count() == 0
    release(spark)


def test_the_rest_does_not_need_the_package():
    code = (
        "import sys; sys.modules['shiftline.llm'] = None; import __spark_entry__ as e;"
        "assert not any(n.startswith('op') or n == 'pipeline' for n in e.queries()); e.oracle_sql()"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


def test_one_kind_of_python_worker_per_task(spark):
    """A second Python step in a task, and rows from a list on the driver, take workers of their own,
    which stay on the executors.
    """
    explained = lambda df: df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    texts = ["Ann: ann@example.com, call +1 (743) 555-3824.", "card 4111 1111 1111 1111, 10.0.0.1", "in 2024", "", None]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], DOCS)
    masked = stages.masked(spark, docs, "")
    assert len(re.findall(r"^\(\d+\) ArrowEvalPython", explained(masked), re.MULTILINE)) == 1
    found = docs.withColumn("spans", pii.personal_spans())
    apart = found.select("doc_id", pii.mask_spans("text", F.col("spans")), F.size("spans")).collect()
    apart = {i: (t, len(t or "") if n else len(texts[i] or "")) for i, t, n in apart}
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in masked.collect()} == apart
    spark.range(6).selectExpr("id AS doc_id", "repeat('word ', CAST(id AS INT)) AS text").createOrReplaceTempView("d")
    places = stages.packed(spark, spark.table("d"), "")
    assert "ExistingRDD" not in explained(places)
    assert places.agg(F.sum("length")).first()[0] == 15 * 1 + 6 and places.count() == 6
    assert stages.packed(spark, spark.table("d").limit(0), "").count() == 0
    release(spark)
