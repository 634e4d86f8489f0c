"""Language identification: held-out accuracy, independence from labels, odd rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from unfurl.llm import langid as L
from unfurl.llm.common import table

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_fold(spark):
    docs = table(spark, SF, "documents")
    got = {r.doc_id: r for r in L.language_report(docs).collect()}
    rows = docs.select("doc_id", "lang", F.length("text").alias("n")).collect()
    assert len(got) == len(rows)
    assert all(got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if got[r.doc_id].held_out]
    right = sum(got[r.doc_id].lang_pred == r.lang for r in held)
    assert right >= 0.97 * len(held)
    assert all(0 <= g.score <= 1 for g in got.values())
    assert sum(g.rejected for g in got.values()) <= 0.01 * len(rows)


def test_labels_of_held_out_rows_change_nothing(spark):
    docs = table(spark, SF, "documents").where("doc_id < 300")
    other = docs.withColumn("lang", F.when(L.held_out(F.col("doc_id")), "xx").otherwise(F.col("lang")))
    assert sorted(L.language_report(docs).collect()) == sorted(L.language_report(other).collect())


def test_sample_of_a_hot_language(spark):
    """The smallest hashes, and no task ranks more of a language than the slices leave."""
    df = spark.range(0, 60_000, 1, 6).selectExpr("CASE WHEN id % 50 = 0 THEN 'xx' ELSE 'en' END AS lang", "xxhash64(id % 40000) AS h")
    got = {}
    found = L.smallest(df, 7)
    for r in found.collect():
        got.setdefault(r.lang, []).append(r.h)
    rows = {}
    for r in df.collect():
        rows.setdefault(r.lang, set()).add(r.h)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v)[:7] for k, v in rows.items()}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.split("\n") if "+- Window [" in line or line.lstrip().startswith("Window [")]
    assert len(windows) == 2 and "__slice" in windows[1]  # the lower one ranks slices


@pytest.mark.parametrize("n", [1, 3, 8, 20])
def test_a_language_of_few_documents_is_not_rejected(spark, n):
    docs = table(spark, SF, "documents")
    few = sorted(r.doc_id for r in docs.where("lang = 'es' AND length(text) > 400").select("doc_id").collect())[:n]
    model = L.fit(docs.where(F.col("lang").isin("en", "fr") | F.col("doc_id").isin(few)).select("lang", "text"))
    got = L.predict(docs.where("lang = 'es'"), model).where("__lang = 'es'").select("doc_id", "__rejected").collect()
    assert set(few) <= {r.doc_id for r in got if not r["__rejected"]}
    others = [r["__rejected"] for r in got if r.doc_id not in few]
    assert len(others) > 20 and sum(others) <= 0.05 * len(others)
    odd = spark.createDataFrame([(1, "漢字仮名交じり文の例文です。" * 20)], "doc_id long, text string")
    assert all(r["__rejected"] for r in L.predict(odd, model).collect())


def test_few_documents_alone(spark):
    docs = table(spark, SF, "documents").where("lang = 'fr' AND length(text) > 400")
    ids = sorted(r.doc_id for r in docs.select("doc_id").collect())
    model = L.fit(docs.where(F.col("doc_id").isin(ids[:4])).select("lang", "text"))
    got = [r["__rejected"] for r in L.predict(docs, model).collect()]
    assert sum(got) <= 0.05 * len(got)


def test_limits_of_classes_with_few_texts():
    many = (np.full(400, 0.3), np.full(400, 0.2), np.full(400, 3))
    long = (np.append(np.full(200, 0.4), 0.02), np.append(np.full(200, 0.2), -1e-7), np.append(np.full(200, 2), 6))
    single = (np.array([np.nan]), np.array([0.0]), np.array([6]))
    got = L.limits_of([many, long, single])
    assert got[0][3] == pytest.approx(0.3) and got[1][2] == pytest.approx(0.4)
    assert got[1][6] >= 0.3 and min(got[2]) >= 0.3 and min(min(g) for g in got) >= L.FLOOR
    assert min(L.limits_of([single])[0]) == L.FEW


def test_far_texts_are_rejected(spark):
    docs = table(spark, SF, "documents")
    model = L.fit(docs.select("lang", "text"))
    odd = spark.createDataFrame([(1, "漢字仮名交じり文の例文です。" * 20), (2, "12345 !!! ---"), (3, None), (4, "")], "doc_id long, text string")
    got = {r.doc_id: r for r in L.predict(odd, model).collect()}
    assert all(r["__rejected"] for r in got.values())
    assert [got[i]["__lang"] for i in (2, 3, 4)] == ["und"] * 3 and got[3]["__score"] == 0
    assert got[1]["__lang"] in model["langs"]


def test_odd_rows(spark):
    docs = table(spark, SF, "documents").where("doc_id < 60")
    more = docs.withColumn("idf", F.lit("x")).withColumn("centroid", F.lit(1))
    twice = more.unionByName(more).withColumn("source", F.lit(None).cast("string"))
    kept = L.accepted_documents(twice)
    assert kept.columns == twice.columns and kept.count() % 2 == 0
    assert L.language_report(docs.limit(0)).count() == 0
    blind = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score, r.rejected) for r in L.language_report(blind).collect()} == {("und", 0.0, True)}
    null_id = docs.limit(3).withColumn("doc_id", F.lit(None).cast("long"))
    assert L.language_report(null_id).count() == 3


def test_very_long_text_counts_whole():
    t = "abc " * 700_000
    whole = L.ngram_counts(t)
    assert whole.sum() == 3 * (len(t) + 1) - 3
