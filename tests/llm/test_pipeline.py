"""Each pipeline stage against brute force over what its predecessor kept."""

import base64

import corpus_pipeline
import duckdb
import public_tokenizers as P
import tiktoken
from pyspark.sql import functions as F
from test_mixing import brute as brute_mix
from test_simhash_dedup import brute_report

from unfurl.llm import langid
from unfurl.llm.common import stored, table
from unfurl.llm.oracles import ORACLE

SF = "/root/testdata/sf0.01"


def test_stages(spark, tmp_dir):
    docs = table(spark, SF, "documents")
    far = spark.createDataFrame([(10**6 + i, "漢字仮名交じり文 の 例文 です 。 " * 30, "en", "src0", 1) for i in range(3)], docs.schema)
    docs = stored(docs.unionByName(far), "pipeline-test")
    columns, kept = docs.columns, {}
    for (name, stage), check in zip(corpus_pipeline.STAGES, [quality, language, dedup, mix, tokens]):
        out = stored(stage(spark, docs, SF), "pipeline-test")
        check(spark, docs, out, tmp_dir)
        kept[name] = out.count()
        if check is not tokens:
            assert out.columns == columns
        docs = out
    assert all(kept.values())


def quality(spark, before, out, tmp_dir):
    con = duckdb.connect()
    before.toPandas().to_parquet(f"{tmp_dir}/documents.parquet")
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_dir}/documents.parquet'")
    want = sorted(r[0] for r in con.sql(f"SELECT doc_id FROM ({ORACLE['op4_quality_divergence']}) WHERE kept").fetchall())
    assert sorted(r.doc_id for r in out.collect()) == want


def language(spark, before, out, tmp_dir):
    ids = {r.doc_id for r in out.collect()}
    gone = {r.doc_id for r in before.collect()} - ids
    assert len(gone) <= 0.005 * before.count() and not any(i >= 10**6 for i in ids)
    report = {r.doc_id for r in langid.language_report(before).where("NOT rejected").collect()}
    assert ids == report


def dedup(spark, before, out, tmp_dir):
    want = sorted({c for _, _, c in brute_report([(r.doc_id, r.text) for r in before.collect()])})
    assert sorted(r.doc_id for r in out.collect()) == want


def mix(spark, before, out, tmp_dir):
    want = []
    for i, size, _, _, taken in brute_mix([(r.doc_id, r.source, r.text) for r in before.collect()]):
        want += [i] * (taken // size)
    assert sorted(r.doc_id for r in out.collect()) == want


def tokens(spark, before, out, tmp_dir):
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = sorted((r.doc_id, library.encode_ordinary(r.text)) for r in before.collect())
    assert sorted((r.doc_id, list(r.token_ids)) for r in out.collect()) == want


def test_run_and_repeated_rows(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "lang", "source", "n_chars", "token_ids"] and out.count() > 0
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    docs = docs.unionByName(docs).withColumn("fp", F.lit("x")).withColumn("node", F.lit(None).cast("int"))
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = stored(stage(spark, docs, ""), "pipeline-test")
    assert docs.count() > 0 and docs.columns[-2:] == ["fp", "node"]


def test_empty_table(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents").where(F.lit(False))
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, ""), "pipeline-test")
        assert docs.count() == 0
