"""Quality rules: base columns by brute force, the verdict by SQL (test_oracles), odd rows."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from unfurl.llm import quality as Q
from unfurl.llm.common import table

SF = "/root/testdata/sf0.01"


def brute_base(text):
    t = text or ""
    ws = re.findall(r"[^\x20\x09-\x0D]+", t)
    windows = Counter(tuple(ws[i:i + 3]) for i in range(len(ws) - 2))
    covered = {j for i in range(len(ws) - 2) if windows[tuple(ws[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in t), dup, len(covered)


def check_base(df, texts):
    got = {r.doc_id: r for r in Q.quality_report(df).collect()}
    for i, t in texts.items():
        g, want = got[i], brute_base(t)
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) == want, (i, t[:200] if t else t)
        assert g.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])


def test_base_columns_of_a_whole_table(spark):
    docs = table(spark, SF, "documents")
    check_base(docs, {r.doc_id: r.text for r in docs.collect()})


def test_base_columns_of_random_texts(spark):
    rng = random.Random(5)
    pieces = ["a", "b", "ab", "é", "中文", "😀", "#", "$x", "\n", "\n", " ", "\t", "\x0b", "\x1f", "\xa0", "\x85", "\r"]
    texts = {i: " ".join(rng.choice(pieces) for _ in range(rng.choice([0, 1, 2, 3, 4, 5, 20, 300]))) for i in range(250)}
    texts.update({1000: None, 1001: "", 1002: "a a a", 1003: "a a a a", 1004: "x y z " * 30_000, 1005: "\n".join(["l"] * 9)})
    check_base(spark.createDataFrame([(i, t, "en") for i, t in texts.items()], "doc_id long, text string, lang string"), texts)


def test_positions_beyond_the_packed_bits(spark, monkeypatch):
    monkeypatch.setattr(Q, "_PLACE_BITS", 3)
    monkeypatch.setattr(Q, "_PLACE", 7)
    rng = random.Random(2)
    texts = {i: " ".join(rng.choice("abc") for _ in range(n)) for i, n in enumerate([3, 4, 8, 9, 10, 11, 40, 200])}
    df = spark.createDataFrame(list(texts.items()), "doc_id int, text string")
    got = {r.doc_id: r.n for r in df.select("doc_id", Q.n_repeat_words(F.split("text", " ")).alias("n")).collect()}
    assert got == {i: brute_base(t)[4] for i, t in texts.items()}


def test_clean_documents_stay_and_junk_goes(spark):
    docs = table(spark, SF, "documents")
    got = Q.quality_report(docs).join(table(spark, SF, "labels"), "doc_id").where("NOT base_failed").collect()
    good, bad = [r.kept for r in got if r.quality == 1], [r.kept for r in got if r.quality == 0]
    assert sum(good) >= 0.995 * len(good) and sum(bad) <= 0.5 * len(bad)


def test_distance_is_jensen_shannon(spark):
    df = spark.createDataFrame([([1.0, 0.0],), ([0.5, 0.5],), ([0.0, 1.0],)], "p array<double>")
    got = [r.d for r in df.select(Q.js_distance(F.col("p"), [1.0, 0.0]).alias("d")).collect()]
    assert got == pytest.approx([0.0, 0.5579230452841438, 1.0])


def test_odd_rows(spark):
    docs = table(spark, SF, "documents").where("doc_id < 80")
    more = docs.withColumns({"w": F.lit(1), "n": F.lit("x"), "__other": F.lit(2)})
    twice = more.unionByName(more)
    kept = Q.kept_documents(twice)
    assert kept.columns == twice.columns and kept.count() == 2 * Q.kept_documents(more).count() > 0
    assert Q.quality_report(docs.limit(0)).count() == 0 and Q.kept_documents(docs.limit(0)).count() == 0
    blind = docs.withColumn("lang", F.lit(None).cast("string"))
    assert Q.quality_report(blind).where("kept = base_failed").count() == 0
    no_id = docs.withColumn("doc_id", F.lit(None).cast("long"))
    assert Q.quality_report(no_id).count() == docs.count()
