"""What is no document to a census: short texts are judged where they are counted, as the strict parse judges longer ones."""

import json

from test_census import walked

from unfurl import path_census

PAD = " " * 60_000  # beyond the short texts
DOCS = ['{"n":[NaN,-Infinity,Infinity,1e400,-1E999,1e-400,1.5,-0]}', '{"NaN":"NaN"}', "{NaN:1}", '{"v":-NaN}', '{"v":+1}', '{"v":01}', '{"v":1.}', '{"v":.5}', "{'v':1}", '{"v":1,}', '{"v":1}}', '{"v":1}]', '{"v":1},{"v":2}', '{"v":"\t"}',
        '{"v":"\\x"}', '{"v":"\\ud800"}', '﻿{"v":1}', ' {"v":1}', '\x0c{"v":1}', "", " ", "null", "tru", '{"v":%s}' % ("9" * 4300), '{"v":%s}' % ("9" * 4301), '{"v":-%s}' % ("9" * 4300), '{"v":%s.5}' % ("9" * 5000),
        '{"v":0.%s}' % ("3" * 5000), '{"v":"%s"}' % ("[{" * 600), "[" * 400 + "]" * 400, "[" * 800 + "]" * 799, '{"%s":1}' % ("k" * 40_000), '{"a":1,"a":"x"}', "// c\n1", '{"v":1} // c', "1 2", '"a" "b"']


def _counts(spark, docs):
    df = spark.createDataFrame([(d,) for d in docs], "doc string").repartition(2)
    return {(r.path, r.kind): r.n for r in path_census(df, "doc").collect()}


def test_short_texts_are_judged_as_long_ones(spark):
    apart = [(d, _counts(spark, [d]), _counts(spark, [d + PAD])) for d in DOCS[:3] + DOCS[23:27]]
    assert all(short == long for _, short, long in apart), [a for a in apart if a[1] != a[2]]
    assert _counts(spark, DOCS) == _counts(spark, [d + PAD for d in DOCS])
    one = _counts(spark, ['{"n":[NaN,1e400,1e-400,%s]}' % ("9" * 400)])
    assert one["n[]", "string"] == 2 and one["n[]", "number"] == 2


def test_short_texts_are_not_parsed_twice(spark):
    plan = path_census(spark.createDataFrame([("{}",)], "doc string"), "doc")._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN NOT short" in plan and plan.count("parseJson") == 1


def test_texts_that_are_no_utf8(spark):
    df = spark.sql("SELECT CAST(unhex(hex('{\"a\":\"') || 'FF' || hex('\"}')) AS STRING) AS doc UNION ALL SELECT '{\"a\":1}' UNION ALL SELECT CAST(NULL AS STRING)")
    assert {(r.path, r.kind): r.n for r in path_census(df, "doc").collect()} == {("", "object"): 2, ("a", "string"): 1, ("a", "number"): 1, ("", "missing"): 1}


def test_a_census_of_plain_documents_is_a_walk(spark):
    docs = [json.dumps({"id": i, "who": {"n": str(i), "t": [i, None, {"x": True}]}}) for i in range(500)] + [None]
    assert _counts(spark, docs) == walked(docs)
