"""Kept rows and rejects from one parse agree with the two single passes."""

import json
import os
import random

import pytest

from test_differential import _docs
from test_differential_xml import _doc
from unfurl import CEP_XML, SCAN, flatten_json, flatten_xml, json_outcomes, json_rejects, write_outcomes, xml_outcomes, xml_rejects


def _rows(df):
    return sorted((json.dumps(r.asDict(), sort_keys=True) for r in df.collect()))


@pytest.mark.parametrize("kind", ["json", "xml"])
def test_outcomes_are_those_of_two_passes(spark, tmp_dir, kind):
    rnd = random.Random(4)
    spec, docs = (SCAN, _docs(SCAN, 250, 12)) if kind == "json" else (CEP_XML, [_doc(rnd, CEP_XML) for _ in range(250)] + [None, "nope"])
    flatten, rejects, outcomes = (flatten_json, json_rejects, json_outcomes) if kind == "json" else (flatten_xml, xml_rejects, xml_outcomes)
    df = spark.createDataFrame([(f"p{i}", "s", d, "t") for i, d in enumerate(docs)], "pk string, sk string, doc string, upsertTimestamp string")
    tagged = outcomes(df, "doc", spec)
    plan = tagged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson") == 1 and "Exchange" not in plan and "EvalPython" not in plan
    done = write_outcomes(tagged, os.path.join(tmp_dir, "out"), spec)
    kept, dropped = flatten(df, "doc", spec), rejects(df, "doc", spec)
    assert done.kept.columns == kept.columns and done.rejects.columns == dropped.columns
    assert _rows(done.kept) == _rows(kept) and _rows(done.rejects) == _rows(dropped)
    assert sum(done.counts.values()) == len(docs) and done.counts["kept"] == kept.count() > 20
    assert {r.reject_reason: r["count"] for r in dropped.groupBy("reject_reason").count().collect()} == {k: v for k, v in done.counts.items() if k != "kept"}


def test_empty_table(spark, tmp_dir):
    df = spark.createDataFrame([], "pk string, sk string, doc string, upsertTimestamp string")
    done = write_outcomes(json_outcomes(df, "doc", SCAN), os.path.join(tmp_dir, "out"), SCAN)
    assert done.counts == {} and done.kept.count() == 0 and done.rejects.count() == 0
