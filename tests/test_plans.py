"""Plan shape: flattens are one narrow stage with no Python and a single parse."""

from unfurl import BM, CEP_XML, SCAN, flatten_json, flatten_xml


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _src(spark):
    return spark.createDataFrame(
        [("p", "s", "{}", "{}", '{"text":"<Envelope/>"}', "t")],
        "pk string, sk string, scanResponse string, bmResponse string, cepPayload string, upsertTimestamp string",
    )


def test_json_flatten_plan(spark):
    for spec, col in ((SCAN, "scanResponse"), (BM, "bmResponse")):
        plan = _plan(flatten_json(_src(spark), col, spec))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
        assert "Exchange" not in plan
        assert plan.count("parseJson") == 1, "document must be parsed exactly once"
        filters = [line for line in plan.split("\n") if " Filter " in line]
        assert all("isnotnull" in f and "parseJson" not in f and "from_json" not in f for f in filters)


def test_xml_flatten_plan(spark):
    plan = _plan(flatten_xml(_src(spark), "cepPayload", CEP_XML))
    assert "BatchEvalPython" not in plan and "Exchange" not in plan
    assert plan.count("parseJson") == 1
    assert plan.count("from_xml") == 1


def test_projection_prunes_scan(spark, tmp_dir):
    import os

    path = os.path.join(tmp_dir, "t")
    _src(spark).write.parquet(path)
    plan = _plan(flatten_json(spark.read.parquet(path), "scanResponse", SCAN))
    scan_line = [line for line in plan.split("\n") if "FileScan" in line][0]
    assert "cepPayload" not in scan_line and "bmResponse" not in scan_line


def test_strict_parse_function(spark):
    from pyspark.sql import functions as F

    from unfurl import json_leaf_text, parse_json_strict

    df = spark.createDataFrame([('{"a":{"b":1.50}}',), ('{"a":1} x',), ("nope",), (None,)], "t string")
    got = [r.v for r in df.select(json_leaf_text(parse_json_strict("t"), "$.a.b").alias("v")).collect()]
    assert got == ["1.5", None, None, None]
    assert df.select(parse_json_strict(F.col("t")).isNull().alias("n")).where("n").count() == 3


def test_registered_query_plans(spark):
    """Document building: every line of an order reaches its document, no Python anywhere."""
    import __spark_entry__ as E

    for name in ("scan_flat", "cep_xml_flat", "json_strict_drop"):
        plan = _plan(E.queries()[name](spark, "/root/testdata/sf0.001"))
        assert "EvalPython" not in plan
        assert "Limit" not in plan and "row_number" not in plan, name
        assert plan.count("parseJson") == 1, name


def test_key_filter_reaches_scan(spark, tmp_dir):
    """A filter on a lineage key is pushed through the row filter into the parquet scan."""
    import os

    path = os.path.join(tmp_dir, "k")
    _src(spark).write.parquet(path)
    out = flatten_json(spark.read.parquet(path), "scanResponse", SCAN).where("pk = 'p'").select("pk", "ret_code")
    plan = _plan(out)
    scan_line = [line for line in plan.split("\n") if "FileScan" in line][0]
    assert "IsNotNull(pk)" in scan_line and "EqualTo(pk,p)" in scan_line
    assert out.count() == 1


def test_null_payloads_are_skipped_at_the_scan(spark, tmp_dir):
    import os

    path = os.path.join(tmp_dir, "pushed")
    _src(spark).write.parquet(path)
    for df, col in ((flatten_json(spark.read.parquet(path), "scanResponse", SCAN), "scanResponse"),
                    (flatten_xml(spark.read.parquet(path), "cepPayload", CEP_XML), "cepPayload")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert f"PushedFilters: [IsNotNull({col})]" in plan
        assert plan.count("parseJson") == 1


def test_document_builder_joins_legs_first(spark):
    from workloads.registry import scan_payloads

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(scan_payloads(spark, "/root/testdata/sf0.001"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 4  # lines, orders, both by customer


def test_each_document_is_built_once(spark):
    # the condition on the payload stands over the finished text: not below a repartition, not beside a second copy of the document's expression
    from conftest import SF_SMALL
    from workloads import registry as R

    for name, start in (("scan_flat", "to_json|StructsToJson"), ("json_strict_drop", "to_json|StructsToJson"), ("cep_xml_flat", "concat(<Envelope"), ("bm_every_field", "replace({")):
        plan = R.QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
        builders = [line for line in plan.split("\n") if any(s in line for s in start.split("|"))]
        assert len(builders) == 1 and "Generate explode(array(" in builders[0], (name, [b[:100] for b in builders])


def test_export_files_are_dealt_by_number(spark):
    # compressed files are not split: as many as there are splits of a small table would leave most tasks without work
    from conftest import SF_SMALL
    from workloads import registry as R

    for name in ("unnest_nested", "read_export_all"):
        files = R.QUERIES[name](spark, SF_SMALL).inputFiles()
        assert len(files) == spark.sparkContext.defaultParallelism, (name, files)


def test_xml_names_are_looked_up_in_sets(spark):
    # not searched one by one in arrays, nor put into a new set for every document
    plan = flatten_xml(_src(spark), "cepPayload", CEP_XML)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("INSET") >= 4 and "array_except(transform(split(" not in plan
