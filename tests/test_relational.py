"""Relational operators, sources and sinks (FIXTURES.md section 5, SURVEY 2.1-2.4)."""

import gzip
import json
import os

import pandas as pd

from unfurl import apply_mapping, map_to_columns, previous_day, read_export, sql_file, sql_over
from unfurl.sinks.files import CSV_OPTIONS, write_parquet, write_single_csv


def test_previous_day_window(spark):
    stamps = ["2024-01-01 00:00:00", "2024-01-01T23:59:59.999", "2024-01-02 00:00:00",
              "2024-01-02 00:00:00.000001", "2023-12-31 23:59:59.999999", "2024-01-01T23:30:00-05:00",
              "bad", "", None, "1704067200"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(stamps)], "i int, upsertTimestamp string")
    inc = sorted(r.i for r in previous_day(df, run_date="2024-01-02").collect())
    half = sorted(r.i for r in previous_day(df, run_date="2024-01-02", inclusive_end=False).collect())
    assert inc == [0, 1, 2]
    assert half == [0, 1]


def test_previous_day_defaults_to_current_date(spark):
    df = spark.sql("SELECT CAST(CAST(date_sub(current_date(), 1) AS TIMESTAMP) AS STRING) AS upsertTimestamp")
    assert previous_day(df).count() == 1


def test_apply_mapping_renames_casts_drops(spark):
    df = spark.createDataFrame([("1", "2.5", "x", "zz")], "A string, b string, c string, extra string")
    out = apply_mapping(df, [("a", "string", "id", "int"), ("B", "string", "amount", "double"), ("c", "string", "c", "int")])
    assert out.columns == ["id", "amount", "c"]
    assert out.first().asDict() == {"id": 1, "amount": 2.5, "c": None}


def test_map_to_columns(spark):
    df = spark.sql("SELECT 'k1' AS pk, map('a', '1', 'b', '2') AS m")
    r = map_to_columns(df, "m", ["a", "b", "missing"], keep=["pk"]).first()
    assert r.asDict() == {"pk": "k1", "a": "1", "b": "2", "missing": None}


def test_sql_over_and_file(spark, tmp_dir):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id int, v string")
    b = spark.createDataFrame([(1, "p")], "id int, w string")
    q = "SELECT a.id, a.v, b.w FROM {a} a LEFT JOIN {b} b ON a.id = b.id"
    assert sorted(tuple(r) for r in sql_over(spark, q, {"a": a, "b": b}).collect()) == [(1, "x", "p"), (2, "y", None)]
    path = os.path.join(tmp_dir, "q.sql")
    with open(path, "w") as f:
        f.write("SELECT a.id, b.w\nFROM a\nJOIN b ON a.id = b.id;\n")
    assert [tuple(r) for r in sql_file(spark, path, {"a": a, "b": b}).collect()] == [(1, "p")]


def test_unnest_typed_and_read_export(spark, tmp_dir):
    items = [
        {"Item": {"pk": {"S": "p1"}, "n": {"N": "5"}, "b": {"BOOL": True}, "z": {"NULL": True},
                  "m": {"M": {"k": {"S": "v"}}}}},
        {"Item": {"pk": {"S": "p2"}}},
    ]
    path = os.path.join(tmp_dir, "export")
    os.makedirs(path)
    with gzip.open(os.path.join(path, "part-0.json.gz"), "wt") as f:
        for it in items:
            f.write(json.dumps(it) + "\n")
    rows = sorted(read_export(spark, path, ["pk", "n", "b", "z", "m", "absent"]).collect())
    # nested data folder next to a manifest: recursive scan, manifest filtered out
    nested = os.path.join(tmp_dir, "root")
    os.makedirs(os.path.join(nested, "data"))
    with gzip.open(os.path.join(nested, "data", "part-0.json.gz"), "wt") as f:
        for it in items:
            f.write(json.dumps(it) + "\n")
    with open(os.path.join(nested, "manifest-summary.json"), "w") as f:
        f.write('{"itemCount": 2}\n')
    again = read_export(spark, nested, ["pk"], recursive=True, file_glob="*.json.gz")
    assert sorted(r.pk for r in again.collect()) == ["p1", "p2"]
    assert rows[0].asDict() == {"pk": "p1", "n": "5", "b": "true", "z": None, "m": '{"k":"v"}', "absent": None}
    assert rows[1].asDict() == {"pk": "p2", "n": None, "b": None, "z": None, "m": None, "absent": None}


def test_single_csv_matches_pandas_text(spark, tmp_dir):
    data = [("a,b", 'say "hi"', "line1\nline2"), ("  padded  ", "", None), ("plain", "x", "y")]
    df = spark.createDataFrame(data, "c1 string, c2 string, c3 string").coalesce(1)
    out = os.path.join(tmp_dir, "out.csv")
    write_single_csv(df, out)
    parts = [p for p in os.listdir(out) if p.startswith("part-")]
    assert len(parts) == 1
    spark_text = open(os.path.join(out, parts[0])).read()
    pandas_text = pd.DataFrame(data, columns=["c1", "c2", "c3"]).to_csv(index=False)
    assert spark_text == pandas_text


def test_parquet_sink_round_trip(spark, tmp_dir):
    df = spark.createDataFrame([("1", None), ("2", "x")], "a string, b string")
    path = os.path.join(tmp_dir, "p")
    write_parquet(df, path)
    write_parquet(df.limit(1), path)  # overwrite, not append
    assert spark.read.parquet(path).count() == 1
    assert spark.read.options(**CSV_OPTIONS).csv  # options usable for reading back


def test_export_keeps_every_attribute_and_rejects_bad_lines(spark, tmp_dir):
    from unfurl.sources import export_lines, export_rejects

    path = os.path.join(tmp_dir, "all")
    os.makedirs(path)
    deep = {"M": {"name": {"S": 'x "q"\n'}, "n": {"N": "1.50"}, "l": {"L": [{"BOOL": True}, {"NULL": True}, {"M": {"k": {"S": "v"}}}, {"SS": ["a"]}]}}}
    lines = [json.dumps({"Item": {"pk": {"S": "p1"}, "stationCode": {"S": "DFW"}, "deep": deep}}), json.dumps({"Item": {"pk": {"S": "p2"}, "extra": {"L": []}}}),
             '{"Item":{"pk":{"S":"p3"}}} trailing', '{"Item":', "", '{"other":1}', json.dumps({"Item": {"it\'s": {"S": "1"}, "pk": {"S": "p4"}}})]
    with open(os.path.join(path, "part-0.json"), "w") as f:
        f.write("\n".join(lines))
    df = read_export(spark, path)
    assert sorted(df.columns) == sorted(["pk", "stationCode", "deep", "extra", "it\'s"])
    rows = {r.pk: r for r in df.collect()}
    assert set(rows) == {"p1", "p2", "p4"}
    assert rows["p1"].stationCode == "DFW" and rows["p4"]["it\'s"] == "1"
    assert json.loads(rows["p1"].deep) == {"name": 'x "q"\n', "n": 1.5, "l": [True, None, {"k": "v"}, {"SS": ["a"]}]}
    assert rows["p2"].extra == "[]" and '"n":1.50' in rows["p1"].deep
    assert sorted(r.line for r in export_rejects(export_lines(spark, path), "value").collect()) == sorted([lines[2], lines[3], lines[5]])


def test_csv_round_trip_keeps_line_breaks(spark, tmp_dir):
    from unfurl.sinks.files import CSV_READ_OPTIONS, write_csv

    df = spark.createDataFrame([("a", 'x\ny "z", w'), ("b", "plain")], "k string, v string")
    path = os.path.join(tmp_dir, "csv")
    write_csv(df, path)
    back = spark.read.options(**CSV_READ_OPTIONS).schema(df.schema).csv(path)
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in df.collect())


def test_mapping_resolves_names_in_a_case_sensitive_session(spark):
    df = spark.createDataFrame([("1", "x")], "PK string, scanresponse string")
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        assert apply_mapping(df, [("pk", "string", "pk", "string"), ("scanResponse", "string", "s", "string")]).collect()[0].s == "x"
    finally:
        spark.conf.unset("spark.sql.caseSensitive")
