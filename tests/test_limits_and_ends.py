"""Ends of documents, number text, parser limits and element names (README, row rules)."""

import json
import os
import subprocess
import sys

import pytest
from pyspark.errors import PySparkException

from unfurl import CEP_XML, SCAN, FlattenSpec, Group, flatten_json, flatten_xml, json_rejects, xml_rejects

SPEC = FlattenSpec("one", (Group("", ("k",)), Group("legs", ("f",), "leg_", "legs", 2)), key_columns=("pk",))


def _df(spark, docs):
    return spark.createDataFrame([(str(i), d) for i, d in enumerate(docs)], "pk string, doc string")


def _kept(spark, docs, **kw):
    return {int(r.pk): r.k for r in flatten_json(_df(spark, docs), "doc", SPEC, **kw).collect()}


def test_json_text_must_end_with_the_document(spark):
    docs = ['{"k":1}', '{"k":1}] any garbage {{{', '{"k":1}]', '{"k":1}{"k":2}', '{"k":1},2', '{"k":1} x', '{"k":1},5],[1', ' {"k":1}\n']
    assert set(_kept(spark, docs)) == {0, 7}
    labels = {r.pk: r.reject_reason for r in json_rejects(_df(spark, docs), "doc", SPEC).collect()}
    assert labels == {str(i): "malformed" for i in (1, 2, 3, 4, 5, 6)}


def test_xml_text_must_end_with_the_document(spark):
    good = "<Envelope><eventHeader><eventName>E</eventName></eventHeader></Envelope>"
    texts = [good, good + "</w>junk <<<", good + "</w><w>", good + " tail", good + "<unfurl_end_of_document/>", good + "</w>"]
    df = _df(spark, [json.dumps({"text": t}) for t in texts])
    assert [r.pk for r in flatten_xml(df, "doc", CEP_XML, keys=("pk",)).collect()] == ["0"]
    reasons = {r.pk: r.reject_reason for r in xml_rejects(df, "doc", CEP_XML, keys=("pk",)).collect()}
    assert set(reasons) == {"1", "2", "3", "4", "5"} and reasons["3"] == "trailing_text"


def test_number_text_is_the_jvms(spark):
    values = {"5.0": "5.0", "100.0": "100.0", "-0.0": "-0.0", "12345678.9": "1.23456789E7", "0.0001": "1.0E-4", "1e10": "1.0E10", "1.50": "1.5",
              "0.12345678901234567890123": "0.12345678901234568", "123456789012345678901234567890": "123456789012345678901234567890", "7": "7", "true": "true"}
    docs = [f'{{"k":{v}}}' for v in values]
    assert list(_kept(spark, docs).values()) == list(values.values())
    legs = _df(spark, ['{"legs":[{"f":5.0},{"f":0.0001},7]}', '{"legs":[{"f":5.0},7]}'])
    got = [(r.pk, r.leg_0_f, r.leg_1_f) for r in flatten_json(legs, "doc", SPEC).collect()]
    assert got == [("0", "5.0", "1.0E-4")]  # beyond the slots anything may stand


@pytest.mark.parametrize("n_legs", [0, 1, 2, 7, 13])
def test_documents_with_many_legs(spark, n_legs):
    doc = json.dumps({"legs": [{"f": i} for i in range(n_legs)]})
    (r,) = flatten_json(_df(spark, [doc]), "doc", SPEC).collect()
    assert (r.leg_0_f, r.leg_1_f) == tuple(str(i) if i < n_legs else None for i in range(2))
    legs = "".join(f"<bagItineraryDtl><fltNbr>{i}</fltNbr></bagItineraryDtl>" for i in range(n_legs))
    body = f"<bagCurrentItineraries>{legs}</bagCurrentItineraries>" if n_legs else "<x>1</x>"
    xml = f"<Envelope><Body><bagDetails>{body}</bagDetails></Body></Envelope>"
    rows = flatten_xml(_df(spark, [json.dumps({"text": xml})]), "doc", CEP_XML, keys=("pk",)).collect()
    assert len(rows) == (n_legs != 1)


def test_non_finite_numbers(spark):
    values = {"NaN": "NaN", "Infinity": "Infinity", "-Infinity": "-Infinity", "1e400": "Infinity", "-1.5E+999": "-Infinity", "9" * 400 + ".5": "Infinity", "1e-400": "0.0", "9" * 400: "9" * 400,
              '"1e400 NaN"': "1e400 NaN", '"a\\\\"': "a\\", "[NaN,1e400,-Infinity]": '["NaN","Infinity","-Infinity"]', '{"NaN":NaN}': '{"NaN":"NaN"}'}
    docs = [f'{{"k": {v} }}' for v in values]
    assert [v for _, v in sorted(_kept(spark, docs).items())] == list(values.values())
    bad = ["{NaN:1}", '{"k":NaN', '{"k":-NaN}', '{"k":NaNNaN}', '{"k":Infinity1}', '{"k":1NaN}', '{"k":+Infinity}', '{"k":INF}', '{"k":nan}', "NaN", '{"k":"NaN}', '{"k":- Infinity}', '{Infinity : NaN}']
    assert _kept(spark, bad) == {}
    assert [r.reject_reason for r in json_rejects(_df(spark, bad), "doc", SPEC).collect()] == ["not_object" if d == "NaN" else "malformed" for d in bad]
    wrapped = _df(spark, ['{"text":"<Envelope><eventHeader><eventName>E</eventName></eventHeader></Envelope>","x":NaN}'])
    assert flatten_xml(wrapped, "doc", CEP_XML, keys=("pk",)).count() == 1


def test_texts_beyond_the_parsers_limits(spark):
    """Strings of over 20,000,000 characters and numbers of over 1,000 digits: good documents flatten, bad ones are rejects."""
    long = "x" * 20_000_001
    docs = ['{"k":"' + "x" * 19_999_990 + '"}', f'{{"k":"{long}\\n\\u00e9"}}', f'{{"legs":[{{"f":"{long}"}},{{"f":"{"y" * 100}"}}]}}',  # good
            f'{{"k":"{long}"', f'{{"k":"{long}\\q"}}', f'{{"k":"{long}\x01"}}', f'{{"k":"{long}"}} x', f'{{"legs":"{long}"}}', f'["{long}"]', '{"k":"' + long, '{"k":' + "9" * 4301 + "}", "z" * 20_000_001]
    good = {int(r.pk): r for r in flatten_json(_df(spark, docs), "doc", SPEC).selectExpr("pk", "length(k) AS k", "right(k, 2) AS tail", "length(leg_0_f) AS f0", "leg_1_f").collect()}
    assert {i: (r.k, r.tail, r.f0, r.leg_1_f) for i, r in good.items()} == {
        0: (19_999_990, "xx", None, None), 1: (20_000_003, "\né", None, None), 2: (None, None, 20_000_001, "y" * 100)}
    reasons = {int(r.pk): r.reject_reason for r in json_rejects(_df(spark, docs), "doc", SPEC).select("pk", "reject_reason").collect()}
    assert reasons == {**{i: "malformed" for i in range(3, 12)}, 7: "node:legs", 8: "not_object"}
    numbers = {"9" * 1001: "9" * 1001, "-" + "9" * 4300: "-" + "9" * 4300, "0." + "1" * 5000: "0.1111111111111111", "9" * 5000 + "e-5000": "1.0"}
    assert [v for _, v in sorted(_kept(spark, [f'{{"k":{v}}}' for v in numbers]).items())] == list(numbers.values())


def test_beyond_the_size_of_a_variant(spark):
    """Over 100,000,000 bytes of structure: an error by default, never a silent loss."""
    big = spark.range(1).selectExpr("'0' AS pk", "concat('{\"k\":[', repeat('1,', 70000000 + CAST(id AS INT)), '1]}') AS doc")
    with pytest.raises(PySparkException, match="limits"):
        flatten_json(big, "doc", SPEC).selectExpr("length(k)").collect()
    assert flatten_json(big, "doc", SPEC, too_large="drop").count() == 0
    assert [r.reject_reason for r in json_rejects(big, "doc", SPEC).select("reject_reason").collect()] == ["too_large"]


def test_xml_texts_beyond_the_parsers_limits(spark):
    text = lambda n, end="</Envelope>": json.dumps({"text": f"<Envelope><eventHeader><eventName>{'x' * n}</eventName></eventHeader>{end}"})
    df = _df(spark, [text(19_000_000), text(20_000_000), text(20_000_000, ""), text(20_000_000)[:-1], json.dumps({"other": "x" * 20_000_001})])
    got = {r.pk: r.n for r in flatten_xml(df, "doc", CEP_XML, keys=("pk",)).selectExpr("pk", "length(eventName) AS n").collect()}
    assert got == {"0": 19_000_000, "1": 20_000_000}
    reasons = {r.pk: r.reject_reason for r in xml_rejects(df, "doc", CEP_XML, keys=("pk",)).select("pk", "reject_reason").collect()}
    assert reasons == {"2": "malformed_xml", "3": "bad_wrapper", "4": "bad_wrapper"}


@pytest.mark.parametrize("detail,kept", [("&lt;a", False), ("&lt;a&gt;1&lt;/a&gt;", False), ("<é>1</é>", True), ("<a/>", True), ("", True), ("  ", False), ("x", False), ("x<a/>", True)])
def test_scan_detail_is_judged_by_its_structure(spark, detail, kept):
    xml = f"<Envelope><Body><bagDetails><bagScans><bagScanDtl>{detail}</bagScanDtl></bagScans></bagDetails></Body></Envelope>"
    df = _df(spark, [json.dumps({"text": xml})])
    assert flatten_xml(df, "doc", CEP_XML, keys=("pk",)).count() == kept


def _cep(body, start="<Envelope>", before=""):
    return f"{before}{start}<Body><bagDetails>{body}</bagDetails></Body></Envelope>"


SCOPES = {
    "unbound": (_cep("<zz:tagNbr>1</zz:tagNbr>"), None),
    "bound on the root": (_cep("<zz:tagNbr>1</zz:tagNbr>", '<Envelope xmlns:zz="u">'), "1"),
    "bound on itself": (_cep('<zz:tagNbr xmlns:zz="u">1</zz:tagNbr>'), "1"),
    "bound beside": (_cep('<a xmlns:zz="u"/><zz:tagNbr>1</zz:tagNbr>'), None),
    "out of scope": (_cep('<a xmlns:zz="u"><zz:b>1</zz:b></a><zz:tagNbr>2</zz:tagNbr>'), None),
    "in scope, then not used": (_cep('<a xmlns:zz="u"><zz:b>1</zz:b></a><tagNbr>2</tagNbr>'), "2"),
    "unbound attribute": (_cep('<tagNbr q:x="1">1</tagNbr>'), None),
    "only looks like one": (_cep('<!-- <q:z> --><a v="q:w q:x=1"/><tagNbr>q:x=1 <![CDATA[<q:y>]]></tagNbr>'), "q:x=1 <q:y>"),
    "xml prefix": (_cep('<tagNbr xml:lang="en">1</tagNbr>'), "1"),
    "undeclared again": (_cep('<tagNbr xmlns:q="">1</tagNbr>'), None),
    "document type": (_cep("<tagNbr>1</tagNbr>", before="<!DOCTYPE Envelope>"), "1"),
    "document type with entities": (_cep("<tagNbr>&y;</tagNbr>", before='<?xml version="1.0"?>\n<!-- <!DOCTYPE x> --><!DOCTYPE Envelope SYSTEM "a>b" [<!-- ] > --><!ENTITY x "Q]>Z"><!ENTITY y \'&x;!\'>]>\n'), "Q]>Z!"),
    "two document types": (_cep("<tagNbr>1</tagNbr>", before="<!DOCTYPE a><!DOCTYPE b>"), None),
    "document type inside": (_cep("<!DOCTYPE a><tagNbr>1</tagNbr>"), None),
    "undefined entity": (_cep("<tagNbr>&nope;</tagNbr>"), None),
    "other case": (_cep("<TAGNBR>7</TAGNBR><x>1</x>"), ""),
    "both cases": (_cep("<TAGNBR>7</TAGNBR><tagNbr>8</tagNbr>"), "8"),
    "ends in another case": (_cep("<TAGNBR>7</tagNbr>"), None),
    "ends in yet another case": (_cep("<TAGNBR>7</TagNbr>"), None),
    "other case with a prefix": (_cep("<q:TAGNBR>7</q:TAGNBR>", '<Envelope xmlns:q="u">'), ""),
    "attribute in another case": (_cep('<tagNbr>5</tagNbr>').replace("<bagDetails>", '<bagDetails TAGNBR="9">'), "5"),
    "attribute": (_cep('<tagNbr>5</tagNbr>').replace("<bagDetails>", '<bagDetails tagNbr="9">'), "9"),
    "attribute with a prefix": (_cep('<tagNbr>5</tagNbr>', '<Envelope xmlns:n="u">').replace("<bagDetails>", '<bagDetails n:tagNbr="9">'), "5"),
    "value that looks like one": (_cep('<tagNbr> TAGNBR = 3 <![CDATA[<TAGNBR>]]></tagNbr>').replace("<bagDetails>", '<bagDetails a=" TAGNBR = 3 ">'), " TAGNBR = 3 <TAGNBR>"),
}


def test_xml_scopes_document_types_and_exact_names(spark):
    """``None``: dropped; also when the plan runs after the call, in a session of either setting."""
    from pyoracle import flatten_xml_py

    docs = {k: json.dumps({"text": t}) for k, (t, _) in SCOPES.items()}
    lazy = flatten_xml(spark.createDataFrame(list(docs.items()), "pk string, doc string"), "doc", CEP_XML, keys=("pk",)).selectExpr("pk", "coalesce(tagNbr, '') AS tag")
    want = {k: v for k, (_, v) in SCOPES.items() if v is not None}
    model = {k: flatten_xml_py(d, CEP_XML) for k, d in docs.items()}
    assert {k: m["tagNbr"] or "" for k, m in model.items() if m is not None} == want
    try:
        for setting in ("false", "true"):
            spark.conf.set("spark.sql.caseSensitive", setting)
            assert {r.pk: r.tag for r in lazy.collect()} == want
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


_ONE_RUN = """
import sys
sys.path.insert(0, sys.argv[1])
from unfurl import SCAN
from unfurl.session import get_session
from unfurl.streaming import flatten_new_files
spark = get_session("one-run", master="local[1]", shuffle_partitions=1)
schema = "pk string, sk string, scanResponse string, upsertTimestamp string"
src, out, pk = sys.argv[2:5]
spark.createDataFrame([(pk, "s", '{"bag_resp":{"ret_code":1}}', "t")], schema).write.mode("append").parquet(src)
flatten_new_files(spark, src, schema, "scanResponse", SCAN, out).awaitTermination()
print("ROWS", sorted(r.pk for r in spark.read.parquet(out).collect()))
"""


def test_incremental_runs_of_two_applications(tmp_dir):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    said = [subprocess.run([sys.executable, "-c", _ONE_RUN, root, os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out"), pk],
                           capture_output=True, text=True, timeout=300).stdout for pk in ("p1", "p2")]
    assert "ROWS ['p1']" in said[0] and "ROWS ['p1', 'p2']" in said[1]


def test_two_streams_of_one_spec(spark, tmp_dir):
    from unfurl.streaming import flatten_new_files
    schema = "pk string, sk string, scanResponse string, upsertTimestamp string"
    for name in ("a", "b"):
        src, out = os.path.join(tmp_dir, name), os.path.join(tmp_dir, name + "-out")
        spark.createDataFrame([(name, "s", "{}", "t")], schema).write.parquet(src)
        flatten_new_files(spark, src, schema, "scanResponse", SCAN, out).awaitTermination()
        assert [r.pk for r in spark.read.parquet(out).collect()] == [name]


def test_shared_folder_is_required_on_a_cluster(spark, monkeypatch):
    from unfurl import session

    class Cluster:
        master, applicationId = "yarn", "app"

        def getConf(self):
            return {"spark.checkpoint.dir": None}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(type("S", (), {"sparkContext": Cluster()})())
