"""Documents that are read once: which need no Variant, and that no text passes for one of them."""

import json

from unfurl import flatten_json, json_outcomes, json_rejects
from unfurl.operators.json_flatten import _Plan
from unfurl.plans.spec import FlattenSpec, Group

SPEC = FlattenSpec("once", (Group("a", ("x",)), Group("a/b[0]", ("y",), "b_"), Group("a/l", ("z",), "l_", "legs", 2)), key_columns=("pk",))

# text, read once (strict), reason of the reject
DOCS = {
    "whole": ('{"a":{"x":"1","b":[{"y":5.0},7],"l":[{"z":1},{"z":2}]}}', False, None),
    "plain": (' {"a":{"x":"1","b":[{"y":5.0}],"l":[{"z":1},{"z":2}]},"other":[1]}\n', True, None),
    "missing": ("{}", True, None),
    "null leaf": ('{"a":{"x":null}}', False, None),
    "null node": ('{"a":null}', False, "node:a"),
    "empty first": ('{"a":{"x":"1","b":[]}}', False, "node:a/b[0]"),
    "scalar node": ('{"a":1}', False, "node:a"),
    "object for legs": ('{"a":{"l":{"z":1}}}', False, "node:a/l"),
    "empty legs": ('{"a":{"x":"1","l":""}}', False, None),
    "tail": ('{"a":{"x":"1"}} x', False, "malformed"),
    "second value": ('{"a":{"x":"1"}},{"a":{"x":"2"}}', False, "malformed"),
    "closes": ('{"a":{"x":"1"}}]', False, "malformed"),
    "opens anew": ('{"a":{"x":"1"}},{"__mark":1}],"d":[{"__mark":1},{"a":{"x":"2"}}', False, "malformed"),
    "closes all": ('{"a":{"x":"1"}},{"__mark":1}]} x', False, "malformed"),
    "single quotes": ("{'a':{'x':'1'}}", False, "malformed"),
    "array": ('[{"a":{"x":"1"}}]', False, "not_object"),
    "not finite": ('{"a":{"x":NaN}}', False, None),
    "overflow": ('{"a":{"x":1e400}}', False, None),
    "many digits": ('{"a":{"x":%s}}' % ("1" * 400), False, None),
    "last wins": ('{"a":{"x":"0"},"a":{"x":"1"}}', True, None),
}
X = {"not finite": "NaN", "overflow": "Infinity", "many digits": "1" * 400, "missing": None, "null leaf": None}


def _table(spark):
    return spark.createDataFrame([(k, v[0]) for k, v in DOCS.items()], "pk string, doc string")


def test_most_documents_are_read_once(spark):
    built = _Plan(SPEC, True).build(_table(spark), "doc", ("pk",))
    found = {r.pk: (r.fine, r.parsed) for r in built.selectExpr("pk", "__fine AS fine", "__doc IS NOT NULL AS parsed").collect()}
    assert {k for k, (fine, _) in found.items() if fine} == {k for k, v in DOCS.items() if v[1]}
    assert not any(parsed for fine, parsed in found.values() if fine)


def test_rows_and_reasons_of_documents_read_once(spark):
    df = _table(spark)
    rows = {r.pk: r for r in flatten_json(df, "doc", SPEC).collect()}
    assert set(rows) == {k for k, v in DOCS.items() if v[2] is None}
    assert {k: r.x for k, r in rows.items()} == {k: X.get(k, "1") for k in rows}
    assert (rows["plain"].b_y, rows["plain"].l_0_z, rows["plain"].l_1_z) == ("5.0", "1", "2")
    assert (rows["whole"].b_y, rows["whole"].l_0_z) == ("5.0", "1")
    reasons = {k: v[2] for k, v in DOCS.items() if v[2]}
    assert {r.pk: r.reject_reason for r in json_rejects(df, "doc", SPEC).collect()} == reasons
    assert {r.pk: r.reject_reason for r in json_outcomes(df, "doc", SPEC).collect() if r.reject_reason} == reasons


def test_repeated_keys_can_still_be_an_error(spark):
    kept = {r.pk for r in flatten_json(_table(spark), "doc", SPEC, duplicate_keys="error").collect()}
    assert "last wins" not in kept and "plain" in kept


def test_a_key_named_like_the_mark(spark):
    spec = FlattenSpec("marked", (Group("", ("__mark", "x")),), key_columns=())
    text = json.dumps({"__mark": "m", "x": "1"})
    assert flatten_json(spark.createDataFrame([(text,)], "doc string"), "doc", spec).collect() == [("m", "1")]
