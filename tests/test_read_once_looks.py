"""What tells that a document may be read once: its leaves and nodes, not further looks at its text."""

from test_read_once import SPEC

from unfurl import flatten_json, json_rejects
from unfurl.operators.json_flatten import _Plan

NODES = '{"a":{"x":%s,"b":[{"y":%s}],"l":[{"z":%s},%s]}}'
# text, read once, x, y
DOCS = {
    "null leaves beside all nodes": (NODES % ('"1"', "null", "null", "{}"), True, "1", None),
    "null element": (NODES % ('"1"', "2", "1", "null"), False, None, None),
    "null behind the slots": (NODES % ('"1"', "2", "1", '{"z":2},null'), True, "1", "2"),
    "exponent in a string": (NODES % ('"9E400"', "2", "1", "{}"), True, "9E400", "2"),
    "small exponent": (NODES % ("1e-400", "2.50", "1", "{}"), True, "0.0", "2.5"),
    "overflow": (NODES % ("-1E+400", "1e999", "1", "{}"), False, "-Infinity", "Infinity"),
    "overflow nobody reads": ('{"a":{"x":"1","b":[{"y":2}],"l":[{"z":1},{}]},"other":1e400}', True, "1", "2"),
    "overflow in a leaf": (NODES % ('{"k":[1e400]}', "2", "1", "{}"), True, '{"k":["Infinity"]}', "2"),
    "quotes in a string": (NODES % ('"\\"Infinity\\""', "2", "1", "{}"), False, '"Infinity"', "2"),
    "quotes by number": (NODES % ('"\\u0022Infinity\\u0022"', "2", "1", "{}"), False, '"Infinity"', "2"),
}


def _table(spark):
    return spark.createDataFrame([(k, v[0]) for k, v in DOCS.items()], "pk string, doc string")


def test_which_documents_are_read_once(spark):
    built = _Plan(SPEC, True).build(_table(spark), "doc", ("pk",))
    assert {r.pk: r["__fine"] for r in built.select("pk", "__fine").collect()} == {k: v[1] for k, v in DOCS.items()}


def test_their_values(spark):
    rows = {r.pk: (r.x, r.b_y) for r in flatten_json(_table(spark), "doc", SPEC).collect()}
    assert rows == {k: v[2:] for k, v in DOCS.items() if k != "null element"}
    assert [(r.pk, r.reject_reason) for r in json_rejects(_table(spark), "doc", SPEC).collect()] == [("null element", "node:a/l")]


def test_no_expression_searches_the_text_of_a_plain_document(spark):
    # two regular expressions over each document were a third of the flatten
    plan = _Plan(SPEC, True).build(_table(spark), "doc", ("pk",))._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE null" not in plan and "(?<=" not in plan
