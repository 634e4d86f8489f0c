"""Type tags come off at any depth, whatever the text in between."""

import json

import pytest

from unfurl.sources import export
from unfurl.sources.export import export_attributes, unnest_typed


def nested(n):
    if n == 0:
        return {"S": "x"}
    return {"M": {"k": nested(n - 1)}} if n % 2 else {"L": [nested(n - 1), {"N": "1"}]}


def plain(v):
    (tag, x), = v.items()
    if tag == "M":
        return {k: plain(y) for k, y in x.items()}
    if tag == "L":
        return [plain(y) for y in x]
    return {"N": lambda: json.loads(x), "NS": lambda: [json.loads(e) for e in x], "NULL": lambda: None}.get(tag, lambda: x)()


ITEMS = [
    {"a": nested(12)}, {"a": nested(30)}, {"a": {"SS": ["p", "q "]}}, {"a": {"NS": ["1", "2.5"]}}, {"a": {"BS": ["AA=="]}}, {"a": {"B": "AA=="}}, {"a": {"NULL": True}},
    {"a": {"M": {"k": {"S": "a b\u0085\"\\\n"}, "k ": {"NULL": True}, "e": {"M": {}}, "l": {"L": []}, "b": {"BOOL": False}, "ss": {"SS": ['{["']}, "n": {"NS": ["1"]}, "bin": {"B": "QQ=="}}}},
    {"a": {"S": "{[{[{[{[{["}}, {"a": {"M": {"S": {"S": "M"}}}},
]


def test_any_depth_sets_and_line_separators(spark):
    df = spark.createDataFrame([(json.dumps({"Item": i}, ensure_ascii=False),) for i in ITEMS], "value string").coalesce(1)
    got = [r.a for r in unnest_typed(df, "value").collect()]
    for text, item in zip(got, ITEMS, strict=True):
        want = plain(item["a"])
        assert text == want if want is None or isinstance(want, str) else json.loads(text) == want
    assert [r.a for r in unnest_typed(df, "value", ["a"]).collect()] == got


def test_objects_that_are_no_tagged_value_stay(spark):
    odd = [{"S": "x", "N": "1"}, {"ZZ": "x"}, {}]
    df = spark.createDataFrame([(json.dumps({"Item": {"a": o}}),) for o in odd], "value string").coalesce(1)
    assert [json.loads(r.a) for r in unnest_typed(df, "value").collect()] == odd


def test_too_many_attributes_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(export, "MAX_ATTRIBUTES", 3)
    df = spark.createDataFrame([(json.dumps({"Item": {f"a{i}": {"S": "x"}}}),) for i in range(4)], "value string")
    with pytest.raises(ValueError, match="different attributes"):
        export_attributes(df, "value")
    assert export_attributes(df.limit(3), "value") == ["a0", "a1", "a2"]


def test_escaped_quotes_do_not_hide_how_deep_an_item_is(spark):
    item = json.dumps({"Item": {"a": {"M": {"s": {"S": 'x "q"\\'}, "l": {"L": [{"M": {"k": {"S": "v"}}}]}}}}})
    row = unnest_typed(spark.createDataFrame([(item,)], "value string"), "value").collect()[0]
    assert json.loads(row.a) == {"s": 'x "q"\\', "l": [{"k": "v"}]}
