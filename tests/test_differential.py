"""Random documents: native flatten vs the independent per-row model (tests/pyoracle.py)."""

import json
import random

import pytest

from pyoracle import flatten_json_py
from unfurl import BM, SCAN, flatten_json


def _scalar(rnd):
    return rnd.choice([
        rnd.randint(-5, 10**6), str(rnd.randint(0, 999)), "téxt \"q\"", True, False, None, "", "007",
        {"b": rnd.randint(0, 9), "a": 2.5}, [1, "y", 1e-5], 10**20, 5.0, 100.0, -0.0, 12345678.9, 0.0001, 1e10,
        round(rnd.uniform(-1e4, 1e4), 3), 0.12345678901234568, 3.5e-7, -1.5e22,
        float("nan"), float("inf"), float("-inf"), {"x": [float("nan")]}, 'NaN "Infinity" -Infinity', 10**1200, "\\",
    ])


def _tree(spec):
    root = {}
    for g in spec.groups:
        node = root
        steps = g.steps
        for i, s in enumerate(steps):
            last = i == len(steps) - 1
            kind = "legs" if (last and g.mode == "legs") else ("first" if s.first else "object")
            child = node.setdefault(s.key, {"kind": kind, "children": {}, "fields": []})
            node = child["children"] if not last else child
            if last:
                child["fields"].extend(g.fields)
        if not steps:
            root.setdefault("__fields__", []).extend(g.fields)
    return root


def _obj(rnd, children, fields, p_bad):
    out = {}
    for f in fields:
        if rnd.random() < 0.7:
            out[f] = _scalar(rnd)
    for key, spec in children.items():
        if key == "__fields__":
            continue
        r = rnd.random()
        if r < 0.25:
            continue  # missing
        if r < 0.25 + p_bad:
            out[key] = rnd.choice([None, "x", "", 5, [], {}, [None], ["x"], True, float("nan")])
            continue
        inner = _obj(rnd, spec["children"], spec["fields"], p_bad)
        if spec["kind"] == "object":
            out[key] = inner
        elif spec["kind"] == "first":
            out[key] = [inner] + rnd.choice([[], [], [_obj(rnd, spec["children"], spec["fields"], p_bad)], [5, "x"]])
        else:
            n = rnd.randint(0, 7)
            legs = [_obj(rnd, {}, spec["fields"], 0) for _ in range(n)]
            if legs and rnd.random() < 0.15:
                legs[rnd.randrange(len(legs))] = rnd.choice(["x", 1, None])
            out[key] = legs
    return out


def _docs(spec, n, seed):
    rnd = random.Random(seed)
    tree = _tree(spec)
    docs = []
    for _ in range(n):
        r = rnd.random()
        if r < 0.04:
            docs.append(rnd.choice(["", "nope", "[1]", "null", '{"a":1} x', None, "NaN", "{NaN:1}", '{"a":-NaN}', '{"a":Infinity 1}', '{"a":1e400}', '{"a":-1E+999,"b":NaN}']))
        else:
            docs.append(json.dumps(_obj(rnd, tree, tree.get("__fields__", []), p_bad=0.04), ensure_ascii=False))
    return docs


@pytest.mark.parametrize("spec,seed", [(SCAN, 1), (BM, 2)])
def test_random_documents_match_model(spark, spec, seed):
    docs = _docs(spec, 400, seed)
    rows = [(f"p{i}", "s", d, "t") for i, d in enumerate(docs)]
    df = spark.createDataFrame(rows, "pk string, sk string, payload string, upsertTimestamp string")
    got = {r["pk"]: r.asDict() for r in flatten_json(df, "payload", spec).collect()}
    kept = dropped = 0
    for i, d in enumerate(docs):
        want = flatten_json_py(d, spec)
        have = got.get(f"p{i}")
        assert (want is None) == (have is None), f"row {i} kept mismatch: {d[:300] if d else d}"
        if want is None:
            dropped += 1
            continue
        kept += 1
        for col in spec.payload_columns():
            assert have[col] == want[col], f"row {i} column {col}: {have[col]!r} != {want[col]!r}"
    assert kept > 50 and dropped > 20  # both outcomes are exercised


@pytest.mark.parametrize("spec,seed", [(SCAN, 5), (BM, 6)])
def test_random_documents_match_model_lenient(spark, spec, seed):
    docs = _docs(spec, 400, seed)
    rows = [(f"p{i}", "s", d, "t") for i, d in enumerate(docs)]
    df = spark.createDataFrame(rows, "pk string, sk string, payload string, upsertTimestamp string")
    got = {r["pk"]: r.asDict() for r in flatten_json(df, "payload", spec, strict=False).collect()}
    for i, d in enumerate(docs):
        want = flatten_json_py(d, spec, strict=False)
        have = got.get(f"p{i}")
        assert (want is None) == (have is None), f"row {i} kept mismatch: {d[:300] if d else d}"
        if want is not None:
            for col in spec.payload_columns():
                assert have[col] == want[col], f"row {i} column {col}: {have[col]!r} != {want[col]!r}"


def test_rejects_are_exactly_the_dropped_rows(spark):
    from unfurl import json_rejects

    docs = _docs(SCAN, 300, 9)
    rows = [(f"p{i}", "s", d, "t") for i, d in enumerate(docs)]
    df = spark.createDataFrame(rows, "pk string, sk string, payload string, upsertTimestamp string")
    kept = {r.pk for r in flatten_json(df, "payload", SCAN).select("pk").collect()}
    rejected = {r.pk for r in json_rejects(df, "payload", SCAN).collect()}
    assert kept.isdisjoint(rejected)
    assert kept | rejected == {f"p{i}" for i in range(len(docs))}
