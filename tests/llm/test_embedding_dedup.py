"""Embedding near-dedup against all cosines."""

import numpy as np
import pytest

from unfurl.llm import embedding_dedup as ed

SCHEMA = "vec_id long, embedding array<float>, label int"


def expected(rows, threshold=ed.THRESHOLD):
    """``(vec_id, n_links, component_id)`` of each row by all pairs."""
    near = [[] for _ in rows]
    x = []
    for _, e, label in rows:
        ok = label is not None and e is not None and len(e) and all(v is not None and np.isfinite(v) for v in e) and any(v != 0 for v in e)
        x.append(np.array(e, np.float32).astype(float) if ok else None)
    for i in range(len(rows)):
        for j in range(i):
            if x[i] is not None and x[j] is not None and rows[i][2] == rows[j][2] and len(x[i]) == len(x[j]):
                if x[i] @ x[j] / np.sqrt((x[i] @ x[i]) * (x[j] @ x[j])) >= threshold:
                    near[i].append(j)
                    near[j].append(i)
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            for k in near[todo.pop()]:
                if k not in seen:
                    seen.add(k)
                    todo.append(k)
        out.append((rows[i][0], len(near[i]), min((rows[k][0] for k in seen if rows[k][0] is not None), default=None)))
    return sorted(out, key=repr)


def found(spark, rows, **kw):
    return sorted(map(tuple, ed.components(spark.createDataFrame(rows, SCHEMA).repartition(3), **kw).collect()), key=repr)


def unit(rng, n, d=64):
    x = rng.standard_normal((n, d))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_hadamard_keeps_lengths_and_is_its_own_inverse():
    x = np.random.default_rng(0).standard_normal((5, 16))
    y = ed.hadamard(x)
    assert np.allclose((y ** 2).sum(1), 16 * (x ** 2).sum(1)) and np.allclose(ed.hadamard(y), 16 * x)


@pytest.mark.parametrize("bucket, block", [(128, 512), (1, 8)])
def test_groups_of_copies_and_chains(spark, bucket, block):
    rng = np.random.default_rng(3)
    rows, n = [], 0
    for size, noise in ((1, 0), (40, 0.02), (60, 0.0), (25, 0.04), (3, 0.01)):
        base = unit(rng, 1)[0]
        for _ in range(size):
            rows.append((n, (base + noise * rng.standard_normal(64) / 3).astype(np.float32).tolist(), n % 2))
            n += 1
    a, b = unit(rng, 2)
    for k in range(25):  # each links with its neighbours only
        rows.append((n + k, (np.cos(k * 0.35) * a + np.sin(k * 0.35) * b).astype(np.float32).tolist(), 5))
    rows += [(500 + i, v.astype(np.float32).tolist(), i % 2) for i, v in enumerate(unit(rng, 60))]
    want = expected(rows)
    assert sum(r[1] for r in want) > 1000
    assert found(spark, rows, bucket=bucket, block=block) == want


def test_recall_at_the_threshold():
    """Random pairs at the threshold itself, with one and with two hashes a bucket; other pairs than those it was set with."""
    rng = np.random.default_rng(99)
    a, g = unit(rng, 3000), unit(rng, 3000)
    g -= (g * a).sum(1, keepdims=True) * a
    b = 0.93 * a + np.sqrt(1 - 0.93 ** 2) * g / np.linalg.norm(g, axis=1, keepdims=True)
    for hashes in (1, 2):
        tables = ed.tables_for(64, 0.93, hashes)
        met = ed.meetings(ed.codes(a, hashes, tables), ed.codes(b, hashes, tables)).any(1)
        assert met.mean() > 0.98, (hashes, tables, met.mean())
    assert ed.hashes_for(64, 5_000) == 1 and ed.hashes_for(64, 1_000_000) == 2 and ed.hashes_for(64, 10 ** 9) >= 3


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, [1.0, 0.0], None), (4, None, 0), (5, [], 0), (6, [0.0, 0.0], 0), (7, [nan, 1.0], 0), (8, [nan, 1.0], 0),
            (9, [inf, 0.0], 0), (10, [None, 1.0], 0), (11, [None, 1.0], 0), (12, [1.0, 0.0], 1), (13, [1.0, 0.0, 0.0], 0), (14, [1.0, -0.0], 0), (14, [1.0, 0.0], 0),
            (None, [1.0, 0.01], 0), (None, [0.0, 1.0], 3), (None, [3.0], 4), (15, [2.0], 4), (16, [-2.0], 4), (17, [1e-30, 0.0], 0), (18, [3e38, 3e38], 7), (19, [1e-40, 1e-40], 7), (6, [0.0, 0.0], 0)]
    assert found(spark, rows) == expected(rows)


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert ed.embedding_report(empty).collect() == []
    rows = [(1, [1.0, 0.0], 0), (2, [1.0, 0.1], 0), (3, [0.0, 1.0], 0)]
    more = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS c", "2 AS m", "3 AS t", "4 AS code", "5 AS root", "6 AS n_links", "7 AS first")
    assert sorted(map(tuple, ed.embedding_report(more).collect())) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]
