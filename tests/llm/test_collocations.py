"""Phrase collocations against counts in Python."""

import random
import re
from collections import Counter

import pytest

from unfurl.llm import collocations as co

SCHEMA = "doc_id long, text string, lang string"
LOWER = {c: c + 32 for c in range(65, 91)}


def expected(rows, top=co.TOP, least=co.LEAST):
    f, n = {}, Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f.setdefault(lang, Counter()).update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        cand = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in cand.items():
            if any(len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) and 100 * b >= co.INSIDE * a for q, b in cand.items()):
                continue
            cuts = [(co.SCALE * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            rows.append((-score, -a, " ".join(p).encode(), left, right))
        for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top]):
            out.append((lang, i + 1, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def found(df, **kw):
    return sorted(map(tuple, co.collocations(df, **kw).collect()))


def corpus(n, seed):
    rng = random.Random(seed)
    words = ["New", "york", "ünder", "a", "the", "of", "x" * 40, "naïve", "z\xa0z", " ", "\U0001f600"]
    phrase = ["new york city", "the state of", "a of\ta", "New York", "state of the"]
    rows = []
    for i in range(n):
        parts = [rng.choice(phrase) if rng.random() < 0.4 else rng.choice(words) for _ in range(rng.randint(0, 60))]
        rows.append((i, "".join(p + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "!?"]) for p in parts), rng.choice(["en", "en", "de", None])))
    return rows


@pytest.mark.parametrize("bits, chunk, bucket_bytes", [(co.MAX_BITS, co.CHUNK, co.BUCKET_BYTES), (10, 500, 2_000)])
def test_random_corpus(spark, bits, chunk, bucket_bytes):
    """Also with a bit table that is far too small, sums sent after few words, and many buckets."""
    rows = corpus(250, chunk)
    want = expected(rows)
    assert len(want) > 30 and any(len(r[2].split(" ")) == 3 for r in want)
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(4), max_bits=bits, chunk=chunk, bucket_bytes=bucket_bytes) == want


@pytest.mark.parametrize("partitions", ["2", "11"])
def test_streams_of_many_ranges(spark, partitions):
    """What a range's first rows follow stands in a range before, in both streams."""
    rows = corpus(250, 3)
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        assert found(spark.createDataFrame(rows, SCHEMA)) == expected(rows)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_words_of_small_buffers_are_those_of_whole_texts():
    texts = [r[1].encode() for r in corpus(60, 5)] + [b"word " * 500, b"", b"a.b" * 300]
    for size in (1, 7, 100, 1 << 20):
        w = co.Words()
        for raw in co.buffers(texts, size):
            w.add(raw)
        ids, vocabulary, piece = w.ids()
        got = [vocabulary[i].as_py() for i in ids.tolist()]
        want, breaks = [], []
        for t in texts:
            for p in re.split(r"[.,;:!?\x0A-\x0D]", t.decode().translate(LOWER)):
                ws = re.findall(r"[^\x20\x09]+", p)
                breaks += [True] + [False] * (len(ws) - 1) if ws else []
                want += ws
        assert got == want
        assert [True, *(piece[1:] != piece[:-1]).tolist()] == breaks


def test_odd_rows_ties_and_limits(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, "   \t\n.", None), (4, "p q " * 30_000, "en"), (5, "a b. " * 12, "en"), (5, "c d, " * 12, "en"), (None, "e f; " * 12, "en"),
            (6, "g h! " * 9, "en"), (7, "i j k\n" * 20, ""), (8, "solo", "xx"), (9, "i j k? " * 20, "und"), (10, "l m n: " * 10, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(df) == expected(rows)
    assert found(df, top=2) == expected(rows, top=2)


def test_large_counts_stay_exact(spark):
    """Counts whose products pass 64 bits."""
    words = spark.createDataFrame([("en", "a", 10 ** 12 + 7), ("en", "b", 10 ** 12 + 9), ("en", "c", 10 ** 11)], "lang string, w1 string, c long")
    pairs = spark.createDataFrame([("en", "a", "b", 10 ** 12 + 3), ("en", "b", "c", 10 ** 11 - 1)], "lang string, w1 string, w2 string, c long")
    triples = spark.createDataFrame([("en", "a", "b", "c", 4 * 10 ** 10)], "lang string, w1 string, w2 string, w3 string, c long")
    got = {tuple(x for x in r[1:4] if x): r[4:] for r in map(tuple, co.scored(words, pairs, triples).collect())}
    cut = lambda a, x, y: co.SCALE * a * a // (x * y)
    a = 4 * 10 ** 10
    assert got[("a", "b")] == (10 ** 12 + 3, 10 ** 12 + 7, 10 ** 12 + 9, cut(10 ** 12 + 3, 10 ** 12 + 7, 10 ** 12 + 9))
    assert got[("b", "c")][3] == cut(10 ** 11 - 1, 10 ** 12 + 9, 10 ** 11)
    one, two = cut(a, 10 ** 12 + 7, 10 ** 11 - 1), cut(a, 10 ** 12 + 3, 10 ** 11)
    assert got[("a", "b", "c")][3] == min(one, two)


def test_empty_table_and_clashing_columns(spark):
    assert co.collocation_report(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = corpus(40, 8)
    more = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS w1", "2 AS c", "3 AS x1", "4 AS n", "5 AS phrase", "6 AS score", "7 AS rank")
    assert found(more) == expected(rows)
