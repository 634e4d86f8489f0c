"""The bigram model against dictionaries, and as a probability distribution."""

import collections
import math
import os
import re
import zlib

import numpy as np
import pytest
import xxhash

from unfurl.llm import lm
from unfurl.llm.common import table


def tokens_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or ""))
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def brute_model(texts):
    uni, pairs, seen = collections.Counter(), collections.Counter(), collections.Counter()
    for t in texts:
        w = tokens_of(t)
        uni.update(w)
        for h, x in zip(["<start>\n", *w[:-1]], w):
            pairs[h, x] += 1
            seen[h] += 1
    k, follow = collections.Counter(), collections.defaultdict(lambda: [0, 0, 0])
    for (h, x), c in pairs.items():
        k[x] += 1
        follow[h][min(c, 3) - 1] += 1
    d = lm.discounts([sum(c == i for c in pairs.values()) for i in (1, 2, 3, 4)])
    e = lm.discounts([sum(c == i for c in k.values()) for i in (1, 2, 3, 4)])
    big, v = len(pairs), len(uni)
    take = lambda d, c: d[min(c, 3) - 1] if c else 0

    def p(h, x):
        low = (max(k[x] - take(e, k[x]), 0) / big + sum(take(e, c) for c in k.values()) / big / (v + 1)) if big else 1 / (v + 1)
        if not seen[h]:
            return low
        return max(pairs[h, x] - take(d, pairs[h, x]), 0) / seen[h] + sum(a * b for a, b in zip(d, follow[h])) / seen[h] * low

    return uni, p


def brute_report(rows):
    fold = {i: zlib.crc32(str(i).encode()) % 5 == 1 if i is not None else False for i, _ in rows}
    uni, p = brute_model([t for i, t in rows if not fold[i]])
    n, v = sum(uni.values()), len(uni)
    for i, t in rows:
        w = tokens_of(t)
        base = sum(math.log10((uni[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        score = sum(math.log10(p(h, x)) for h, x in zip(["<start>\n", *w[:-1]], w))
        yield i, fold[i], len(w), sum(uni[x] > 0 for x in w), n, base, score


def same(got, want):
    got, want = sorted(got, key=str), sorted(want, key=str)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert tuple(g)[:5] == w[:5]
        assert g.base_score == pytest.approx(w[5], rel=1e-9, abs=1e-9)
        assert g.score == pytest.approx(w[6], rel=1e-9, abs=1e-9)


def test_whole_table_matches_dictionaries(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    same(lm.scoring_report(docs).collect(), list(brute_report([(r.doc_id, r.text) for r in docs.collect()])))


def test_probabilities_sum_to_one(spark, tmp_dir):
    texts = ["a b a c", "a b b", "c a b a", "d", "", "a b"]
    made = lm.fit(spark.createDataFrame([(t,) for t in texts], "text string"), os.path.join(tmp_dir, "m"), buckets=3)
    m = lm.Model(made)
    words = [xxhash.xxh64_intdigest(x) for x in (b"a", b"b", b"c", b"d", b"never")] + [lm.END]
    for h in [lm.START, *words[:5]]:
        total = 0.0
        for w in words:
            if h == lm.START:
                tokens, ends, at = np.array([w], np.uint64), np.array([1]), 0
            else:
                tokens, ends, at = np.array([h, w], np.uint64), np.array([2]), 1
            total += 10 ** m.log10(tokens, ends)[1][at]
        assert total == pytest.approx(1.0)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "x Y x"), (4, "x y x y"), (4, "x y x y"), (5, "Été ÉTÉ"), (6, "w " * 50_000), (16, "new words")]
    docs = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, score double")
    same(lm.scoring_report(docs).collect(), list(brute_report(rows)))
    assert lm.scoring_report(docs.limit(0)).count() == 0


def test_nothing_to_learn_from(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    docs = spark.createDataFrame([(held, "a b")], "doc_id long, text string")
    (r,) = lm.scoring_report(docs).collect()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (True, 3, 0, 0, 0.0, 0.0)


def test_held_out_text_of_the_kind_scores_better_than_its_words_shuffled(spark, tmp_dir):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = lm.scoring_report(docs).where("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)
