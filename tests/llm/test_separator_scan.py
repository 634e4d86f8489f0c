"""Separator scan of flat token files against a plain walk."""

import os
import random

import numpy as np
import public_tokenizers as P
import pytest

from unfurl.llm import separator_scan as S
from unfurl.llm.common import table

PATH = P.path("byte_bpe_50k.tiktoken")


def walk(ids, separator):
    out, start = [], 0
    for i, t in enumerate(ids):
        if t == separator:
            out.append((len(out), start, i - start, True))
            start = i + 1
    if start < len(ids):
        out.append((len(out), start, len(ids) - start, False))
    return out


@pytest.mark.parametrize("width", [2, 4])
def test_scan_matches_a_walk(spark, tmp_dir, width):
    rng, files, want = random.Random(width), [], []
    for k in range(14):
        n = rng.choice([0, 1, 7, 8, 9, 64, 500])
        rate = rng.choice([0, 0.02, 0.5, 1])
        ids = [9 if rng.random() < rate else rng.choice([1, 2, 3]) for _ in range(n)]
        path = os.path.join(tmp_dir, f"{k}.bin")
        np.array(ids, f"<u{width}").tofile(path)
        files.append((path, n * width))
        want += [(path, *x) for x in walk(ids, 9)]
    got = S.scan_files(spark.createDataFrame(files, "file string, n_bytes long"), 9, width, block_tokens=8)
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_whole_table_counts_as_the_library(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    enc, _ = S.library(PATH, P.PATTERN)
    got = S.token_count_report(docs, PATH, P.PATTERN, file_tokens=100_000, block_tokens=4096).collect()
    assert sorted((r.doc_id, r.n_tokens) for r in got) == sorted((r.doc_id, len(enc.encode_ordinary(r.text))) for r in docs.collect())


def test_odd_rows(spark):
    rows = [(1, None), (1, ""), (None, "a b"), (2, "word " * 5000), (2, "word " * 5000)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, file string")
    got = S.token_count_report(docs, PATH, P.PATTERN, block_tokens=64).collect()
    assert sorted(((r.doc_id or 0, r.n_tokens) for r in got)) == [(0, 2), (1, 0), (1, 0), (2, 5001), (2, 5001)]
    assert S.token_count_report(docs.limit(0), PATH, P.PATTERN).count() == 0
