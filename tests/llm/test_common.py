"""Shared helpers: connected components, words."""

import random
import re

from pyspark.sql import functions as F

from unfurl.llm.common import connected_components, words


def test_components_of_chains_stars_and_clouds(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 90)]  # a long chain
    edges += [(500, 501 + i) for i in range(60)]  # a star
    edges += [(1000 + rng.randrange(40), 1000 + rng.randrange(40)) for _ in range(120)]
    edges += [(7, 7), (2000, 1999), (1999, 2000), (-5, -6)]
    rng.shuffle(edges)
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    want = {x: find(x) for x in root if any(x in e and e[0] != e[1] for e in edges)}
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(got) == len(want) and {r.node: r.root for r in got} == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_words(spark):
    texts = [None, "", " ", "a", " a  b\n\t\x0b\x0c\rc ", "\x1f\xa0 x", "é\x85中"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [list(r.w) for r in df.select(words(F.col("t")).alias("w")).collect()]
    assert got == [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]


def test_columns_with_the_operators_own_names_pass_through(spark):
    import public_tokenizers

    from unfurl.llm import bpe, langid, quality, simhash_dedup

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    odd = ["__text", "__id", "__hash", "__rows", "__kept", "__words", "__lang", "__rejected", "root", "fp", "token_ids", "column_3_aside"]
    more = docs.select("*", *[F.concat(F.lit(f"{c} of "), F.col("doc_id").cast("string")).alias(c) for c in odd])
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    stages = [quality.kept_documents, langid.accepted_documents, simhash_dedup.deduplicated, lambda d: bpe.encode_documents(d, path, public_tokenizers.PATTERN)]
    for stage in stages:
        plain, got = stage(docs), stage(more)
        kept = [c for c in odd if c != "token_ids" or "token_ids" not in plain.columns]
        assert got.columns == [*docs.columns, *kept, *plain.columns[len(docs.columns):]]
        assert sorted(map(repr, got.select(*plain.columns).collect())) == sorted(map(repr, plain.collect()))
        assert all(r[c] == f"{c} of {r.doc_id}" for r in got.collect() for c in kept)
