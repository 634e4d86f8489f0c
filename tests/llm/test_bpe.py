"""Tree-reduced BPE against the tiktoken library and itself."""

import base64
import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken

from unfurl.llm import bpe
from unfurl.llm.common import table

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def random_text(rng):
    kinds = ["the and tion er in ", "aeiou", "  \t\n", "'re 's 'll 'x ''", "ÄéßΩж中文😀", "0123456789", "!?.,;--- ===", "\x1c\x85\xa0 ​", "<|endoftext|>"]
    return "".join(rng.choice(rng.choice(kinds)) * rng.choice([1, 1, 1, 2, 5, 40]) for _ in range(rng.randint(0, 120)))


@pytest.mark.parametrize("leaf", [(32, 1 << 15), (4, 16), (2, 7)])
def test_random_texts_match_the_library(library, leaf):
    rng = random.Random(leaf[0])
    c = bpe.Codec(bpe.read_ranks(PATH), P.PATTERN, remembered=500, leaf_bytes=leaf[0], leaf_chars=leaf[1])
    for _ in range(700):
        t = random_text(rng)
        ids = c.encode(t)
        assert ids == library.encode_ordinary(t), t
        assert c.decode(ids) == t.encode()


def test_long_runs(library):
    c = bpe.Codec(bpe.read_ranks(PATH), P.PATTERN)
    for t in ["a" * 30_001, "abc" * 20_000, "=" * 9_999, " " * 5_000 + "x", "é" * 7_001, ("word " * 30 + "\n") * 2_000]:
        assert c.encode(t) == library.encode_ordinary(t)


def test_whole_table_matches_the_library(spark, library):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = {r.doc_id: r for r in bpe.encode_report(docs, PATH, P.PATTERN).collect()}
    for r in docs.select("doc_id", "text").collect():
        ids = library.encode_ordinary(r.text)
        g = got[r.doc_id]
        assert (g.n_tokens, g.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert g.decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest()


def test_odd_rows(spark):
    rows = [(1, None, 5), (None, "x y", 6), (1, "", 7), (1, "", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, token_ids int")
    empty = hashlib.sha256(b"").hexdigest()
    got = sorted(bpe.encode_report(docs, PATH, P.PATTERN).collect(), key=str)
    assert [(r.n_tokens, r.ids_sha256 == empty) for r in got] == [(0, True)] * 3 + [(2, False)]
    assert bpe.encode_documents(docs, PATH, P.PATTERN, keep=("doc_id",)).columns == ["doc_id", "token_ids"]
    assert bpe.encode_report(docs.limit(0), PATH, P.PATTERN).count() == 0


def test_memory_of_matches_is_bounded():
    """Long different matches are encoded rightly and not remembered."""
    path = P.path("byte_bpe_50k.tiktoken")
    codec = bpe.Codec(bpe.read_ranks(path), P.PATTERN, remembered=100)
    library = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    rnd = random.Random(2)
    for _ in range(60):
        text = base64.b64encode(rnd.randbytes(3000)).decode().translate({43: 97, 47: 98}) + " short words " + str(rnd.random())
        assert codec.encode(text) == library.encode_ordinary(text)
    assert len(codec.known) <= 100 and max(map(len, codec.known)) <= bpe.LONGEST
