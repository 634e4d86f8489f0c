"""Patched frame-of-reference files: round trips, random access, the library's ids."""

import os
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from unfurl.llm import token_files as T
from unfurl.llm.common import table

PATH = P.path("byte_bpe_50k.json")


@pytest.mark.parametrize("block", [8, 64, 1024])
def test_blocks_round_trip(block):
    rng = np.random.default_rng(block)
    for n in [1, 7, block, block + 1, 3 * block + 5, 700 * block]:
        for ids in [rng.integers(0, 50_257, n), np.full(n, 2**32 - 1), rng.integers(0, 2**32, n), np.where(rng.random(n) < 0.03, 2**31, 7)]:
            ids = ids.astype(np.uint32)
            blocks = T.pack_blocks(ids, block)
            starts = np.cumsum([0, *map(len, blocks)])
            assert (T.unpack_blocks(b"".join(blocks), starts, block)[:n] == ids).all()


def test_outliers_do_not_widen_a_block():
    ids = np.arange(1024, dtype=np.uint32) % 16
    ids[5] = 4_000_000_000
    (block,) = T.pack_blocks(ids)
    assert len(block) == 7 + 6 + 1024 * 4 // 8


def test_file_random_access(tmp_dir):
    rng, path = random.Random(1), os.path.join(tmp_dir, "a.tok")
    docs = [(i if i % 7 else None, np.array([rng.randrange(50_257) for _ in range(rng.choice([0, 1, 5, 1024, 3000, 300_000 if i == 9 else 10]))], np.uint32)) for i in range(60)]
    w = T.TokenFileWriter(path)
    for d, ids in docs:
        w.add(d, ids)
    w.close()
    f = T.TokenFile(path)
    for i in rng.sample(range(60), 60):
        assert (f.document(i) == docs[i][1]).all()
    got = list(f.documents())
    assert [g[0] for g in got] == [d for d, _ in docs]
    assert all((g[2] == ids).all() for g, (_, ids) in zip(got, docs))
    with pytest.raises(ValueError):
        open(os.path.join(tmp_dir, "b"), "wb").write(b"x" * 100)
        T.TokenFile(os.path.join(tmp_dir, "b"))


def test_parts_encode_as_whole_texts():
    library = Tokenizer.from_file(PATH)
    library.encode_special_tokens = True
    rng, enc = random.Random(3), T.LibraryEncoder(PATH)
    kinds = ["the and tion ", "  \t\n", "'re 's 'll", "ÄéßΩж中文😀", "0123", "!?.;- =", "\x1c\x85\xa0 ​", "<|endoftext|>"]
    texts = ["".join(rng.choice(rng.choice(kinds)) * rng.choice([1, 1, 2, 9]) for _ in range(rng.randint(0, 60))) + rng.choice(["", "<|endoftext|>"]) for _ in range(600)]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    for at in range(0, 600, 50):
        assert [np.frombuffer(x, "<u4").tolist() for x in enc.encode(texts[at:at + 50])] == want[at:at + 50]
    plain = [" ".join(rng.choice(["the", "Tion.\nOf", "é中", "x's", "😀!", "a\tb", "<|endoftext|>", "12,5", "\x1c", "'re"]) for _ in range(rng.randint(0, 30))) for _ in range(300)]
    assert [np.frombuffer(x, "<u4").tolist() for x in enc.encode(plain)] == [e.ids for e in library.encode_batch(plain, add_special_tokens=False)]


def test_whole_table(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    library = Tokenizer.from_file(PATH)
    got = sorted(T.token_file_report(docs, PATH).collect())
    start = 0
    rows = sorted(docs.select("doc_id", "text").collect())
    assert len(got) == len(rows)
    for g, r in zip(got, rows):
        raw = np.array([*library.encode(r.text, add_special_tokens=False).ids, 2], "<u4").tobytes()
        assert tuple(g) == (r.doc_id, start, len(raw) // 4, zlib.crc32(raw))
        start += len(raw) // 4


def test_odd_rows_and_many_files(spark, tmp_dir):
    rows = [(3, None, 0), (1, "a b", 1), (1, "a b", 1), (None, "x", 2), (2, "", 3), (-5, "long " * 9000, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start int")
    files = T.write_token_files(docs, PATH, os.path.join(tmp_dir, "t"), file_tokens=4)
    got = sorted(T.read_token_files(files).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, -5, 1, 1, 2, 3]
    assert [r.n_tokens for r in got] == [2, 9002, 3, 3, 1, 1]
    assert [r.start for r in got] == [0, 2, 9004, 9007, 9010, 9011]
    assert T.token_file_report(docs.limit(0), PATH).count() == 0


def test_memory_of_parts_is_bounded():
    """Five thousand long different parts: right ids, none of them remembered."""
    enc = T.LibraryEncoder(P.path("byte_bpe_50k.json"))
    rnd = random.Random(3)
    texts = [" ".join(["short", "words,"] + [rnd.randbytes(100).hex() for _ in range(50)]) for _ in range(100)]
    assert enc.encode(texts) == enc._whole(texts)
    assert set(enc.known) <= {"short", "words", "words,"}
    odd = ["", " ", "a", "a b", " a b", "a  b", "a\tb c", "naïve, déjà vu!? x", "it's we'll 'tis", "é.\u0301 b", "\u0250x y", "1,2 a.b. c;;", "\x85a b", "Straße. \u01c5a, \xadb"]
    assert enc.encode(odd) == enc._whole(odd)
