"""Scoring by an interpolated modified Kneser-Ney bigram model.

Tokens are the words ``[^\\x20\\x09-\\x0D]+`` of a text with A-Z lower-cased, then one end
token. With ``c`` the counts of pairs, ``c(h)`` that of a context, ``N1..N3+(h)`` how many
different words follow it once, twice and more often, and ``k(w)`` how many different tokens
precede ``w``:

    p(w | h) = max(c(h w) - D(c(h w)), 0) / c(h) + (D1 N1(h) + D2 N2(h) + D3 N3+(h)) / c(h) * p(w)
    p(w)     = max(k(w) - E(k(w)), 0) / K       + (E1 t1 + E2 t2 + E3 t3+) / K          / (V + 1)

with the discounts D (over pairs) and E (over ``k``) from the counts of counts, K different
pairs, V different training tokens, and one place for the unknown word. A context that was
never seen passes all weight on. Texts begin in a start context that is not a token.

Counting is Spark work on packed arrays: a task counts its rows' tokens (pairs) in bounded
runs and emits one row for each run and bucket, keys sorted and compressed; the shuffle
deals buckets by the hash of the word (pair), so a frequent word is spread over runs as one
count and its pairs over all buckets; a bucket's arrays are merged and written as one file
of sorted hash arrays. Buckets are as many as ``spark.sql.shuffle.partitions``, so a
bucket's size is set like that of any shuffle partition.

    words   hash u64 (sorted), count u64, k u32, N1 u32, N2 u32, N3+ u32
    pairs   hash u64 (sorted), count u32

A word's number is its place in the sorted order of all buckets; a pair's key is its two
numbers in 64 bits, its hash a one-to-one mixing of them, so pairs never collide. Words have 64-bit
hashes. Workers map the files (a store that cannot be mapped is copied to an unlinked local
file first) and look hashes up by binary search; what they hold in memory is one run of
tokens. The driver sees one row for each file.

Defined cases: a NULL text counts as empty, which has the end token alone; an empty
training fold has ``N = V = 0``, and every token probability 1; where a count of
counts needed for a discount is 0 the discounts are 0.5, 1 and 1.5; repeated rows count each
time; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import LOWER_AZ, stored
from .files import NewFile, file_system

#: Tokens that a task counts or looks up at a time.
RUN = 1 << 20
#: Word hashes that a task remembers.
REMEMBERED = 400_000
FALLBACK = (0.5, 1.0, 1.5)
#: White space is in no word, so these stand for what is not a word.
START, END = xxhash.xxh64_intdigest(b"\r"), xxhash.xxh64_intdigest(b"\n")
_BUCKET = "kind string, bucket int, a binary, b binary"
_FILE = "kind string, bucket int, path string, n long, sums array<long>"


# ---- tokens ---------------------------------------------------------------------
class Hashes:
    """64-bit hashes of a text's tokens; remembers words, which changes no result."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def of(self, text: str | None) -> list[int]:
        known, out = self.known, []
        for w in (text or "").encode("utf-8", "surrogatepass").translate(LOWER_AZ).split():
            h = known.get(w)
            if h is None:
                h = known[w] = xxhash.xxh64_intdigest(w)
            out.append(h)
        if len(known) > REMEMBERED:
            known.clear()
        out.append(END)
        return out


def runs(texts: Iterator[list[str | None]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Token hashes of many texts, about ``RUN`` at a time, and where each text ends in them."""
    hashes, tokens, ends = Hashes(), [], []
    for batch in texts:
        for t in batch:
            tokens += hashes.of(t)
            ends.append(len(tokens))
            if len(tokens) >= RUN:
                yield np.array(tokens, np.uint64), np.array(ends)
                tokens, ends = [], []
    if ends:
        yield np.array(tokens, np.uint64), np.array(ends)


def contexts(tokens: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The token before each; the start at the beginning of a text."""
    before = np.concatenate((np.array([START], np.uint64), tokens[:-1]))
    before[ends[:-1]] = START
    return before


# ---- packed arrays ----------------------------------------------------------------
def _pack(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x).tobytes())


def _unpack(x: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(x), kind)


def _steps(sorted_keys: np.ndarray) -> bytes:
    return _pack(np.diff(sorted_keys, prepend=np.uint64(0)))


def _keys(x: bytes) -> np.ndarray:
    return np.cumsum(_unpack(x, np.uint64), dtype=np.uint64)


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Ascending with the hash, so buckets in order are all hashes in order."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def mixed(keys: np.ndarray) -> np.ndarray:
    """One-to-one mixing of 64-bit keys (fixed constants of splitmix64)."""
    x = keys.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sums of their counts (one column or several)."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts, first, axis=0)


def _dealt(kind: str, keys: np.ndarray, counts: np.ndarray, bucket: np.ndarray) -> Iterator[tuple]:
    """Rows ``(kind, bucket, keys, counts)`` for sorted keys."""
    order = np.argsort(bucket, kind="stable")
    keys, counts, bucket = keys[order], counts[order], bucket[order]
    cuts = np.concatenate(([0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [len(bucket)])) if len(bucket) else [0]
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield kind, int(bucket[a]), _steps(keys[a:b]), _pack(counts[a:b])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int32(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["kind", "bucket", "a", "b"])


def _write(folder: str, kind: str, bucket: int, arrays: list[np.ndarray]) -> str:
    path = f"{folder}/{kind}-{bucket:06d}-{TaskContext.get().taskAttemptId()}.bin"
    f = NewFile(path)
    for a in arrays:
        f.write(a.tobytes())
    f.close()
    return path


def _mapped(path: str) -> np.ndarray:
    fs, p = file_system(path)
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(p, np.uint8, "r") if os.path.getsize(p) else np.empty(0, np.uint8)
    with tempfile.NamedTemporaryFile() as local, fs.open_input_stream(p) as source:  # gone by name, kept by the map
        shutil.copyfileobj(source, local)
        local.flush()
        return np.memmap(local.name, np.uint8, "r") if os.path.getsize(local.name) else np.empty(0, np.uint8)


# ---- the mapped model ---------------------------------------------------------------
class Sorted:
    """Sorted hash arrays over several files, one a bucket."""

    def __init__(self, files: list[tuple[int, str, int]], buckets: int, columns: list):
        self.buckets, self.columns = buckets, columns
        self.files = {b: (path, n) for b, path, n in files}
        self.base, total = {}, 0
        for b in sorted(self.files):
            self.base[b] = total
            total += self.files[b][1]
        self.open: dict[int, list[np.ndarray]] = {}

    def arrays(self, bucket: int) -> list[np.ndarray]:
        if bucket not in self.open:
            path, n = self.files[bucket]
            raw, at, out = _mapped(path), 0, []
            for kind in [np.uint64, *self.columns]:
                size = n * np.dtype(kind).itemsize
                out.append(raw[at:at + size].view(kind))
                at += size
            self.open[bucket] = out
        return self.open[bucket]

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """For each hash its number (-1: not there) and the columns' values (0)."""
        distinct, back = np.unique(hashes, return_inverse=True)
        number = np.full(len(distinct), -1, np.int64)
        values = [np.zeros(len(distinct), k) for k in self.columns]
        bucket = bucket_of(distinct, self.buckets)
        cuts = np.concatenate(([0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [len(bucket)])) if len(bucket) else [0]
        for a, b in zip(cuts[:-1], cuts[1:]):
            k = int(bucket[a])
            if k not in self.files:
                continue
            own, *columns = self.arrays(k)
            at = np.minimum(np.searchsorted(own, distinct[a:b]), len(own) - 1)
            there = np.flatnonzero(own[at] == distinct[a:b])
            number[a + there] = self.base[k] + at[there]
            for v, c in zip(values, columns):
                v[a + there] = c[at[there]]
        return number[back], [v[back] for v in values]


WORD_COLUMNS = [np.uint64, np.uint32, np.uint32, np.uint32, np.uint32]
PAIR_COLUMNS = [np.uint32]


def pair_keys(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return before.astype(np.uint64) << np.uint64(32) | word.astype(np.uint64)


def discounts(counts_of_counts: list[int]) -> tuple[float, float, float]:
    n1, n2, n3, n4 = counts_of_counts[:4]
    if min(n1, n2, n3, n4) <= 0:
        return FALLBACK
    y = n1 / (n1 + 2 * n2)
    d = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return d if all(0 <= x <= i + 1 for i, x in enumerate(d)) else FALLBACK


def _discount_of(d: tuple[float, float, float], c: np.ndarray) -> np.ndarray:
    return np.array([0.0, *d])[np.minimum(c, 3).astype(np.int64)]


class Model:
    """Probabilities from mapped files and a few totals."""

    def __init__(self, made: dict):
        self.words = Sorted(made["words"], made["buckets"], WORD_COLUMNS)
        self.pairs = Sorted(made["pairs"], made["buckets"], PAIR_COLUMNS)
        self.n, self.v, self.k, self.docs = made["n"], made["v"], made["k"], made["docs"]
        self.d, self.e, self.t = discounts(made["pair_counts"]), discounts(made["k_counts"]), made["k_counts"]

    def log10(self, tokens: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each token its training count and log10 probability."""
        number, (count, k, *_) = self.words.find(tokens)
        context = contexts(tokens, ends)
        h_number, (h_count, _, n1, n2, n3) = self.words.find(context)
        seen = np.where(context == np.uint64(START), np.uint64(self.docs), h_count).astype(float)
        both = np.flatnonzero((number >= 0) & (h_number >= 0))
        c = np.zeros(len(tokens), np.uint32)
        c[both] = self.pairs.find(mixed(pair_keys(h_number[both], number[both])))[1][0]
        if self.k:
            free = (self.e[0] * self.t[0] + self.e[1] * self.t[1] + self.e[2] * self.t[4]) / self.k
            low = np.maximum(k - _discount_of(self.e, k), 0) / self.k + free / (self.v + 1)
        else:
            low = np.full(len(tokens), 1.0 / (self.v + 1))
        some = np.maximum(seen, 1.0)
        weight = np.where(seen > 0, (self.d[0] * n1 + self.d[1] * n2 + self.d[2] * n3) / some, 1.0)
        return count, np.log10(np.maximum(c - _discount_of(self.d, c), 0) / some + weight * low)

    def base_log10(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 0.5) / (self.n + 0.5 * (self.v + 1)))


# ---- counting in Spark ----------------------------------------------------------------
def _texts(batches: Iterator[pa.RecordBatch], column: int = 0) -> Iterator[list[str | None]]:
    for b in batches:
        for at in range(0, b.num_rows, 512):
            yield b.column(column).slice(at, 512).to_pylist()


def _merged(rows: pd.DataFrame, width: int = 0) -> tuple[np.ndarray, np.ndarray]:
    if not len(rows):
        return np.empty(0, np.uint64), np.empty((0, width) if width else 0, np.int64)
    counts = np.concatenate([_unpack(x, np.int64) for x in rows["b"]])
    return summed(np.concatenate([_keys(x) for x in rows["a"]]), counts.reshape(-1, width) if width else counts)


def fit(texts: DataFrame, folder: str, buckets: int | None = None) -> dict:
    """Train on the one text column of ``texts``; returns the files and totals of the model."""
    spark = texts.sparkSession
    buckets = buckets or max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    text = texts.select(F.col(texts.columns[0]).alias("text"))

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tokens, ends in runs(_texts(batches)):
            keys, counts = np.unique(tokens, return_counts=True)
            keys, counts = summed(np.append(keys, np.uint64(START)), np.append(counts, 0))
            rows = list(_dealt("word", keys, counts, bucket_of(keys, buckets)))
            rows.append(("docs", -1, _steps(np.array([0], np.uint64)), _pack(np.array([len(ends)], np.int64))))
            yield _batch(rows)

    def keep_words(rows: pd.DataFrame) -> pd.DataFrame:
        kind, bucket = rows["kind"].iloc[0], int(rows["bucket"].iloc[0])
        keys, counts = _merged(rows)
        if kind == "docs":
            return pd.DataFrame({"kind": ["docs"], "bucket": [bucket], "path": [""], "n": [0], "sums": [[int(counts.sum())]]})
        path = _write(folder, "vocabulary", bucket, [keys, counts.astype(np.uint64)])
        return pd.DataFrame({"kind": [kind], "bucket": [bucket], "path": [path], "n": [len(keys)], "sums": [[int(counts.sum()), int((counts > 0).sum())]]})

    found = stored(text.mapInArrow(count_words, _BUCKET).groupBy("kind", "bucket").applyInPandas(keep_words, _FILE), "lm-words").collect()
    vocabulary = [(r.bucket, r.path, r.n) for r in found if r.kind == "word"]
    totals = [r.sums for r in found if r.kind == "word"]
    docs = sum(r.sums[0] for r in found if r.kind == "docs")
    size = sum(n for _, _, n in vocabulary)
    if size >= 1 << 32:
        raise ValueError("more than 2^32 different words")
    share = max(1, -(-size // buckets))  # word numbers are dealt in ranges

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Sorted(vocabulary, buckets, [np.uint64])
        for tokens, ends in runs(_texts(batches)):
            number, _ = words.find(np.concatenate((tokens, contexts(tokens, ends))))
            keys, counts = np.unique(pair_keys(number[len(tokens):], number[:len(tokens)]), return_counts=True)
            yield _batch(list(_dealt("pair", keys, counts, bucket_of(mixed(keys), buckets))))

    def keep_pairs(rows: pd.DataFrame) -> pd.DataFrame:
        bucket = int(rows["bucket"].iloc[0])
        keys, counts = _merged(rows)
        hashes = mixed(keys)
        order = np.argsort(hashes)
        path = _write(folder, "pairs", bucket, [hashes[order], counts[order].astype(np.uint32)])
        sums = [int((counts == i).sum()) for i in (1, 2, 3, 4)]
        out = [("file", bucket, path.encode(), _pack(np.array([len(keys), *sums], np.int64)))]
        follow = np.stack([counts == 1, counts == 2, counts >= 3], axis=1).astype(np.int64)
        for kind, of, values in (("follow", keys >> np.uint64(32), follow), ("precede", keys & np.uint64(0xFFFFFFFF), np.ones(len(keys), np.int64))):
            of, values = summed(of, values)
            out += _dealt(kind, of, values, (of // np.uint64(share)).astype(np.int64))
        return pd.DataFrame(out, columns=["kind", "bucket", "a", "b"])

    made = stored(text.mapInArrow(count_pairs, _BUCKET).groupBy("kind", "bucket").applyInPandas(keep_pairs, _BUCKET), "lm-pairs")
    pair_files = [(r.bucket, r.a.decode(), _unpack(r.b, np.int64)) for r in made.where("kind = 'file'").collect()]

    def keep_sides(rows: pd.DataFrame) -> pd.DataFrame:
        part = int(rows["bucket"].iloc[0])
        follow, n = _merged(rows[rows["kind"] == "follow"], 3)
        precede, k = _merged(rows[rows["kind"] == "precede"])
        first = part * share
        table = np.zeros((min(size, first + share) - first, 4), np.uint32)
        table[follow.astype(np.int64) - first, 1:] = n
        table[precede.astype(np.int64) - first, 0] = k
        path = _write(folder, "sides", part, list(table.T))
        sums = [int((k == i).sum()) for i in (1, 2, 3, 4)] + [int((k >= 3).sum())]
        return pd.DataFrame({"kind": ["sides"], "bucket": [part], "path": [path], "n": [len(table)], "sums": [sums]})

    sides = stored(made.where("kind <> 'file'").groupBy("bucket").applyInPandas(keep_sides, _FILE), "lm-sides").collect()
    sides.sort(key=lambda r: r.bucket)
    parts = [(r.bucket * share, r.path, r.n) for r in sides]

    def keep_model(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Put the columns by word number beside the hashes of each vocabulary file."""
        for rows in batches:
            for bucket, path, n, base in zip(rows["bucket"], rows["path"], rows["n"], rows["base"]):
                raw, sides = _mapped(path), np.zeros((4, n), np.uint32)
                for first, other, m in parts:
                    a, b = max(first, base), min(first + m, base + n)
                    if a < b:
                        sides[:, a - base:b - base] = _mapped(other).view(np.uint32).reshape(4, m)[:, a - first:b - first]
                whole = _write(folder, "words", int(bucket), [raw, *sides])
                yield pd.DataFrame({"kind": ["words"], "bucket": [int(bucket)], "path": [whole], "n": [int(n)], "sums": [[]]})

    base, listed = 0, []
    for b, path, n in sorted(vocabulary):
        listed.append((b, path, n, base))
        base += n
    words = []
    if listed:
        tasks = spark.createDataFrame(listed, "bucket int, path string, n long, base long").repartition(len(listed))
        words = stored(tasks.mapInPandas(keep_model, _FILE), "lm-model").collect()
    pair_sums = np.sum([x[1:] for _, _, x in pair_files], axis=0).tolist() if pair_files else [0] * 4
    return {
        "buckets": buckets,
        "words": [(r.bucket, r.path, r.n) for r in words],
        "pairs": [(b, p, int(x[0])) for b, p, x in pair_files],
        "n": sum(s[0] for s in totals), "v": sum(s[1] for s in totals), "docs": docs,
        "k": int(sum(x[0] for _, _, x in pair_files)),
        "pair_counts": [int(x) for x in pair_sums],
        "k_counts": np.sum([r.sums for r in sides], axis=0).tolist() if sides else [0] * 5,
    }


def score(docs: DataFrame, model: dict) -> DataFrame:
    """``doc_id, n_tokens, n_known, base_score, score`` for each row of ``docs(doc_id, text)``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # names of files and totals

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(shared.value)
        for b in batches:
            at = 0
            for tokens, ends in runs(_texts(iter([b]), 1)):
                count, logp = m.log10(tokens, ends)
                starts = np.concatenate(([0], ends[:-1]))
                yield pa.RecordBatch.from_arrays([
                    b.column(0).slice(at, len(ends)),
                    pa.array(ends - starts), pa.array(np.add.reduceat((count > 0).astype(np.int64), starts)),
                    pa.array(np.add.reduceat(m.base_log10(count), starts)), pa.array(np.add.reduceat(logp, starts)),
                ], names=["doc_id", "n_tokens", "n_known", "base_score", "score"])
                at += len(ends)

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, n_tokens long, n_known long, base_score double, score double")


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 1, F.lit(False))


def scoring_report(docs: DataFrame) -> DataFrame:
    model = fit(docs.where(~held_out(F.col("doc_id"))).select("text"), scratch_path(docs.sparkSession, "lm-data"))
    out = score(docs, model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known",
                      F.lit(model["n"]).cast("long").alias("train_tokens"), "base_score", "score",
                      F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))
