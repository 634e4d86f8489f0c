"""Phrase collocation mining over sorted count streams.

Texts are lower-cased (A-Z), cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and these into words
``[^\\x20\\x09]+``; everything is per language (NULL: ``und``). ``f`` of a phrase counts its
contiguous occurrences within pieces. Candidates are phrases of 2 or 3 words with
``a = f >= LEAST``; each cut into a first part (count ``l``) and a rest (count ``r``) scores
``floor(1000000 * a * a / (l * r))``, the lowest cut counts, ties to the shortest first part. A
candidate inside a longer one with ``100 * f(longer) >= INSIDE * a`` is dropped; the best
``TOP`` of each language are returned.

Layout, as n-gram models are estimated in external memory: one stream of all counts that can
matter (one to three words, each at least ``LEAST``, as every part of a candidate has its count at least)
is kept in prefix order, so a phrase follows its first one and its first two words; and once more in suffix order,
words reversed, where it follows its last ones. Each stream is read in order once, all lengths in
lockstep: the counts of the shorter phrases last passed are the ``l`` of the row in prefix order
and the ``r`` in suffix order, and the largest three-word count that passes below a pair
is its extension to the right, or to the left. No hash table is looked into. Streams are dealt by ranges of the
whole key, so no word or language is too large for a task; what a range's first rows follow in ranges before
is handed on (two rows a range).

Counting: tasks cut byte buffers with vector operations and send sums for each
``CHUNK`` words, in prefix order, packed as one table for each bucket of phrases. Phrases are dealt to buckets evenly, so
many that the counts of one, from about ``BUCKET_BYTES`` of text, are added up in bounded memory. Pairs are counted first; a phrase of three words can only reach ``LEAST`` if both its pairs
do, so only such are counted then, tested in a bit table of at most ``2 ** MAX_BITS`` bits that is
broadcast (32 MB). Where the pairs outgrow it, more phrases pass and are counted and left out exactly.

Arithmetic: counts up to 10^15, products as decimals of 38 digits.

Defined cases: a NULL text is empty; repeated rows count each; ties in the order are resolved by the phrase,
which is unique in a language; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .common import LOWER_AZ, stored

LEAST, INSIDE, TOP, SCALE = 10, 50, 2000, 1_000_000
#: Words, or bytes of words, that a task sums up before it sends counts, and bytes it cuts at once.
CHUNK, CHUNK_BYTES, BUFFER = 1_000_000, 1 << 25, 1 << 22
#: Bytes of text for each bucket that counts are added up in.
BUCKET_BYTES = 1 << 22
MAX_BITS = 28
_SLICES = 64
_KIND = np.zeros(256, np.uint8)  # 0: in a word, 1: between words, 2: between pieces
_KIND[list(b" \t")] = 1
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = 2
_LOWER = np.frombuffer(LOWER_AZ, np.uint8)


# ---- words of texts ---------------------------------------------------------------
class Words:
    """The words of some texts in order: ``words`` (binary array) and ``piece``, a number for each word's piece."""

    def __init__(self):
        self.words, self.pieces, self.n, self.size, self.next = [], [], 0, 0, 0

    def add(self, raw: bytes) -> None:
        """Whole pieces as UTF-8."""
        b = np.frombuffer(raw, np.uint8)
        kind = _KIND[b]
        inside = np.concatenate(([False], kind == 0, [False]))
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edge[::2], edge[1::2]
        if not len(starts):
            return
        offsets = np.zeros(len(starts) + 1, np.int32)
        np.cumsum(ends - starts, out=offsets[1:])
        data = _LOWER[b[kind == 0]]
        self.words.append(pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)]))
        breaks = np.cumsum(kind == 2, dtype=np.int64)
        self.pieces.append(breaks[starts] + self.next)
        self.next += int(breaks[-1]) + 1
        self.n += len(starts)
        self.size += len(data)

    def full(self, chunk: int) -> bool:
        return self.n >= chunk or self.size >= CHUNK_BYTES

    def ids(self) -> tuple[np.ndarray, pa.Array, np.ndarray]:
        """Each word's number, the different words, each word's piece."""
        coded = pa.concat_arrays(self.words).dictionary_encode()
        return coded.indices.to_numpy().astype(np.int64), coded.dictionary.view(pa.string()), np.concatenate(self.pieces)


def buffers(texts: list[bytes], size: int = BUFFER) -> Iterator[bytes]:
    """The texts as buffers of about ``size`` bytes that end between pieces; a longer text is cut between pieces."""
    held, n = [], 0
    for t in texts:
        at = 0
        while len(t) - at > size:  # a very long text
            end = max((t.rfind(s, at, at + size) for s in (b".", b",", b"\n", b";", b":", b"!", b"?")), default=-1)
            if end < 0:
                ends = [e for e in (t.find(s, at + size) for s in (b".", b",", b"\n", b";", b":", b"!", b"?")) if e >= 0]
                if not ends:
                    break
                end = min(ends)
            yield b"\n".join([*held, t[at:end + 1]])
            held, n, at = [], 0, end + 1
        held.append(t[at:])
        n += len(t) - at
        if n >= size:
            yield b"\n".join(held)
            held, n = [], 0
    if held:
        yield b"\n".join(held)


# ---- counts -----------------------------------------------------------------------
_COUNTS = "lang string, w1 string, w2 string, w3 string, c long"


def bucket_number(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> int:
    """So many buckets that about ``bucket_bytes`` of text are counted in one."""
    size = docs.agg(F.sum(F.octet_length("text"))).collect()[0][0] or 0
    return max(1, -(-size // bucket_bytes))


def _mix(lang: str, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A number of 64 bits for each pair of words, from numbers of the words."""
    with np.errstate(over="ignore"):
        x = first * np.uint64(0x9E3779B97F4A7C15) + second * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass")))
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(32))


def _word_numbers(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def _dealt(vocabulary: pa.Array, ids: list[np.ndarray | None], count: np.ndarray, lang: str, numbers: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes]]:
    """Counts of phrases, in the order given, as one packed table for each bucket; words not there are empty."""
    x = _mix(lang, numbers[ids[0]], numbers[ids[-1]] if ids[-1] is not None else np.zeros(len(count), np.uint64))
    bucket = ((x >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    for own in np.split(order, cuts) if len(order) else ():
        words = [pa.array([""] * len(own), pa.string()) if i is None else vocabulary.take(pa.array(i[own])) for i in ids]
        yield int(bucket[own[0]]), _packed(lang, [*words, *[pa.array([""] * len(own), pa.string())] * (3 - len(words))], count[own])


def _packed(lang: str, words: list[pa.Array], count: np.ndarray) -> bytes:
    sink = pa.BufferOutputStream()
    table = pa.RecordBatch.from_arrays([*words, pa.array(count.astype(np.int64))], schema=pa.schema([("w1", pa.string()), ("w2", pa.string()), ("w3", pa.string()), ("c", pa.int64())], metadata={"lang": lang}))
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_batch(table)
    return sink.getvalue().to_pybytes()


def _sent(docs: DataFrame, emit, chunk: int) -> DataFrame:
    """``bucket, packed``: ``emit(lang, words)`` of each language's texts, for about every ``chunk`` words of a task."""
    def rows(parts: Iterator[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for part in parts:
            held.append(part)
            size += len(part[1])
            if size > 1 << 22:
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in held], pa.int32()), pa.array([b for _, b in held], pa.binary())], names=["bucket", "packed"])
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in held], pa.int32()), pa.array([b for _, b in held], pa.binary())], names=["bucket", "packed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by: dict[str, Words] = {}
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                b = whole.slice(at, 1000)
                langs = b.column(0).dictionary_encode()
                names, index = langs.dictionary.to_pylist(), langs.indices.to_numpy(zero_copy_only=False)
                for k, name in enumerate(names):
                    for raw in buffers(b.column(1).take(pa.array(np.flatnonzero(index == k))).view(pa.binary()).to_pylist()):
                        by.setdefault(name, Words()).add(raw)
                        if by[name].full(chunk):
                            yield from rows(emit(name, by.pop(name)))
                            pa.default_memory_pool().release_unused()
                if sum(w.n for w in by.values()) >= 2 * chunk or sum(w.size for w in by.values()) >= 2 * CHUNK_BYTES:  # many languages
                    for name in list(by):
                        yield from rows(emit(name, by.pop(name)))
        for name in list(by):
            yield from rows(emit(name, by.pop(name)))

    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(run, "bucket int, packed binary")


def _sums(parts: list[bytes], least: int) -> Iterator[pa.RecordBatch]:
    """The counts of one bucket, added up; those below ``least`` are left out."""
    by: dict[str, list[pa.Table]] = {}
    for part in parts:
        table = pa.ipc.open_stream(part).read_all()
        by.setdefault((table.schema.metadata or {}).get(b"lang", b"").decode(), []).append(table.replace_schema_metadata(None))
    for lang, tables in by.items():
        table = pa.concat_tables(tables).combine_chunks()
        codes = [_flat(table[w]).dictionary_encode() for w in ("w1", "w2", "w3")]
        i1, i2, i3 = (c.indices.to_numpy(zero_copy_only=False).astype(np.int64) for c in codes)
        _, key = np.unique(i1 * len(codes[1].dictionary) + i2, return_inverse=True)
        key = key * len(codes[2].dictionary) + i3
        order = np.argsort(key, kind="stable")
        starts = np.concatenate(([0], np.flatnonzero(np.diff(key[order])) + 1))
        count = np.add.reduceat(table["c"].to_numpy()[order], starts)
        first = order[starts]
        kept = count >= least
        words = [_flat(table[w]).take(pa.array(first[kept])) for w in ("w1", "w2", "w3")]
        n = int(kept.sum())
        yield pa.RecordBatch.from_arrays([pa.array([lang] * n, pa.string()), *words, pa.array(count[kept])], names=["lang", "w1", "w2", "w3", "c"])


def _flat(x) -> pa.Array:
    return x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x


def summed(sent: DataFrame, least: int) -> DataFrame:
    """``lang, w1, w2, w3, c``: counts of at least ``least``; each bucket is added up by one task at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, parts = None, []
        for b in batches:  # sorted by bucket
            for k, part in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if k != bucket and parts:
                    yield from _sums(parts, least if bucket >= 0 else 1)
                    parts = []
                    pa.default_memory_pool().release_unused()
                bucket = k
                parts.append(part)
        if parts:
            yield from _sums(parts, least if bucket >= 0 else 1)

    sums = sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, _COUNTS)
    return sums.select("lang", *[F.nullif(w, F.lit("")).alias(w) for w in ("w1", "w2", "w3")], "c")


def _pairs(ids: np.ndarray, piece: np.ndarray) -> np.ndarray:
    """Whether a word and the next are in one piece."""
    return piece[1:] == piece[:-1]


def short_counts(docs: DataFrame, buckets: int, least: int = LEAST, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """``lang, w1, w2, w3, c`` of words and pairs; and ``lang, n``, all words of a language."""
    def emit(lang: str, words: Words) -> Iterator[tuple[int, bytes]]:
        if not words.n:
            return
        ids, vocabulary, piece = words.ids()
        yield -1, _packed(lang, [pa.array([""])] * 3, np.array([len(ids)]))
        numbers = _word_numbers(vocabulary.view(pa.binary()).to_pylist())
        yield from _dealt(vocabulary, [np.arange(len(vocabulary)), None], np.bincount(ids, minlength=len(vocabulary)), lang, numbers, buckets)
        at = np.flatnonzero(_pairs(ids, piece))
        key, count = np.unique(ids[at] * len(vocabulary) + ids[at + 1], return_counts=True)
        yield from _dealt(vocabulary, [key // len(vocabulary), key % len(vocabulary)], count, lang, numbers, buckets)

    sent = stored(summed(_sent(docs, emit, chunk), least), "collocation-short")
    return sent.where("w1 IS NOT NULL"), sent.where("w1 IS NULL").select("lang", F.col("c").alias("n"))


# ---- pairs that may be in a phrase of three words -------------------------------------
class PairTable:
    """A bit for each number of a pair; a pair without its bit is not frequent."""

    def __init__(self, bits: int, table: np.ndarray):
        self.bits, self.table = bits, table

    def has(self, x: np.ndarray) -> np.ndarray:
        at = (x >> np.uint64(64 - self.bits)).astype(np.int64)
        return (self.table[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1


def pair_table(spark: SparkSession, pairs: DataFrame, max_bits: int = MAX_BITS) -> PairTable:
    """The bits of ``pairs(lang, w1, w2)``, 16 a pair as far as ``max_bits`` reaches."""
    bits = min(max_bits, max(10, (16 * pairs.count()).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            first, second = (_word_numbers(b.column(k).view(pa.binary()).to_pylist()) for k in (1, 2))
            langs = b.column(0).dictionary_encode()
            index, found = langs.indices.to_numpy(zero_copy_only=False), np.zeros(b.num_rows, np.uint64)
            for k, lang in enumerate(langs.dictionary.to_pylist()):
                own = index == k
                found[own] = _mix(lang, first[own], second[own])
            at = (found >> np.uint64(64 - bits)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at >> 6), pa.array((np.uint64(1) << (at & 63).astype(np.uint64)).view(np.int64))], names=["at", "bit"])

    set_bits = pairs.select("lang", "w1", "w2").mapInArrow(run, "at long, bit long").groupBy("at").agg(F.bit_or("bit").alias("bit")).toArrow()  # at most 2 ** (max_bits - 6) rows
    table = np.zeros(1 << (bits - 6), np.uint64)
    table[set_bits["at"].to_numpy()] = set_bits["bit"].to_numpy().view(np.uint64)
    return PairTable(bits, table)


def triple_counts(docs: DataFrame, frequent: PairTable, buckets: int, least: int = LEAST, chunk: int = CHUNK) -> DataFrame:
    """``lang, w1, w2, w3, c`` of phrases of three words; only those both of whose pairs may be frequent are sent."""
    shared = docs.sparkSession.sparkContext.broadcast((frequent.bits, frequent.table))

    def emit(lang: str, words: Words) -> Iterator[tuple[int, bytes]]:
        if words.n < 3:
            return
        ids, vocabulary, piece = words.ids()
        numbers = _word_numbers(vocabulary.view(pa.binary()).to_pylist())
        pair = _pairs(ids, piece)
        some = np.flatnonzero(pair)
        pair[some] = PairTable(*shared.value).has(_mix(lang, numbers[ids[some]], numbers[ids[some + 1]]))
        at = np.flatnonzero(pair[:-1] & pair[1:])
        # pairs are numbered anew, so that the key of a phrase fits 64 bits
        first, start = np.unique(ids[at] * len(vocabulary) + ids[at + 1], return_inverse=True)
        key, count = np.unique(start * len(vocabulary) + ids[at + 2], return_counts=True)
        start = first[key // len(vocabulary)]
        yield from _dealt(vocabulary, [start // len(vocabulary), start % len(vocabulary), key % len(vocabulary)], count, lang, numbers, buckets)

    return stored(summed(_sent(docs, emit, chunk), least), "collocation-triples")


# ---- streams ------------------------------------------------------------------------
_STREAM = "lang string, x1 string, x2 string, x3 string, c long"
_FACTS = pa.schema([("lang", pa.string()), ("x1", pa.string()), ("x2", pa.string()), ("x3", pa.string()), ("c", pa.int64()), ("one", pa.int64()), ("two", pa.int64()), ("ext", pa.int64())])


def _last(where: np.ndarray) -> np.ndarray:
    """For each row the last row up to it at which ``where`` holds, -1 if there is none."""
    return np.maximum.accumulate(np.where(where, np.arange(len(where)), -1))


def lockstep(stream: DataFrame) -> DataFrame:
    """The pass over one stream ``lang, x1, x2, x3, c`` (words in the stream's order, shorter phrases NULL at the end).

    Rows ``lang, x1, x2, x3, c, one, two, ext``: each pair with ``one``, the count of its
    first word; each triple with ``one`` and ``two``, the count of its first pair; and
    for pairs that triples follow, ``ext``, the largest count of these (one row for each batch they are in, ``c`` NULL).
    """
    spark = stream.sparkSession
    ensure_checkpoint_dir(spark)
    order = ["lang", "x1", "x2", "x3"]
    # the range's number stands in its rows: a task's own number is another one where the result is part of a union
    ordered = stream.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("p", F.spark_partition_id()).checkpoint()  # keeps its partitions
    # the last word and the last pair of each range: two rows a range
    seen = ordered.where("x3 IS NULL").groupBy("p", F.col("x2").isNull().alias("word")).agg(
        F.max(F.struct("lang", "x1", "x2", "c")).alias("last")).orderBy("p").collect()
    carried: dict[bool, list[tuple[int, int]]] = {True: [], False: []}
    for r in seen:
        carried[r.word].append((r.p, r.last.c))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = two = None
        for b in batches:
            if not b.num_rows:
                continue
            if one is None:  # what stands last in the ranges before: it is what the first rows here follow, if they follow any
                p = b.column(5)[0].as_py()
                one, two = (next((c for q, c in reversed(carried[w]) if q < p), 0) for w in (True, False))
            b = b.select([0, 1, 2, 3, 4])
            c = b.column(4).to_numpy()
            word, triple = (b.column(k).is_null().to_numpy(zero_copy_only=False) for k in (2, 3))
            triple = ~triple
            pair = ~word & ~triple
            at1, at2 = _last(word), _last(pair)
            ones, twos = np.where(at1 >= 0, c[at1], one), np.where(at2 >= 0, c[at2], two)
            one, two = int(ones[-1]), int(twos[-1])
            out = np.flatnonzero(~word)
            if len(out):
                rows = b.take(pa.array(out))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(ones[out]), pa.array(twos[out], mask=pair[out]), pa.nulls(len(out), pa.int64())], schema=_FACTS)
            t = np.flatnonzero(triple)
            if len(t):  # triples of one pair stand together: a new pair stands before each such group
                group = np.concatenate(([0], np.flatnonzero(at2[t][1:] != at2[t][:-1]) + 1))
                most = np.maximum.reduceat(c[t], group)
                heads = b.take(pa.array(t[group]))
                none = pa.nulls(len(group), pa.int64())
                yield pa.RecordBatch.from_arrays([*heads.columns[:3], pa.nulls(len(group), pa.string()), none, none, none, pa.array(most)], schema=_FACTS)

    return ordered.mapInArrow(run, _STREAM + ", one long, two long, ext long")


def scored(words: DataFrame, pairs: DataFrame, triples: DataFrame) -> DataFrame:
    """``lang, w1, w2, w3, a, l, r, score`` of the candidates that are left, from counts of at least ``LEAST``."""
    none = F.lit(None).cast("string")
    stream = lambda one, two, three: words.select("lang", F.col("w1").alias("x1"), none.alias("x2"), none.alias("x3"), "c").unionByName(
        pairs.select("lang", F.col(two[0]).alias("x1"), F.col(two[1]).alias("x2"), none.alias("x3"), "c")).unionByName(
        triples.select("lang", *[F.col(w).alias(f"x{i + 1}") for i, w in enumerate(three)], "c"))
    prefix = lockstep(stream("w1", ("w1", "w2"), ("w1", "w2", "w3")))
    suffix = lockstep(stream("w1", ("w2", "w1"), ("w3", "w2", "w1")))
    is_triple = F.col("x3").isNotNull()
    back = [F.when(is_triple, F.col("x3")).otherwise(F.col("x2")).alias("w1"), F.when(is_triple, F.col("x2")).otherwise(F.col("x1")).alias("w2"), F.when(is_triple, F.col("x1")).alias("w3")]
    null = F.lit(None).cast("long")
    facts = prefix.select("lang", F.col("x1").alias("w1"), F.col("x2").alias("w2"), F.col("x3").alias("w3"), "c", F.col("one").alias("l1"), F.col("two").alias("l2"), null.alias("r1"), null.alias("r2"), "ext").unionByName(
        suffix.select("lang", *back, "c", null.alias("l1"), null.alias("l2"), F.col("one").alias("r1"), F.col("two").alias("r2"), "ext"))
    each = facts.groupBy("lang", "w1", "w2", "w3").agg(*[F.max(x).alias(x) for x in ("c", "l1", "l2", "r1", "r2", "ext")])
    left = each.where(f"ext IS NULL OR 100 * ext < {INSIDE} * c")
    big = lambda x: f"CAST({x} AS DECIMAL(15,0))"
    cut = lambda left, right: f"({SCALE} * {big('c')} * {big('c')}) div ({big(left)} * {big(right)})"
    # a pair has one cut; a triple is cut after its first word (the rest counts r2) or after its second
    at1 = f"CASE WHEN w3 IS NULL THEN {cut('l1', 'r1')} ELSE {cut('l1', 'r2')} END"
    both = left.withColumns({"s1": F.expr(at1), "s2": F.expr(f"CASE WHEN w3 IS NOT NULL THEN {cut('l2', 'r1')} END")})
    second = F.coalesce(F.col("s2") < F.col("s1"), F.lit(False))
    return both.select("lang", "w1", "w2", "w3", F.col("c").alias("a"), F.when(second, F.col("l2")).otherwise(F.col("l1")).alias("l"),
                       F.when(second | F.col("w3").isNull(), F.col("r1")).otherwise(F.col("r2")).alias("r"), F.when(second, F.col("s2")).otherwise(F.col("s1")).alias("score"))


def collocations(docs: DataFrame, top: int = TOP, least: int = LEAST, max_bits: int = MAX_BITS, chunk: int = CHUNK, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best ``top`` phrases of each language."""
    buckets = bucket_number(docs, bucket_bytes)
    short, total = short_counts(docs, buckets, least, chunk)
    words, pairs = short.where("w2 IS NULL").select("lang", "w1", "c"), short.where("w2 IS NOT NULL").select("lang", "w1", "w2", "c")
    triples = triple_counts(docs, pair_table(docs.sparkSession, pairs, max_bits), buckets, least, chunk)
    phrase = F.concat_ws(" ", "w1", "w2", "w3")
    rows = scored(words, pairs, triples).select("lang", phrase.alias("phrase"), "a", "l", "r", "score")
    # a language is ranked in slices first, so that its last ranking sees at most _SLICES * top rows
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    sliced = rows.withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(_SLICES)))
    few = sliced.withColumn("rank", F.row_number().over(W.partitionBy("lang", "slice").orderBy(*best))).where(F.col("rank") <= top)
    ranked = few.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*best))).where(F.col("rank") <= top)
    return ranked.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def collocation_report(docs: DataFrame) -> DataFrame:
    return collocations(docs)
