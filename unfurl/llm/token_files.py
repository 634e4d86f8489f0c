"""Token-id files of patched frame-of-reference blocks.

A file holds the ids of many documents as one stream, cut into blocks of ``BLOCK`` ids.
A block stores its minimum and its differences to it, packed at the width that holds
``PERCENTILE`` of them; the high bits of the others go to an exception list of positions
and values. The footer has where each block starts, and each document's id and first
token, so any document is read by decoding its own blocks only.

    block    minimum u32, width u8, exceptions u16, positions u16 ..., high bits u32 ..., packed low bits
    footer   block starts u64 (one more than blocks), document ids i64, known ids u8, document starts u64 (one more)
    trailer  magic 8 bytes, block size u32, tokens u64, documents u64, footer start u64

All numbers are little-endian. Spark deals documents to tasks by ranges of ``doc_id``, sorted,
so files in order of (task, number in the task) hold all documents in ascending order.
Each task writes files of at most about ``FILE_TOKENS`` ids; a file appears only when whole,
and the table of files (one row a file) holds those of tasks that succeeded. Start
offsets come from a running sum over that table.

The tokenizers library encodes whole texts; with a byte-level vocabulary a task gives it
each distinct part between single spaces once: texts are split, and their parts numbered and replaced
by ids, with vector operations over some texts at once. The ids of short parts are remembered (a bounded number;
forgetting changes no result).

Defined cases: a NULL text has the end id alone; rows with equal ids follow each
other, by text; NULL ids come first; an empty table gives no file and no row; further
columns are not read.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import stored
from .files import NewFile, open_file

MAGIC = b"PFORTOK1"
BLOCK, PERCENTILE, FILE_TOKENS, END_ID = 1024, 0.9, 1 << 23, 2
#: Parts that a task remembers, and the characters of the longest that it does: some 250 MB of Python objects at most.
REMEMBERED, LONGEST_PART = 1_000_000, 32
_TRAILER = struct.Struct("<8sIQQQ")
_HEAD = struct.Struct("<IBH")
_AT_ONCE = 256  # blocks packed or unpacked together
_TEXTS = 512  # texts encoded together
_PUNCTUATION = ".,;:!?"
# Fixed: byte-level vocabularies write the bytes 80 to A0 and AD, which have no visible letter, from U+0122 on.
_BYTE_LETTERS = {b: chr(0x122 + i) for i, b in enumerate([*range(0x80, 0xA1), 0xAD])}


# ---- blocks -------------------------------------------------------------------
def pack_blocks(ids: np.ndarray, block: int = BLOCK, percentile: float = PERCENTILE) -> list[bytes]:
    """Blocks of ``ids`` (uint32); the last is filled up with its minimum."""
    out: list[bytes] = []
    for at in range(0, len(ids), block * _AT_ONCE):
        part = ids[at:at + block * _AT_ONCE]
        n = -(-len(part) // block)
        rows = np.empty((n, block), np.uint32)
        rows.reshape(-1)[:len(part)] = part
        if len(part) < n * block:
            rows.reshape(-1)[len(part):] = part[(n - 1) * block:].min()
        low = rows.min(1)
        delta = rows - low[:, None]
        k = min(block - 1, int(np.ceil(percentile * block)) - 1)
        width = np.ceil(np.log2(np.partition(delta, k, axis=1)[:, k].astype(np.float64) + 1)).astype(np.uint8)
        high = (delta.astype(np.uint64) >> width[:, None].astype(np.uint64)).astype(np.uint32)
        packed: list[bytes] = [b""] * n
        for w in np.unique(width):
            own = np.flatnonzero(width == w)
            if w:
                bits = ((delta[own][:, :, None] >> np.arange(w, dtype=np.uint32)) & np.uint32(1)).astype(np.uint8)
                for i, p in zip(own, np.packbits(bits.reshape(len(own), -1), axis=1, bitorder="little")):
                    packed[i] = p.tobytes()
        for i in range(n):
            odd = np.flatnonzero(high[i])
            out.append(_HEAD.pack(int(low[i]), int(width[i]), len(odd)) + odd.astype("<u2").tobytes() + high[i][odd].astype("<u4").tobytes() + packed[i])
    return out


def unpack_blocks(data: bytes, starts: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """The ids of neighbouring blocks; ``starts`` are where they begin in ``data``, and the end."""
    n = len(starts) - 1
    out = np.empty((n, block), np.uint32)
    groups: dict[int, list[tuple[int, int]]] = {}
    odd: list[tuple[int, np.ndarray, np.ndarray, int]] = []
    low = np.empty(n, np.uint32)
    for i in range(n):
        at = int(starts[i])
        low[i], width, n_odd = _HEAD.unpack_from(data, at)
        at += _HEAD.size
        if n_odd:
            odd.append((i, np.frombuffer(data, "<u2", n_odd, at), np.frombuffer(data, "<u4", n_odd, at + 2 * n_odd), width))
        groups.setdefault(width, []).append((i, at + 6 * n_odd))
    for w, members in groups.items():
        rows = [i for i, _ in members]
        if not w:
            out[rows] = 0
            continue
        size = block * w // 8
        packed = np.stack([np.frombuffer(data, np.uint8, size, a) for _, a in members])
        bits = np.unpackbits(packed, axis=1, bitorder="little").reshape(len(members), block, w)
        whole = np.zeros((len(members), block, 32), np.uint8)
        whole[:, :, :w] = bits
        out[rows] = np.packbits(whole, axis=2, bitorder="little").view("<u4")[:, :, 0]
    for i, places, high, w in odd:
        out[i, places] |= (high.astype(np.uint64) << np.uint64(w)).astype(np.uint32)
    return (out + low[:, None]).reshape(-1)


# ---- files --------------------------------------------------------------------
class TokenFileWriter:
    def __init__(self, path: str, block: int = BLOCK, percentile: float = PERCENTILE):
        if block % 8 or not 8 <= block <= 1 << 15:
            raise ValueError("the block size must be a multiple of 8, at most 32768")
        self.file, self.block, self.percentile = NewFile(path), block, percentile
        self.pending: list[np.ndarray] = []
        self.n_pending, self.n_tokens = 0, 0
        self.block_starts, self.doc_ids, self.doc_starts = [], [], []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.doc_starts.append(self.n_tokens)
        self.n_tokens += len(ids)
        self.pending.append(ids)
        self.n_pending += len(ids)
        if self.n_pending >= self.block * _AT_ONCE:
            self._flush(self.n_pending // self.block * self.block)

    def _flush(self, n: int) -> None:
        whole = np.concatenate(self.pending) if self.pending else np.empty(0, np.uint32)
        for b in pack_blocks(whole[:n], self.block, self.percentile):
            self.block_starts.append(self.file.size)
            self.file.write(b)
        self.pending, self.n_pending = [whole[n:]], len(whole) - n

    def close(self) -> None:
        self._flush(self.n_pending)
        footer = self.file.size
        self.file.write(np.array([*self.block_starts, footer], "<u8").tobytes())
        self.file.write(np.array([i or 0 for i in self.doc_ids], "<i8").tobytes())
        self.file.write(np.array([i is not None for i in self.doc_ids], np.uint8).tobytes())
        self.file.write(np.array([*self.doc_starts, self.n_tokens], "<u8").tobytes())
        self.file.write(_TRAILER.pack(MAGIC, self.block, self.n_tokens, len(self.doc_ids), footer))
        self.file.close()


class TokenFile:
    """Reader with random access to documents and tokens."""

    def __init__(self, path: str):
        self.file = open_file(path)
        size = self.file.size()
        self.file.seek(max(0, size - _TRAILER.size))
        tail = self.file.read(_TRAILER.size)
        if len(tail) < _TRAILER.size or tail[:8] != MAGIC:
            raise ValueError(f"{path} is not a token file")
        _, self.block, self.n_tokens, self.n_docs, footer = _TRAILER.unpack(tail)
        self.file.seek(footer)
        data = self.file.read(size - _TRAILER.size - footer)
        blocks = -(-self.n_tokens // self.block) + 1
        self.block_starts = np.frombuffer(data, "<u8", blocks)
        at = 8 * blocks
        self.doc_ids = np.frombuffer(data, "<i8", self.n_docs, at)
        self.known = np.frombuffer(data, np.uint8, self.n_docs, at + 8 * self.n_docs)
        self.doc_starts = np.frombuffer(data, "<u8", self.n_docs + 1, at + 9 * self.n_docs)

    def tokens(self, start: int, stop: int) -> np.ndarray:
        """Tokens ``start`` to ``stop`` of the file; only their blocks are read."""
        if stop <= start:
            return np.empty(0, np.uint32)
        a, b = start // self.block, -(-stop // self.block)
        first = int(self.block_starts[a])
        self.file.seek(first)
        data = self.file.read(int(self.block_starts[b]) - first)
        return unpack_blocks(data, self.block_starts[a:b + 1] - np.uint64(first), self.block)[start - a * self.block:stop - a * self.block]

    def document(self, i: int) -> np.ndarray:
        return self.tokens(int(self.doc_starts[i]), int(self.doc_starts[i + 1]))

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """``(doc_id, start, ids)`` of all documents, reading on block by block."""
        step, at, part = self.block * _AT_ONCE, 0, np.empty(0, np.uint32)
        for i in range(self.n_docs):
            start, stop = int(self.doc_starts[i]), int(self.doc_starts[i + 1])
            pieces = []
            while True:
                pieces.append(part[start - at:stop - at])
                if stop <= at + len(part):
                    break
                start = at = at + len(part)
                part = self.tokens(at, min(self.n_tokens, at + step))
            yield (int(self.doc_ids[i]) if self.known[i] else None), int(self.doc_starts[i]), np.concatenate(pieces) if len(pieces) > 1 else pieces[0]

    def close(self) -> None:
        self.file.close()


# ---- encoding -----------------------------------------------------------------
class LibraryEncoder:
    """Ids (little-endian u32 bytes) of whole texts by the tokenizers library.

    A byte-level pre-tokenizer never joins what stands on both sides of a single space, and gives
    that space to what follows. So where a text's spaces are single and no other white space
    touches them, its ids are those of its parts ``" part"`` in order. New parts of many
    texts go to the library as one text, whose ids are cut by the bytes they stand
    for; parts seen before are looked up. Any other text goes to the library whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True  # their strings in a text are ordinary text
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        pre = made.get("pre_tokenizer") or {}
        self.by_part = (pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
                        and not any(made.get(k) for k in ("normalizer", "truncation", "padding")))
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        # a byte-level token has one character for each byte it stands for
        self.n_bytes = np.zeros(1 + max(vocabulary.values(), default=0), np.int64)
        for token, i in vocabulary.items():
            self.n_bytes[i] = len(token)
        self.known: dict[str, bytes] = {}  # parts of up to LONGEST_PART characters
        self.tails: dict[str, bytes] = {}  # punctuation without a space before it

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _learned(self, parts: list[str]) -> dict[str, bytes]:
        """Ids of new parts. A word of Latin letters, with or without punctuation behind it, is one piece of the pre-tokenizer
        and one of punctuation, so the library's model takes it by itself; others are encoded with the space, many as one text."""
        out: dict[str, bytes] = {}
        rest: list[str] = []
        known, tails, tokenize = self.known, self.tails, self.library.model.tokenize
        for p in parts:
            word = p.rstrip(_PUNCTUATION)
            if not word.isalpha() or max(word) >= "\u0250":
                rest.append(p)
                continue
            ids = known.get(word) or out.get(word)
            if ids is None:
                spelt = word if word.isascii() else word.encode().decode("latin-1").translate(_BYTE_LETTERS)
                out[word] = ids = struct.pack(f"<{len(made)}I", *made) if (made := [t.id for t in tokenize("\u0120" + spelt)]) else b""
            if len(word) < len(p):
                tail = p[len(word):]
                if tail not in tails:
                    if len(tails) >= 10_000:
                        tails.clear()
                    tails[tail] = self._whole([tail])[0]
                out[p] = ids + tails[tail]
        for at in range(0, len(rest), 64):
            some = rest[at:at + 64]
            (e,) = self.library.encode_batch_fast([" " + " ".join(some)], add_special_tokens=False)
            ids = np.array(e.ids, "<u4")
            ends = np.cumsum([1 + len(p.encode("utf-8", "surrogatepass")) for p in some])
            raw, cuts = ids.tobytes(), [0, *(4 * (np.searchsorted(np.cumsum(self.n_bytes[ids]), ends) + 1)).tolist()]
            out.update(zip(some, map(raw.__getitem__, map(slice, cuts, cuts[1:]))))
        return out

    def _ids_of(self, parts: list[str]) -> list[bytes | None]:
        """Ids of different parts ``" part"``; None for those that white space other than single spaces touches."""
        found = list(map(self.known.get, parts))
        unknown = [i for i, x in enumerate(found) if x is None]
        new = [p for p in map(parts.__getitem__, unknown) if p and not p[0].isspace() and not p[-1].isspace()]
        if new:
            learned = self._learned(new)
            for i in unknown:
                found[i] = learned.get(parts[i])
            if len(self.known) < REMEMBERED:  # frequent parts come early and stay
                self.known.update((p, x) for p, x in learned.items() if len(p) <= LONGEST_PART)
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_part or not texts:
            return self._whole(texts)
        n = len(texts)
        split = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        offsets, coded = split.offsets.to_numpy(), split.flatten().dictionary_encode()
        codes, parts = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        first = codes[offsets[:-1]]
        rest = np.ones(len(codes), bool)
        rest[offsets[:-1]] = False
        rest = codes[rest]
        cuts = offsets - np.arange(n + 1)  # the parts after the first, before each text
        ids = self._ids_of(parts)
        odd = np.array([x is None for x in ids], bool)
        size = np.array([len(x) // 4 if x else 0 for x in ids], np.int64)
        joined, starts = np.frombuffer(b"".join([x or b"" for x in ids]), "<u4"), np.cumsum(size) - size
        length = size[rest]
        ends = np.concatenate(([0], np.cumsum(length)))
        tokens = joined[np.repeat(starts[rest] - ends[:-1], length) + np.arange(ends[-1])]
        n_odd = np.concatenate(([0], np.cumsum(odd[rest]))) if len(rest) else np.zeros(1, np.int64)
        alone = np.diff(cuts) == 0
        # the first part has to end in no white space, unless it is the whole text
        bad_end = np.array([not parts[i] or parts[i][-1].isspace() for i in first.tolist()], bool)
        whole = ~alone & (bad_end | (n_odd[cuts[1:]] > n_odd[cuts[:-1]]))
        out: list[bytes] = self._whole([texts[i] if whole[i] else parts[first[i]] for i in range(n)])
        bounds = ends[cuts]
        for i in np.flatnonzero(~whole & ~alone).tolist():
            out[i] += tokens[bounds[i]:bounds[i + 1]].tobytes()
        return out


_ENCODERS: dict[str, LibraryEncoder] = {}


def encoder(path: str) -> LibraryEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = LibraryEncoder(path)
    return _ENCODERS[path]


# ---- tables to files and back ---------------------------------------------------
MANIFEST = "part int, number int, path string, n_docs long, n_tokens long"


def write_token_files(docs: DataFrame, tokenizer: str, out_dir: str, end_id: int = END_ID, file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Write ``docs(doc_id, text)`` in ascending ``doc_id`` order; returns the table of files
    with ``start``, the tokens before each file."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, writer, path = TaskContext.get().partitionId(), 0, None, ""
        attempt = TaskContext.get().taskAttemptId()
        enc = encoder(tokenizer)

        def row() -> pa.RecordBatch:
            writer.close()
            return pa.RecordBatch.from_pylist([{"part": part, "number": number, "path": path, "n_docs": len(writer.doc_ids), "n_tokens": writer.n_tokens}],
                                              pa.schema([("part", pa.int32()), ("number", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))

        for b in batches:
            for at in range(0, b.num_rows, _TEXTS):
                ids = b.column(0).slice(at, _TEXTS).to_pylist()
                for i, raw in zip(ids, enc.encode([t or "" for t in b.column(1).slice(at, _TEXTS).to_pylist()])):
                    if writer is None:
                        path = f"{out_dir}/part-{part:06d}-{number:04d}-{attempt}.tok"
                        writer = TokenFileWriter(path)
                    writer.add(i, np.frombuffer(raw + end, "<u4"))
                    if writer.n_tokens >= file_tokens:
                        yield row()
                        writer, number = None, number + 1
        if writer is not None:
            yield row()

    ordered = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    manifest = stored(ordered.mapInArrow(run, MANIFEST), "token-files")
    before = W.orderBy("part", "number").rowsBetween(W.unboundedPreceding, -1)  # one row a file
    return stored(manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))), "token-starts")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, decoded from the files."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "n_tokens", "ids_crc32"]
        for b in batches:
            for path, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                f, rows = TokenFile(path), []
                for doc_id, at, ids in f.documents():
                    rows.append((doc_id, start + at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    if len(rows) == 4096:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)
                        rows = []
                f.close()
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)

    files = max(1, manifest.count())
    return manifest.select("path", "start").repartition(files).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_file_report(docs: DataFrame, tokenizer: str) -> DataFrame:
    return read_token_files(write_token_files(docs, tokenizer, scratch_path(docs.sparkSession, "token-data")))
