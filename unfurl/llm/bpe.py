"""Byte-level BPE by monoid tree reduction.

Two levels, both built from the same step, encode the halves and join them:

* A text splits into matches of the vocabulary's pattern. A long text is halved at
  any character; of the left half's matches those that end at least ``LOOK``
  characters before the cut cannot change (the pattern looks ahead no further), so
  the join scans on from the first that may, match by match into the right half,
  until it stops where a match of the right half starts. From there on the
  right half's matches stand, because a match depends on what follows only.
* A match's bytes are merged pair by pair, lowest rank first, leftmost of equals. A
  long match is halved at any byte. The join re-encodes a window of ``k`` tokens on
  either side of the cut, with ``k`` growing until the window's outer tokens are
  stable with their outer neighbours: a sequence of tokens is the encoding of its
  bytes exactly if each neighbouring pair is the encoding of that pair's bytes (the
  first merge across a boundary would also be made in the pair alone). So tokens
  outside the window provably stay.

Decoding joins the tokens' bytes up the tree.

Spark reads and deals the rows; a task keeps the tokens of short matches it has seen in a
dictionary of bounded size (entries and length of each), which changes no result. Texts of any length take memory
in proportion to the text; work is linear in its length times the tree's depth at the
cuts only.

Defined cases: a NULL text counts as empty, which has no token; an empty table gives an
empty result; repeated rows are encoded alike; further columns pass through.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes up to which a match is merged directly, characters up to which a text is split directly.
LEAF_BYTES, LEAF_CHARS = 32, 1 << 15
#: Characters beyond its end that may decide a match: the longest contraction has three.
LOOK = 4
#: Matches whose tokens a task remembers, and the characters of the longest that it does: some 100 MB of Python objects at most.
REMEMBERED, LONGEST = 250_000, 64


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Codec:
    """Encoder and decoder for one rank file and split pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, remembered: int = REMEMBERED, leaf_bytes: int = LEAF_BYTES, leaf_chars: int = LEAF_CHARS):
        self.ranks, self.split = ranks, regex.compile(pattern)
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.remembered, self.leaf_bytes, self.leaf_chars = remembered, leaf_bytes, leaf_chars
        self.known: dict[str, tuple[int, ...]] = {}
        self.pairs: dict[tuple[int, int], bool] = {}

    # ---- bytes of one match -------------------------------------------------
    def merge(self, piece: bytes) -> list[int]:
        """Direct merging: lowest rank first, leftmost of equals."""
        ranks = self.ranks
        if len(piece) > 2 * self.leaf_bytes:
            return self.merge_window(piece)
        parts = [piece[i:i + 1] for i in range(len(piece))]
        scores = [ranks.get(parts[i] + parts[i + 1]) for i in range(len(parts) - 1)]
        while True:
            best, at = None, -1
            for i, s in enumerate(scores):
                if s is not None and (best is None or s < best):
                    best, at = s, i
            if best is None:
                return [ranks[p] for p in parts]
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del scores[at]
            if at:
                scores[at - 1] = ranks.get(parts[at - 1] + parts[at])
            if at < len(scores):
                scores[at] = ranks.get(parts[at] + parts[at + 1])

    def merge_window(self, piece: bytes) -> list[int]:
        """The same for a window that had to grow long: a heap of pairs over a linked list."""
        ranks, n = self.ranks, len(piece)
        end, after, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = after[i] if end[i] else n
            if j >= n or end[j] != stop:  # one of the two has changed since
                continue
            end[i], after[i], end[j] = stop, after[j], 0
            if after[i] < n:
                before[after[i]] = i
                nxt = end[after[i]]
                if (r := ranks.get(piece[i:nxt])) is not None:
                    heapq.heappush(heap, (r, i, nxt))
            if before[i] >= 0 and (r := ranks.get(piece[before[i]:stop])) is not None:
                heapq.heappush(heap, (r, before[i], stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i:end[i]]])
            i = after[i]
        return out

    def stable(self, left: int, right: int) -> bool:
        """Whether two neighbouring tokens are the encoding of their bytes."""
        key = (left, right)
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= self.remembered:
                self.pairs.clear()
            known = self.pairs[key] = self.merge(self.bytes_of[left] + self.bytes_of[right]) == [left, right]
        return known

    def join(self, a: list[int], b: list[int]) -> list[int]:
        """The encoding of the bytes of ``a`` and ``b``, themselves encodings."""
        if not a or not b or self.stable(a[-1], b[0]):
            return a + b
        k = 1
        while True:
            i, j = max(0, len(a) - k), min(len(b), k)
            window = b"".join(map(self.bytes_of.__getitem__, a[i:] + b[:j]))
            new = self.merge(window)
            if (i == 0 or self.stable(a[i - 1], new[0])) and (j == len(b) or self.stable(new[-1], b[j])):
                return a[:i] + new + b[j:]
            k *= 2

    def tokens(self, piece: bytes) -> list[int]:
        """The encoding of some bytes, by halves."""
        if len(piece) <= self.leaf_bytes:
            return self.merge(piece)
        size = self.leaf_bytes
        level = [self.merge(piece[i:i + size]) for i in range(0, len(piece), size)]
        while len(level) > 1:  # neighbours join, level by level, up to the root
            level = [self.join(*level[i:i + 2]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
        return level[0]

    def match_tokens(self, match: str) -> tuple[int, ...]:
        got = self.known.get(match)
        if got is None:
            piece = match.encode("utf-8", "surrogatepass")
            whole = self.ranks.get(piece)
            got = (whole,) if whole is not None else tuple(self.tokens(piece))
            if len(match) <= LONGEST:
                if len(self.known) >= self.remembered:
                    self.known.clear()
                self.known[match] = got
        return got

    # ---- matches of one text ------------------------------------------------
    def matches(self, text: str) -> list[str]:
        if len(text) <= self.leaf_chars:
            return self.split.findall(text)
        half = len(text) // 2
        return self.join_matches(text, half, self.matches(text[:half]), self.matches(text[half:]))

    def join_matches(self, text: str, half: int, left: list[str], right: list[str]) -> list[str]:
        """The matches of ``text`` from those of ``text[:half]`` and ``text[half:]``."""
        at = half
        while left and half - at < LOOK:  # these may change
            at -= len(left.pop())
        starts, n = half, 0  # the right half's match n starts here
        for m in self.split.finditer(text, at):  # scans on only as far as the loop asks
            left.append(m.group())
            while n < len(right) and starts < m.end():
                starts += len(right[n])
                n += 1
            if starts == m.end():  # from here on the right half's matches stand
                left += right[n:]
                break
        return left

    # ---- whole texts --------------------------------------------------------
    def encode(self, text: str) -> list[int]:
        known, miss = self.known, self.match_tokens
        out: list[int] = []
        for m in self.matches(text):
            got = known.get(m)
            out += got if got is not None else miss(m)
        return out

    def decode(self, ids: list[int]) -> bytes:
        """The ids' bytes: runs are joined to leaves, leaves up the tree to the text."""
        level = [b"".join(map(self.bytes_of.__getitem__, ids[i:i + 4096])) for i in range(0, len(ids), 4096)]
        while len(level) > 1:
            level = [b"".join(level[i:i + 16]) for i in range(0, len(level), 16)]
        return level[0] if level else b""


_CODECS: dict[tuple, Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """One codec per worker process."""
    key = (path, pattern)
    if key not in _CODECS:
        _CODECS[key] = Codec(read_ranks(path), pattern)
    return _CODECS[key]


def encode_documents(docs: DataFrame, path: str, pattern: str, text: str = "text", keep: tuple[str, ...] | None = None) -> DataFrame:
    """``keep`` (default: all columns) and ``token_ids`` (array of ints) for each row; a column of that name gives way."""
    names = [c for c in (docs.columns if keep is None else keep) if c.lower() != "token_ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                ids = [c.encode(t or "") for t in part.column(len(part.columns) - 1).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(ids, pa.list_(pa.int32()))], names=[*aside, "token_ids"])

    aside = [f"column_{i}" for i in range(len(names))]
    read = docs.select(*[F.col(c).alias(a) for c, a in zip(names, aside)], F.col(text).alias("text"))
    schema = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in read.schema[:-1])
    return read.mapInArrow(run, f"{schema}token_ids array<int>").toDF(*names, "token_ids")


def encode_report(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: texts are encoded, the ids decoded again."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        decimal = {i: str(i) for i in c.bytes_of}
        for b in batches:
            n, ids_hash, text_hash = [], [], []
            for t in b.column(1).to_pylist():
                ids = c.encode(t or "")
                n.append(len(ids))
                ids_hash.append(hashlib.sha256(" ".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                text_hash.append(hashlib.sha256(c.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())],
                                             names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string")
