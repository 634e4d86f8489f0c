"""Token counts from flat, unindexed token files by a separator scan.

A flat file is nothing but token ids, 2 or 4 little-endian bytes each, with an end-of-document
id after each document. The scan cuts every file into blocks of ``BLOCK_TOKENS`` ids at fixed
offsets and deals the blocks to tasks. A task searches its block for the end id in one
vector comparison and emits one row for each hit: the first hit of a block does not know where
its document began, all others do (after the hit before). A summary of each block (hits, place
of its last hit) goes through a prefix scan over the file's blocks, which gives each
block the place after the last end before it and the number of ends before it; that
stitches documents that cross blocks, however many blocks they cross. Ids after a file's last end
are an unfinished document.

The scan reads each file once, shuffles one summary a block and the rows of first hits only;
a block's rows are found by the scan itself, so no index is made or read.

The query writes ``documents`` as such files first (tiktoken ids of whole texts, 2 bytes each
where the vocabulary allows) and returns what the scan finds, with the ``doc_id`` that the
writing task put at that place of that file.

Defined cases: a NULL text counts as empty, a document of no token; files that are empty or have no
end id; an end id as the first id (an empty document); ids may repeat or be NULL; an
empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import stored
from .files import NewFile, open_file

BLOCK_TOKENS, FILE_TOKENS = 1 << 20, 1 << 23

_FOUND = "file string, block long, place long, start long, stop long"


def scan_block(ids: np.ndarray, offset: int, separator: int) -> tuple[np.ndarray, np.ndarray]:
    """For each end in a block its place in the file, and its document's first token (-1 for
    the first end, whose document may have begun before the block)."""
    stops = np.flatnonzero(ids == separator) + offset
    starts = np.concatenate((np.array([-1], np.int64), stops[:-1] + 1)) if len(stops) else stops
    return starts, stops


def scan_files(files: DataFrame, separator: int, width: int, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``file, ordinal, start, n_tokens, finished`` of every document in ``files(file, n_bytes)``.

    ``n_tokens`` does not count the end id. ``width`` is the bytes of an id, 2 or 4.
    """
    if width not in (2, 4):
        raise ValueError("ids have 2 or 4 bytes")
    kind, size = ("<u2" if width == 2 else "<u4"), block_tokens * width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["file", "block", "place", "start", "stop"]
        for b in batches:
            for path, block in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                f = open_file(path)
                f.seek(block * size)
                raw = f.read(size)
                f.close()
                ids = np.frombuffer(raw, kind, len(raw) // width)
                starts, stops = scan_block(ids, block * block_tokens, separator)
                n = len(stops)
                # the last row is the block's summary: its number of ends, and where its ids stop
                yield pa.RecordBatch.from_arrays([
                    pa.array([path] * (n + 1)), pa.array(np.full(n + 1, block)), pa.array([*range(n), -1 - n], pa.int64()),
                    pa.array(np.append(starts, stops[-1] + 1 if n else -1)), pa.array(np.append(stops, block * block_tokens + len(ids))),
                ], names=names)

    blocks = files.select("file", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(F.col("n_bytes") / size) - 1, F.lit(0)).cast("long"))).alias("block"))
    blocks = stored(blocks, "separator-blocks")
    found = stored(blocks.repartition(max(1, blocks.count())).mapInArrow(run, _FOUND), "separator-found")
    earlier = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    # prefix scan: where the open document began, and how many ended, before each block
    carried = found.where("place < 0").select(
        "file", "block", "stop", F.when(F.col("start") >= 0, F.col("start")).alias("after"), (-1 - F.col("place")).alias("ends")).select(
        "file", "block", "stop", "after", "ends",
        F.coalesce(F.max("after").over(earlier), F.lit(0)).alias("open"), F.coalesce(F.sum("ends").over(earlier), F.lit(0)).alias("ended"))
    carried = stored(carried, "separator-carried")
    inside = found.where("place >= 0").join(carried.select("file", "block", "open", "ended"), ["file", "block"])
    whole = inside.select("file", (F.col("ended") + F.col("place")).alias("ordinal"),
                          F.when(F.col("start") < 0, F.col("open")).otherwise(F.col("start")).alias("start"), "stop")
    rest = carried.groupBy("file").agg(F.sum("ends").alias("ordinal"), F.coalesce(F.max("after"), F.lit(0)).alias("start"), F.max("stop").alias("stop")).where("stop > start")
    out = whole.withColumn("finished", F.lit(True)).unionByName(rest.withColumn("finished", F.lit(False)))
    return out.select("file", "ordinal", "start", (F.col("stop") - F.col("start")).alias("n_tokens"), "finished")


_LIBRARY: dict[tuple, object] = {}


def library(path: str, pattern: str):
    """The tiktoken encoder of a rank file, one per worker."""
    if (path, pattern) not in _LIBRARY:
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _LIBRARY[path, pattern] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), len(ranks)
    return _LIBRARY[path, pattern]


def write_flat(docs: DataFrame, path: str, pattern: str, out_dir: str, width: int, file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Write the texts as flat files, each followed by the id after the vocabulary's last;
    returns ``file, ordinal, doc_id, n_bytes`` (one row a document, ``n_bytes`` that of the file)."""
    kind = "<u2" if width == 2 else "<u4"
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, number, out, ids = TaskContext.get(), 0, None, []
        enc, separator = library(path, pattern)
        end = np.array([separator], kind).tobytes()

        def rows(doc_type) -> pa.RecordBatch:
            out.close()
            n = len(ids)
            return pa.RecordBatch.from_arrays([pa.array([name] * n), pa.array(range(n), pa.int64()), pa.array(ids, doc_type), pa.array([out.size] * n, pa.int64())],
                                              names=["file", "ordinal", "doc_id", "n_bytes"])

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if out is None:
                    name = f"{out_dir}/part-{context.partitionId():06d}-{number:04d}-{context.taskAttemptId()}.bin"
                    out, ids = NewFile(name), []
                out.write(np.array(enc.encode_ordinary(text or ""), kind).tobytes() + end)
                ids.append(doc_id)
                if out.size >= file_tokens * width:
                    yield rows(b.column(0).type)
                    out, number = None, number + 1
            doc_type = b.column(0).type
        if out is not None:
            yield rows(doc_type)

    return stored(docs.select("doc_id", "text").mapInArrow(run, f"file string, ordinal long, doc_id {id_type}, n_bytes long"), "flat-documents")


def token_count_report(docs: DataFrame, path: str, pattern: str, width: int = 2, file_tokens: int = FILE_TOKENS, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``doc_id, file_ordinal, start, n_tokens`` of every document, found by the scan."""
    separator = sum(1 for _ in open(path, "rb"))  # the first free id of the public rank file
    if separator >= 1 << (8 * width):
        raise ValueError("ids do not fit their width")
    placed = write_flat(docs, path, pattern, scratch_path(docs.sparkSession, "flat-data"), width, file_tokens)
    files = placed.groupBy("file").agg(F.max("n_bytes").alias("n_bytes"))
    found = scan_files(files, separator, width, block_tokens)
    return found.join(placed.select("file", "ordinal", "doc_id"), ["file", "ordinal"]).select(
        "doc_id", F.col("ordinal").alias("file_ordinal"), F.col("start").alias("file_start"), "n_tokens")
