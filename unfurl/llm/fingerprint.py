"""Document fingerprints by weighted SimHash, and search by permuted block tables.

Fingerprint: a text's terms are its words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; a term
that occurs ``f`` times weighs ``1 + ln f``. Each term's 64-bit hash votes with its weight for
(bit 1) or against (bit 0) each bit; a bit of the fingerprint is 1 if the votes' sum is above 0.
Words are summed in order of their hashes, so equal texts have equal fingerprints. The
likeness of two fingerprints with ``d`` differing bits is ``cos(pi d / 64)``, the cosine of
their texts' weighted terms that SimHash estimates, and 0 where that is negative.

Search: the bits are cut into ``BLOCKS`` blocks. Two fingerprints within ``RADIUS`` bits agree
on at least ``BLOCKS - RADIUS`` blocks, so there is one table for each such set of blocks, in
which the fingerprint stands under these blocks' bits; a pair that agrees on more is taken up
in the first of its tables only, and verified by its differing bits in the join itself. Tables
hold distinct fingerprints, however many documents share them.

The text next to a document's, in descending ``doc_id``, is found without a global order:
ids are cut into ranges by approximate quantiles, ranges are shuffled and sorted, and each
range gets the first row of the next one as its last. The driver sees one id for each range.

Defined cases: a NULL text counts as empty, fingerprint zero; NULL ids come last, equal ids
follow each other by text; a single document is its own next; an empty table gives an
empty result; further columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER_AZ, stored

BLOCKS, RADIUS = 6, 3
#: Rows of the search's queries: ids divisible by this.
QUERY_EVERY = 20
REMEMBERED = 400_000

_HASHES: dict[bytes, int] = {}


def fingerprint(text: str | None) -> int:
    """The 64-bit fingerprint of one text, as an unsigned number."""
    terms = Counter((text or "").encode("utf-8", "surrogatepass").translate(LOWER_AZ).split())
    if not terms:
        return 0
    if len(_HASHES) > REMEMBERED:
        _HASHES.clear()
    hashes = []
    for w in terms:
        h = _HASHES.get(w)
        if h is None:
            h = _HASHES[w] = xxhash.xxh64_intdigest(w)
        hashes.append(h)
    h, f = np.array(hashes, np.uint64), np.fromiter(terms.values(), np.float64, len(terms))
    order = np.argsort(h)
    h, weight, votes = h[order], 1 + np.log(f[order]), np.zeros(64)
    for at in range(0, len(h), 1 << 15):
        bits = np.unpackbits(h[at:at + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += 2 * (weight[at:at + (1 << 15)] @ bits) - weight[at:at + (1 << 15)].sum()
    return int(np.packbits(votes > 0, bitorder="little").view(np.uint64)[0])


def likeness(a: int, b: int) -> float:
    return 1.0 if a == b else max(0.0, math.cos(math.pi * (a ^ b).bit_count() / 64))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


# ---- neighbours in order --------------------------------------------------------
def with_next(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Rows of ranges in order: ``range, doc_id, text, last``; rows with ``last`` are copies
    of the row that follows the range."""
    spark = docs.sparkSession
    ranges = ranges or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    cuts = ids.agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], 100 * ranges).alias("q")).collect()[0].q or []
    cuts = np.unique(np.array(cuts, np.int64))

    @F.pandas_udf("int")
    def range_of(doc_id: pd.Series) -> pd.Series:
        known = doc_id.notna()
        return pd.Series(np.where(known, 1 + np.searchsorted(cuts, doc_id.fillna(0).astype(np.int64), side="right"), 0).astype(np.int32))

    ranged = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    firsts = ids.select("doc_id", range_of("doc_id").alias("range")).groupBy("range").agg(F.max("doc_id").alias("doc_id")).collect()  # one id a range
    firsts.sort(key=lambda r: -r.range)
    ends = [(firsts[i].doc_id, firsts[i - 1].range) for i in range(len(firsts))]  # whose end the row is; the first ends the last
    heads = spark.createDataFrame(ends, "head long, range int")
    copies = ranged.join(F.broadcast(heads), F.col("doc_id").eqNullSafe(F.col("head"))).groupBy("range", "doc_id").agg(F.max("text").alias("text"))
    own = ranged.select(range_of("doc_id").alias("range"), "doc_id", "text", F.lit(False).alias("last"))
    return own.unionByName(copies.withColumn("last", F.lit(True))).repartition("range").sortWithinPartitions(
        "range", "last", F.col("doc_id").desc_nulls_last(), F.col("text").desc())


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by the start of the following text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def compare_neighbours(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fp, edited_fp, near_edited, near_next``; fingerprints as signed longs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        names = ["doc_id", "n_chars", "edited_sha256", "fp", "edited_fp", "near_edited", "near_next"]
        before, rows = None, []
        for b in batches:
            for at in range(0, b.num_rows, 256):
                for where, doc_id, text, last in zip(*(c.slice(at, 256).to_pylist() for c in b.columns)):
                    fp = fingerprint(text)
                    if before is not None and before[0] == where:
                        _, own_id, own, own_fp = before
                        e = edited(own, text)
                        e_fp = fingerprint(e)
                        rows.append((own_id, len(own), hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest(), _signed(own_fp), _signed(e_fp),
                                     likeness(own_fp, e_fp), likeness(own_fp, fp)))
                    before = None if last else (where, doc_id, text, fp)
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                    rows = []

    return with_next(docs, ranges).mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fp long, edited_fp long, near_edited double, near_next double")


# ---- search ---------------------------------------------------------------------
def block_masks(blocks: int = BLOCKS, radius: int = RADIUS) -> list[int]:
    """One mask for each table: ``blocks - radius`` of the blocks of 64 bits."""
    if not 0 <= radius < blocks <= 64:
        raise ValueError("there must be more blocks than differing bits")
    edges = [64 * i // blocks for i in range(blocks + 1)]
    block = [sum(1 << b for b in range(edges[i], edges[i + 1])) for i in range(blocks)]
    return [sum(block[i] for i in s) for s in combinations(range(blocks), blocks - radius)]


def within(queries: DataFrame, prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """``(query, fp)``: for each distinct ``fp`` of ``queries`` every distinct ``fp`` of ``prints``
    within ``radius`` differing bits, itself included."""
    masks = block_masks(blocks, radius)
    whole = F.array(*[F.lit(_signed(m)) for m in masks])

    def tables(x: DataFrame, name: str) -> DataFrame:
        return x.select(F.col("fp").alias(name), F.posexplode(whole).alias("j", "m")).select(
            F.col("j").cast("byte").alias("j"), F.col(name).bitwiseAND(F.col("m")).alias("key"), name)

    def first_table(a: Column, b: Column) -> Column:
        x = a.bitwiseXOR(b)
        return F.coalesce(*[F.when(x.bitwiseAND(F.lit(_signed(m))) == 0, F.lit(i)) for i, m in enumerate(masks)]).cast("byte")

    q, p = tables(queries.select("fp").distinct(), "query"), tables(prints.select("fp").distinct(), "fp")
    # sort-merge: Spark estimates a table of 20 rows a fingerprint by the fingerprints alone, and would broadcast it
    return q.join(p.hint("merge"), (q["j"] == p["j"]) & (q["key"] == p["key"])
                  & (F.bit_count(F.col("query").bitwiseXOR(F.col("fp"))) <= radius)
                  & (first_table(F.col("query"), F.col("fp")) == p["j"])).select("query", "fp")


def _hex(c: str) -> Column:
    return F.lpad(F.lower(F.hex(c)), 16, "0")


def fingerprint_report(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row per document; ``n_within`` is, for ids divisible by ``QUERY_EVERY``, how many other
    documents have a fingerprint within ``radius`` bits (NULL for the others)."""
    found = stored(compare_neighbours(docs), "fingerprints")
    classes = stored(found.groupBy("fp").agg(F.count("*").alias("n"), F.max(F.col("doc_id") % QUERY_EVERY == 0).alias("asked")), "fingerprint-classes")
    near = within(classes.where("asked"), classes, radius).join(classes.select("fp", "n"), "fp").groupBy("query").agg(F.sum("n").alias("near"))
    asked = F.coalesce(F.col("doc_id") % QUERY_EVERY == 0, F.lit(False))
    return found.join(near, found["fp"] == near["query"], "left").select(
        "doc_id", "n_chars", "edited_sha256", _hex("fp").alias("fingerprint"), _hex("edited_fp").alias("edited_fingerprint"),
        "near_edited", "near_next", F.when(asked, F.col("near") - 1).alias("n_within"))
