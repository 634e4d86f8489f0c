"""SimHash near-duplicate groups: byte-position inverted index with count filtering.

Fingerprint: the text's A-Z are lower-cased, its words ``[^\\x20\\x09-\\x0D]+`` form
shingles of ``SHINGLE`` words, repeats included (fewer words: the whole sequence;
none: fingerprint zero). Each shingle's XXH64 (seed 42) votes on 64 bits; a bit is
1 if set in over half of the hashes. Two fingerprints link if they differ in at
most ``DISTANCE`` bits; a component is whatever is reachable over links.

Two fingerprints with at most 4 differing bits differ in at most 4 of their 8
bytes, so they share at least 4 bytes at the same positions: that is the count a
pair must reach. The index therefore holds every fingerprint under each of the 70
sets of 4 byte positions with the bytes at those positions (for another distance:
the sets of ``8 - DISTANCE`` positions). A pair that shares more positions would
meet under several sets; it is taken up under the first one only, where its
positional matches are counted from the whole fingerprints, and then verified by
its differing bits. All of that is part of the join's condition, so only links
leave the join.

Scale: fingerprints are made distinct first (exact copies collapse to one row);
an index row is two longs and a byte, 70 a fingerprint, shuffled once to count each
list (rows stream through a window; a list holds different values of 32 bits, so near
copies of one text, however many, fill it with few). Only members of lists of two or more
are kept. Lists of up to ``PAIR_LIST`` members are compared inside. Longer lists have an exact way without pairs: two
fingerprints within 4 bits of each other have a common neighbour within 2 bits of
both, so every member files itself under its own value and all values up to two
flips away (2,081 rows), and whoever meets under a value is linked to its smallest
member. Work is linear in the members, however many there are.

Defined cases: a NULL text counts as empty; repeated rows and equal ids belong to
one component; a NULL id never becomes a component's id unless the component has
no other; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import LOWER_AZ, connected_components, stored, with_columns_aside

SHINGLE, DISTANCE, SEED = 4, 4, 42
#: Lists of more members are linked without pairs. A comparison inside a join costs a
#: small part of a shuffled row, so comparing with 512 is cheaper than 2,081 rows.
PAIR_LIST = 512


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of one text, as an unsigned number."""
    w = (text or "").encode("utf-8", "surrogatepass").translate(LOWER_AZ).split()
    if not w:
        return 0
    joined = b" ".join(w)
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(w))
    digest = xxhash.xxh64_intdigest
    votes, n = np.zeros(64, np.int64), len(w) - k + 1
    for at in range(0, n, 1 << 16):  # a very long text votes in parts
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[at:min(n, at + (1 << 16))].tolist(), ends[at + k - 1:min(n, at + (1 << 16)) + k - 1].tolist())], np.uint64)
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(votes * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, text_hash, fp)``, ``fp`` as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t, shingle) for t in b.column(2).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps)], names=["doc_id", "text_hash", "fp"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.xxhash64("text").alias("h"), "text").mapInArrow(run, f"doc_id {id_type}, text_hash long, fp long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def position_masks(distance: int = DISTANCE) -> list[int]:
    """One mask for each set of byte positions that a link may be found under."""
    if not 0 <= distance < 8:
        raise ValueError("the byte index needs a distance of 0 to 7 bits")
    return [_signed(sum(0xFF << (8 * i) for i in s)) for s in combinations(range(8), 8 - distance)]


def _first_shared(a: Column, b: Column, distance: int) -> Column:
    """Mask of the first ``8 - distance`` byte positions at which ``a`` and ``b`` agree,
    and thereby the test that there are as many (else the mask is smaller)."""
    x = a.bitwiseXOR(b)
    count, mask = F.lit(0), F.lit(0).cast("long")
    for i in range(8):
        m = _signed(0xFF << (8 * i))
        take = (x.bitwiseAND(F.lit(m)) == 0) & (count < 8 - distance)
        mask = mask + F.when(take, F.lit(m).cast("long")).otherwise(F.lit(0).cast("long"))
        count = count + F.when(take, 1).otherwise(0)
    return mask


def links(distinct: DataFrame, distance: int = DISTANCE, pair_list: int = PAIR_LIST) -> DataFrame:
    """``(a, b)`` over the distinct ``fp`` of ``distinct``: links, or chains of links, such
    that exactly the fingerprints that links connect are connected."""
    masks = position_masks(distance)
    index = distinct.select("fp", F.posexplode(F.array(*[F.lit(m) for m in masks])).alias("j", "m")).select(
        F.col("j").cast("byte").alias("j"), F.col("fp").bitwiseAND(F.col("m")).alias("key"), "fp")
    members = index.withColumn("n", F.count("*").over(W.partitionBy("j", "key")))
    members = stored(members.where("n > 1"), "simhash-members")

    short = members.where(F.col("n") <= pair_list)
    mask_of = F.element_at(F.array(*[F.lit(m) for m in masks]), F.col("l.j").cast("int") + 1)
    pairs = short.alias("l").join(
        short.alias("r"),
        (F.col("l.j") == F.col("r.j")) & (F.col("l.key") == F.col("r.key")) & (F.col("l.fp") < F.col("r.fp"))
        & (F.bit_count(F.col("l.fp").bitwiseXOR(F.col("r.fp"))) <= distance)
        & (_first_shared(F.col("l.fp"), F.col("r.fp"), distance) == mask_of),
    ).select(F.col("l.fp").alias("a"), F.col("r.fp").alias("b"))
    # a pair may have its first shared set in a long list and a later one in a short list: long lists cover it

    met = around(members.where(F.col("n") > pair_list).select("fp").distinct(), distance)
    low = met.groupBy("v", "i").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1").select("v", "i", "a")
    stars = met.join(low, ["v", "i"]).where("a <> fp").select("a", F.col("fp").alias("b"))
    return pairs.unionByName(stars).distinct()


def around(fps: DataFrame, distance: int) -> DataFrame:
    """``(fp, v, i)``: places near each fingerprint such that two share one if and only if
    they are within ``distance``.

    An even distance: all values up to half as many flips away. An odd one: two
    fingerprints within ``2h + 1`` have values within ``h`` flips of each that differ in
    one bit at most, so the places are those values' edges (the value without bit ``i``, ``i``).
    """
    half = distance // 2
    flips = [_signed(sum(1 << i for i in s)) for k in range(half + 1) for s in combinations(range(64), k)]
    out = fps.select("fp", F.explode(F.array(*[F.lit(f) for f in flips])).alias("f")).select("fp", F.col("fp").bitwiseXOR(F.col("f")).alias("v"))
    if distance % 2 == 0:
        return out.withColumn("i", F.lit(0))
    out = out.select("fp", "v", F.explode(F.array(*[F.lit(i) for i in range(64)])).alias("i"))
    return out.select("fp", F.expr("v & ~shiftleft(1L, i)").alias("v"), "i").distinct()


def components(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, pair_list: int = PAIR_LIST) -> DataFrame:
    """``(doc_id, text_hash, fp, root, component_id)``, one row per row of ``docs``;
    ``root`` is one fingerprint of the component."""
    prints = stored(fingerprints(docs, shingle), "simhash-prints")
    classes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-classes")
    joined = connected_components(links(classes.select("fp"), distance, pair_list))
    rooted = classes.join(joined, classes["fp"] == joined["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(lowest, "root").select("fp", "root", "component_id")
    return prints.join(named, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def dedup_report(docs: DataFrame) -> DataFrame:
    return components(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def deduplicated(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One document of each component, that with the smallest id (of equal ids, one text;
    of equal rows, one); columns as in ``docs``."""
    return with_columns_aside(docs, ("doc_id", "text"), lambda d: _deduplicated(d, shingle, distance))


def _deduplicated(docs: DataFrame, shingle: int, distance: int) -> DataFrame:
    each = components(docs, shingle, distance).groupBy("root", "doc_id", "text_hash").agg(F.count("*").alias("rows"))
    first = each.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash", "rows")).alias("x"))
    chosen = stored(first.select(F.col("x.doc_id").alias("__id"), F.col("x.text_hash").alias("__hash"), F.col("x.rows").alias("__rows")), "simhash-chosen")

    def rows_of(these: DataFrame) -> DataFrame:
        return docs.join(these, docs["doc_id"].eqNullSafe(F.col("__id")) & (F.xxhash64(docs["text"]) == F.col("__hash")), "left_semi")

    if chosen.where("__rows > 1").isEmpty():
        return rows_of(chosen)
    return rows_of(chosen.where("__rows = 1")).unionByName(rows_of(chosen.where("__rows > 1")).dropDuplicates(["doc_id", "text"]))
