"""Near-duplicate embeddings by cross-polytope hashing.

A vector is padded to a power of two, multiplied with random signs and rotated by the fast
Hadamard transform, three times; its hash is the axis it then lies closest to, with the
sign (the nearest vertex of the cross-polytope). ``hashes`` such values make a
bucket of one table, and ``tables`` tables are independent. Multiprobe: a vector also looks into
the ``PROBES - 1`` buckets it misses by least. Two vectors meet where one lies in a bucket
that the other lies in or looks into; every such pair is verified by its cosine in double
precision, so no link below the threshold is ever made.

How many hashes: so many that a bucket of unrelated vectors has about ``BUCKET`` members at the
size of the largest label. How many tables: the least for which ``RECALL`` of random pairs at
exactly the threshold meet, found by hashing such pairs with fixed seeds; closer pairs meet more often.

Scale: equal vectors of a label are one class with a count, from an aggregate, so copies cost
one row. Buckets above ``BLOCK`` rows are cut into blocks that meet in cells of two blocks,
each a group of its own, so a task holds two blocks at most, however large the bucket. In a cell
pairs are compared by a matrix product and never leave it: it returns each class's
number of links and a spanning tree of them. A pair that meets more than once is counted where
it meets first, which both sides' bucket numbers tell. Rows shuffled: ``tables * PROBES`` a class.

Defined cases: vectors that are NULL, empty, zero or hold NULL or a non-finite component, or have a
NULL label, link with nothing; neither do vectors of different length. Rows with
equal ids are vectors of their own. A NULL id is a component's id only if it has no other.
An empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, stored

THRESHOLD = 0.93
BUCKET, PROBES, RECALL, BLOCK = 128, 2, 0.995, 512
_KEY = ["label", "dim", "t", "code", "bi", "bj"]


# ---- hashing ------------------------------------------------------------------
def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Hadamard transform of each row; the length is a power of two."""
    n, d = x.shape
    h = 1
    while h < d:
        pairs = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x


def _vertices(x: np.ndarray, t: int, k: int, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``keep`` nearest vertices of each row after hash ``k`` of table ``t``'s rotation, and how far along them it lies."""
    signs = np.random.default_rng([x.shape[1], t, k]).integers(0, 2, (3, x.shape[1])) * 2.0 - 1
    for s in signs:
        x = hadamard(x * s)
    near = np.argsort(-np.abs(x), axis=1, kind="stable")[:, :keep]
    along = np.take_along_axis(x, near, 1)
    return near * 2 + (along < 0), np.abs(along)


def codes(vectors: np.ndarray, hashes: int, tables: int, probes: int = PROBES) -> np.ndarray:
    """Bucket numbers ``[row, table, probe]``; probe 0 is the bucket a vector lies in, the others
    change the one vertex whose change loses least, then the next."""
    n, d = vectors.shape
    size = max(2, 1 << (d - 1).bit_length())
    x = np.zeros((n, size))
    x[:, :d] = vectors / np.abs(vectors).max(axis=1, keepdims=True, initial=0)  # only the direction matters
    keep = min(probes, size)
    out = np.full((n, tables, probes), -1, np.int64)
    for t in range(tables):
        got = [_vertices(x, t, k, keep) for k in range(hashes)]
        place = [(2 * size) ** k for k in range(hashes)]
        main = sum(v[:, 0] * p for (v, _), p in zip(got, place))
        out[:, t, 0] = main
        changed = np.stack([main + (v[:, j] - v[:, 0]) * p for (v, _), p in zip(got, place) for j in range(1, keep)], axis=1) if keep > 1 else np.empty((n, 0), np.int64)
        loss = np.stack([a[:, 0] - a[:, j] for _, a in got for j in range(1, keep)], axis=1) if keep > 1 else np.empty((n, 0))
        best = np.argsort(loss, axis=1, kind="stable")[:, :probes - 1]
        out[:, t, 1:1 + best.shape[1]] = np.take_along_axis(changed, best, 1)
    return out


def meetings(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of rows of bucket numbers, the tables in which they meet: ``[row, table]``."""
    return (a == b[:, :, :1]).any(2) | (b == a[:, :, :1]).any(2)


@lru_cache(None)
def tables_for(dim: int, threshold: float, hashes: int, probes: int = PROBES, recall: float = RECALL) -> int:
    """The least number of tables in which ``recall`` of pairs at the threshold meet."""
    rng = np.random.default_rng(dim)
    a, g = rng.standard_normal((2, 2000, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    g -= (g * a).sum(1, keepdims=True) * a
    b = threshold * a + math.sqrt(1 - threshold ** 2) * g / np.maximum(np.linalg.norm(g, axis=1, keepdims=True), 1e-300)
    met, tables = np.zeros(2000, bool), 0
    while met.mean() < recall:
        tables += 1
        met |= meetings(codes(a, hashes, tables, probes)[:, -1:], codes(b, hashes, tables, probes)[:, -1:])[:, 0]
    return tables


def hashes_for(dim: int, members: int, bucket: int = BUCKET) -> int:
    """So many hashes that ``members`` unrelated vectors fill buckets with about ``bucket``."""
    size, k = 2 * max(2, 1 << (dim - 1).bit_length()), 1
    while members > bucket * size ** k and size ** (k + 1) < 1 << 62:
        k += 1
    return k


# ---- links in a cell ------------------------------------------------------------
def roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest node that each of ``n`` nodes reaches over the links ``a, b``."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def cell_links(x: np.ndarray, c: np.ndarray, t: int, code: int, all_codes: np.ndarray, first: np.ndarray, second: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows ``first x second`` (``first`` being ``second``: within) that link, and are to be counted here."""
    same = first is second
    s = x[first] @ x[second].T
    i, j = np.nonzero(s >= threshold - 1e-9)
    if same:
        i, j = i[i < j], j[i < j]
    i, j = first[i], second[j]
    exact = (np.abs(np.einsum("ij,ij->i", x[i], x[j]) - threshold) < 1e-8).nonzero()[0]
    ok = np.ones(len(i), bool)
    for p in exact:  # decided by an exactly rounded sum
        ok[p] = math.fsum((x[i[p]] * x[j[p]]).tolist()) >= threshold
    i, j = i[ok], j[ok]
    i, j = np.where(c[i] < c[j], i, j), np.where(c[i] < c[j], j, i)  # each pair in one direction
    a, b = all_codes[i], all_codes[j]
    here = meetings(a, b)
    a, b, none_before = a[:, t], b[:, t], here.argmax(1) == t
    both = a[:, 0] == b[:, 0]
    a_looks = (a == b[:, :1]).any(1)
    place = np.where(both | a_looks, b[:, 0], a[:, 0])  # the bucket they count in, of those where they meet in this table
    ok = here.any(1) & none_before & (place == code) & (c[i] != c[j])
    return i[ok], j[ok]


OUT = pa.schema([("c", pa.int64()), ("other", pa.int64()), ("n", pa.int64())])


def _cell(rows: pa.Table, threshold: float) -> pa.RecordBatch | None:
    """Number of links (``other`` NULL) and spanning links (``n`` 0) of a cell."""
    dim, t, code = rows["dim"][0].as_py(), rows["t"][0].as_py(), rows["code"][0].as_py()
    lies = rows["probe"].to_numpy() == 0
    if not lies.any() or rows.num_rows < 2:
        return None
    c, m, side = rows["c"].to_numpy(), rows["m"].to_numpy(), rows["side"].to_numpy()
    x = np.frombuffer(b"".join(rows["vec"].to_pylist()), "<f8").reshape(-1, dim)
    all_codes = np.frombuffer(b"".join(rows["codes"].to_pylist()), "<i8").reshape(len(x), -1, PROBES)
    found = []
    if rows["bi"][0].as_py() == rows["bj"][0].as_py():
        main, probing = np.flatnonzero(lies), np.flatnonzero(~lies)
        found.append(cell_links(x, c, t, code, all_codes, main, main, threshold))
        found.append(cell_links(x, c, t, code, all_codes, probing, main, threshold))
    else:
        part = lambda s, k: np.flatnonzero((side == s) & (lies == k))
        for p, q in ((True, True), (True, False), (False, True)):
            found.append(cell_links(x, c, t, code, all_codes, part(0, p), part(1, q), threshold))
    i, j = (np.concatenate(z) for z in zip(*found))
    if not len(i):
        return None
    ids, at = np.unique(c, return_inverse=True)
    weight = np.zeros(len(ids), np.int64)
    weight[at] = m
    i, j = at[i], at[j]
    n = np.zeros(len(ids), np.int64)
    np.add.at(n, i, weight[j])
    np.add.at(n, j, weight[i])
    root = roots(i, j, len(ids))
    has, tied = np.flatnonzero(n), np.flatnonzero(root != np.arange(len(ids)))
    return pa.RecordBatch.from_arrays([
        pa.array(np.concatenate([ids[has], ids[tied]])), pa.array([None] * len(has) + ids[root[tied]].tolist(), pa.int64()),
        pa.array(np.concatenate([n[has], np.zeros(len(tied), np.int64)]))], schema=OUT)


def _cells(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by cell; a cell that goes on in the next batch waits for it."""
        held: list[pa.RecordBatch] = []
        for b in batches:
            rows = pa.Table.from_batches([*held, b]).combine_chunks()
            cols = [rows["label"].combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False), *(rows[k].to_numpy() for k in _KEY[1:])]
            change = np.zeros(rows.num_rows, bool)
            for col in cols:
                change[1:] |= col[1:] != col[:-1]
            starts = [0, *np.flatnonzero(change).tolist()]
            for a, z in zip(starts, starts[1:]):
                if z - a > 1 and (out := _cell(rows.slice(a, z - a), threshold)):
                    yield out
            held = rows.slice(starts[-1]).to_batches() if rows.num_rows else []
        if held and (out := _cell(pa.Table.from_batches(held), threshold)):
            yield out
    return run


# ---- tables ---------------------------------------------------------------------
def _hashed(classes: DataFrame, largest: int, threshold: float, bucket: int = BUCKET) -> DataFrame:
    """Each class under all buckets that it lies in (``probe`` 0) or looks into."""
    schema = "label string, dim int, t int, code long, probe int, c long, m long, vec binary, codes binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                b = whole.slice(at, 2048)
                lists, dims = b.column("embedding"), np.diff(b.column("embedding").offsets.to_numpy())
                for dim in np.unique(dims):
                    own = np.flatnonzero(dims == dim)
                    v = lists.take(pa.array(own)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(own), dim)
                    hashes = hashes_for(int(dim), largest, bucket)
                    tables = tables_for(int(dim), threshold, hashes)
                    every = codes(v, hashes, tables)
                    unit = v / np.abs(v).max(axis=1, keepdims=True)
                    unit /= np.sqrt((unit * unit).sum(1, keepdims=True))
                    n = len(own)
                    row, t, probe = (z.reshape(-1) for z in np.meshgrid(np.arange(n), np.arange(tables), np.arange(PROBES), indexing="ij"))
                    code, kept = every.reshape(-1), every.reshape(-1) >= 0
                    row, t, probe, code = row[kept], t[kept], probe[kept], code[kept]
                    of = lambda name: b.column(name).take(pa.array(own[row]))  # noqa: E731, B023
                    raw = lambda z: pa.array([r.tobytes() for r in z], pa.binary()).take(pa.array(row))  # noqa: E731, B023
                    yield pa.RecordBatch.from_arrays(
                        [of("label"), pa.array(np.full(len(row), dim, np.int32)), pa.array(t.astype(np.int32)), pa.array(code), pa.array(probe.astype(np.int32)), of("c"), of("m"),
                         raw(unit.astype("<f8")), raw(every.astype("<i8"))],
                        names=["label", "dim", "t", "code", "probe", "c", "m", "vec", "codes"])

    return classes.select(F.col("label").cast("string").alias("label"), "c", "m", "embedding").mapInArrow(run, schema)


def classes_of(vectors: DataFrame) -> DataFrame:
    """``label, embedding, first, m, c``: the different usable vectors of each label, the smallest id, their number, and a number of the class."""
    usable = ("label IS NOT NULL AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity')) AND exists(embedding, x -> x <> 0)")
    each = vectors.where(usable).groupBy("label", "embedding").agg(F.min("vec_id").alias("first"), F.count("*").alias("m"))
    return stored(each.withColumn("c", F.monotonically_increasing_id()), "embedding-classes")


def links(classes: DataFrame, threshold: float = THRESHOLD, bucket: int = BUCKET, block: int = BLOCK) -> DataFrame:
    """``c, other, n``: numbers of links by class (``other`` NULL, to be added up), and links that connect what is connected (``n`` 0)."""
    size = classes.groupBy("label", F.size("embedding")).agg(F.count("*").alias("n")).agg(F.max("n")).collect()[0][0] or 0
    hashed = _hashed(classes, size, threshold, bucket)
    key = _KEY[:4]
    keys = stored(hashed.groupBy(*key).agg(F.count("*").alias("rows")).where(F.col("rows") > block), "embedding-full-buckets")  # at most a block-th of the rows
    blocks = F.ceil(F.coalesce("rows", F.lit(1)) / block).cast("int")
    dealt = hashed.join(keys, key, "left").withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("c"), F.col("blocks")).cast("int"))
    cells = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        *key, F.least("own", "with").alias("bi"), F.greatest("own", "with").alias("bj"), (F.col("own") > F.col("with")).cast("int").alias("side"), "probe", "c", "m", "vec", "codes")
    return stored(cells.repartition(*[F.col(k) for k in _KEY]).sortWithinPartitions(*_KEY).mapInArrow(_cells(threshold), "c long, other long, n long"), "embedding-links")


def components(vectors: DataFrame, threshold: float = THRESHOLD, bucket: int = BUCKET, block: int = BLOCK) -> DataFrame:
    """``vec_id, n_links, component_id`` of each row."""
    vectors = vectors.select("vec_id", "label", "embedding")
    classes = classes_of(vectors)
    found = links(classes, threshold, bucket, block)
    joined = connected_components(found.where("other IS NOT NULL").select(F.col("c").alias("a"), F.col("other").alias("b")))
    number = found.groupBy("c").agg(F.sum("n").alias("n"))
    rooted = classes.join(joined, F.col("c") == F.col("node"), "left").withColumn("root", F.coalesce("root", "c"))
    lowest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(lowest, "root").join(number, "c", "left").select(
        "label", "embedding", (F.col("m") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), "component_id")
    rows = vectors.join(stored(named, "embedding-named"), ["label", "embedding"], "left")  # NULL labels and lists find nothing
    return rows.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))


def embedding_report(vectors: DataFrame) -> DataFrame:
    return components(vectors).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
