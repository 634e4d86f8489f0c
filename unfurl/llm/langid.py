"""Language identification: nearest of several centroids per language.

A text becomes a vector of hashed n-grams (1 to ``MAX_N`` bytes of its lower-cased
UTF-8 letters, everything else one space), TF-IDF weighted and of length 1. Each
language has up to ``CLUSTERS`` centroids from spherical k-means, so that one
language may have several kinds of text. A text's language is that of the centroid
with the largest cosine; its score is that cosine. A text is rejected if it has no
letter, or if its distance (1 - cosine) is beyond the limit of its nearest centroid's
language for texts of like length (short texts lie further away): what all but a thousandth
of the language's texts keep from centroids made without them, or ``SLACK`` times what they
keep from its centroids, if that is more. With fewer than ``LEAST_TEXTS`` such texts a
language is held to no less than all languages together are (``limits_of``).

Fitting takes a bounded sample, documented here: of the rows with a known label, for
each language those ``SAMPLE`` with the smallest hash of their text. Vectors and
clusters are made in Spark tasks, one language a group of at most ``SAMPLE`` vectors;
the driver receives ``languages x CLUSTERS`` centroids of ``DIM`` floats and broadcasts
them (``MAX_LANGS`` is checked, so at most 64 MB), and three numbers for each vector. Prediction is one narrow pass over whole
texts.

Defined cases: a NULL text or one without letters is ``und`` with score 0; rows with
no label or no text are not learned from; with nothing to learn from everything is ``und``
and rejected; equal cosines go to the language first by code point; an empty table
gives an empty result; further columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored, with_columns_aside

DIM, MAX_N = 1 << 12, 3
CLUSTERS, ROUNDS, SAMPLE, MAX_LANGS = 4, 12, 1500, 256
#: Slices of a language's hashes that are ranked apart.
SLICES = 1024
#: A text may lie so much further off than the fitted texts of its length.
SLACK = 1.25
#: Parts of a language's texts, each left out of one clustering to set the limits.
FOLDS = 4
#: Fewer texts than these set no limit alone; with fewer in all languages it is ``FEW`` at least. No limit is under ``FLOOR``.
LEAST_TEXTS, FEW, FLOOR = 100, 0.8, 0.05
#: Upper ends of the length classes, in letters and spaces; the last is open.
LENGTHS = (50, 100, 200, 400, 800, 1600)
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")
_NOT_LETTERS = regex.compile(r"[^\p{L}\p{M}]+")
_PRIMES = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


def ngram_counts(text: str | None) -> np.ndarray | None:
    """Counts of the hashed n-grams, or None without a letter."""
    if not text or not _LETTER.search(text):
        return None
    raw = np.frombuffer((" " + _NOT_LETTERS.sub(" ", text.lower()).strip() + " ").encode("utf-8", "surrogatepass"), np.uint8)
    out = np.zeros(DIM, np.float32)
    for at in range(0, len(raw), 1 << 20):  # a very long text is counted in parts
        b = raw[at:at + (1 << 20) + MAX_N - 1].astype(np.uint32)
        own = min(len(raw) - at, 1 << 20)
        h = np.zeros(len(b), np.uint32)
        for n in range(MAX_N):
            h = (h[:len(b) - n] + b[n:] + np.uint32(1)) * _PRIMES[n]
            own_n = min(own, len(h))
            out += np.bincount((h[:own_n] ^ (h[:own_n] >> np.uint32(15))) & np.uint32(DIM - 1), minlength=DIM)
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-12)


def _length_class(counts: np.ndarray) -> np.ndarray:
    """The class of each row of counts by its number of 1-grams."""
    return np.searchsorted(LENGTHS, counts.sum(-1) / MAX_N, side="right")


def _weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return _unit(np.log1p(counts) * idf)


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centroids of unit rows; starts far apart, so it needs no chance."""
    seeds = [int(np.argmax(x @ _unit(x.mean(0))))]
    near = x @ x[seeds[0]]
    for _ in range(min(k, len(x)) - 1):
        seeds.append(int(np.argmin(near)))
        near = np.maximum(near, x @ x[seeds[-1]])
    c = x[seeds]
    for _ in range(rounds):
        own = np.argmax(x @ c.T, axis=1)
        c = np.stack([_unit(x[own == i].mean(0)) if (own == i).any() else c[i] for i in range(len(c))])
    return c


def left_out_distances(x: np.ndarray) -> np.ndarray:
    """Of each unit row the distance to the nearest centroid of the rows in other parts; NaN for a single row."""
    out = np.full(len(x), np.nan)
    part = np.arange(len(x)) % min(FOLDS, len(x))
    for i in range(min(FOLDS, len(x)) if len(x) > 1 else 0):
        out[part == i] = 1 - (x[part == i] @ spherical_kmeans(x[part != i], CLUSTERS).T).max(1)
    return out


def limits_of(groups: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> list[list[float]]:
    """For each language the limits by length class, from its texts' distances left out and fitted, and classes."""
    most = lambda d: float(np.quantile(d, 0.999))
    apart = [~np.isnan(far) for far, _, _ in groups]
    far, cls = (np.concatenate([g[j][a] for g, a in zip(groups, apart)]) for j in (0, 2))

    def of_all(i: int) -> float:  # all languages, with the next classes until the texts are enough
        for wide in range(len(LENGTHS) + 1):
            d = far[abs(cls - i) <= wide]
            if len(d) >= LEAST_TEXTS:
                return most(d)
        return max([FEW, *far])

    shared, out = [of_all(i) for i in range(len(LENGTHS) + 1)], []
    for (left, fitted, own), a in zip(groups, apart):
        limits, worst = [], FLOOR
        for i in range(len(LENGTHS), -1, -1):  # from the longest texts; a shorter class is never held to less
            here = a & (own == i)
            limit = max(most(left[here]), SLACK * most(fitted[here])) if here.any() else FLOOR
            if here.sum() >= LEAST_TEXTS:
                worst = max(worst, limit)
                limits.append(worst)
            else:
                limits.append(max(worst, limit, shared[i]))
        out.append(limits[::-1])
    return out


def smallest(hashes: DataFrame, size: int) -> DataFrame:
    """For each ``lang`` the ``size`` smallest different ``h``: first of each of ``SLICES`` slices of a
    language, so that its rows spread over tasks, then of what these leave, ``SLICES * size`` rows at most."""
    each = hashes.distinct().withColumn("__slice", F.expr(f"pmod(h, {SLICES})"))
    for keys in (["lang", "__slice"], ["lang"]):
        each = each.withColumn("__r", F.row_number().over(W.partitionBy(*keys).orderBy("h"))).where(F.col("__r") <= size).drop("__r")
    return each.select("lang", "h")


def sample_of(labelled: DataFrame, size: int = SAMPLE) -> DataFrame:
    """For each ``lang`` the ``size`` rows with the smallest hash of their text; only the
    hashes are shuffled to find them."""
    known = labelled.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", F.xxhash64("text").alias("h"), "text")
    last = smallest(known.select("lang", "h"), size).groupBy("lang").agg(F.max("h").alias("last"))
    ends = {r.lang: r.last for r in last.limit(MAX_LANGS + 1).collect()}  # one number for each language
    if len(ends) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    small = F.lit(False)
    for lang, h in ends.items():
        small = small | ((F.col("lang") == lang) & (F.col("h") <= h))
    return known.where(small)


def fit(labelled: DataFrame, size: int = SAMPLE) -> dict:
    """A model from rows with ``lang`` and ``text``."""
    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lang, h, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                c = ngram_counts(text)
                if c is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([h], pa.int64()), pa.array([c.tobytes()], pa.binary())], names=["lang", "h", "counts"])

    rows = stored(sample_of(labelled, size).mapInArrow(vectors, "lang string, h long, counts binary").dropDuplicates(["lang", "h"]), "langid-sample")

    def frequencies(lang_rows: pd.DataFrame) -> pd.DataFrame:
        seen = np.zeros(DIM, np.int64)
        for c in lang_rows["counts"]:
            seen += np.frombuffer(c, np.float32) > 0
        return pd.DataFrame({"n": [len(lang_rows)], "seen": [seen.tolist()]})

    freq = rows.groupBy("lang").applyInPandas(frequencies, "n long, seen array<long>").limit(MAX_LANGS + 1).collect()
    if len(freq) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    if not freq:
        return {"langs": [], "idf": np.zeros(DIM, np.float32), "centroids": np.zeros((0, DIM), np.float32), "limits": np.zeros((0, len(LENGTHS) + 1))}
    n = sum(r.n for r in freq)
    idf = np.log((n + 1) / (np.sum([r.seen for r in freq], axis=0) + 1)).astype(np.float32) + np.float32(0.1)

    def centroids(lang_rows: pd.DataFrame) -> pd.DataFrame:
        counts = np.stack([np.frombuffer(c, np.float32) for c in lang_rows.sort_values("h")["counts"]])
        x = _weighted(counts, idf)
        c = spherical_kmeans(x, CLUSTERS)
        far, fitted, cls = left_out_distances(x), 1 - (x @ c.T).max(1), _length_class(counts)
        return pd.DataFrame({"lang": lang_rows["lang"].iloc[:1].values, "centroids": [[r.astype(np.float32).tobytes() for r in c]],
                             "far": [far.tolist()], "fitted": [fitted.astype(float).tolist()], "classes": [cls.tolist()]})

    found = rows.groupBy("lang").applyInPandas(centroids, "lang string, centroids array<binary>, far array<double>, fitted array<double>, classes array<int>").collect()
    limits = limits_of([(np.array(r.far, float), np.array(r.fitted), np.array(r.classes)) for r in found])
    each = sorted((r.lang, bytes(c), own) for r, own in zip(found, limits) for c in r.centroids)
    return {
        "langs": [lang for lang, _, _ in each],
        "idf": idf,
        "centroids": np.stack([np.frombuffer(c, np.float32) for _, c, _ in each]),
        "limits": np.array([own for _, _, own in each]),
    }


def predict(docs: DataFrame, model: dict, keep: tuple[str, ...] | None = None) -> DataFrame:
    """``keep`` (default: all columns), ``__lang`` (the nearest language or ``und``), ``__score`` (its cosine, 0 to 1)
    and ``__rejected``."""
    names = list(docs.columns if keep is None else keep)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                counts = [ngram_counts(t) if m["langs"] else None for t in part.column(0).to_pylist()]
                langs, scores, rejected = [UNKNOWN] * len(counts), np.zeros(len(counts)), np.ones(len(counts), bool)
                own = [i for i, c in enumerate(counts) if c is not None]
                if own:
                    x = np.stack([counts[i] for i in own])
                    cos = _weighted(x, m["idf"]) @ m["centroids"].T
                    best = np.argmax(cos, axis=1)
                    top = np.clip(cos[np.arange(len(own)), best].astype(float), 0.0, 1.0)
                    scores[own], rejected[own] = top, 1 - top > m["limits"][best, _length_class(x)]
                    for i, k in zip(own, best):
                        langs[i] = m["langs"][k]
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(langs, pa.string()), pa.array(scores), pa.array(rejected)], names=[*names, "__lang", "__score", "__rejected"])

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*names).schema)
    return docs.select(F.col("text").alias("__text"), *names).mapInArrow(run, schema + "__lang string, __score double, __rejected boolean")


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def language_report(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected``, learned from the rows not held out."""
    model = fit(docs.where(~held_out(F.col("doc_id"))).select("lang", "text"))
    return predict(docs, model, ("doc_id",)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("__lang").alias("lang_pred"),
        F.col("__score").alias("score"), F.col("__rejected").alias("rejected"))


def accepted_documents(docs: DataFrame) -> DataFrame:
    """Documents whose language is found, columns as in ``docs``; learned from the rows not held out."""
    model = fit(docs.where(~held_out(F.col("doc_id"))).select("lang", "text"))
    return with_columns_aside(docs, ("text",), lambda d: predict(d, model).where("NOT __rejected").select(*d.columns))
