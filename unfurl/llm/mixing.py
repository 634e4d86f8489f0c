"""Mixing sources to target weights by hash-threshold histograms (DataFrame operations only).

Every document has a fixed hash (48 bits of the md5 of its id). A source whose
target is ``k`` whole passes and a fraction of its size takes all its documents
``k`` times, and once more those with ``hash < threshold``. The threshold is the
place where the cumulated size, in hash order, comes nearest to the fraction. It
is found without sorting: sizes are summed by source and the next 12 bits of the
hash (4,096 buckets), and only the bucket in which the budget ends is refined, by
its next 12 bits, until the hash is used up. Thresholds of growing budgets are
nested: a smaller mix is part of a larger one.

Shuffles: sums by (source, bucket), combined before the shuffle, so a source with
a third of all rows sends at most 4,096 rows a task. Text is read once for the
sizes and never shuffled.

Defined cases: a NULL text counts 0 words; documents with equal ids share one hash
and are taken together; a NULL id hashes as the empty string; a NULL source is a source of its own, last in
order; sources of size 0 have target 0; an empty table gives an empty result;
other columns pass through and may have any names but ``__mix_*``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored

LEVELS, BITS = 4, 12
#: Weights repeat over the sources in order.
WEIGHTS = (1, 2, 3)
#: No target is above so many times its source's size.
MAX_PASSES = 3


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def doc_hash(doc_id: Column) -> Column:
    """48 bits that depend on the id alone."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 12), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_passes: int = MAX_PASSES) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, size)`` rows.

    Shares of the total by weight; what a source gets beyond ``max_passes`` times
    its size is shared anew by weight among the others until none is above. That
    settles at ``min(max_passes * size, level * weight)`` with one level for all,
    found from running sums in order of ``max_passes * size / weight``. The windows
    run over one row per source, after the aggregation.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.row_number().over(order) - 1) % len(weights) + 1)
    per = per.withColumn("w", weight).withColumn("cap", F.col("source_size") * max_passes)
    by_ratio = W.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    everything = W.partitionBy()
    per = per.select(
        "*",
        F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("capped"),
        F.sum("w").over(by_ratio.rowsBetween(0, W.unboundedFollowing)).alias("open_w"),
        F.sum("source_size").over(everything).alias("total"),
    ).withColumn("level", (F.col("total") - F.col("capped")) / F.col("open_w"))
    # the first source in ratio order that its level does not lift above its cap sets the level
    fits = F.when(F.col("level") * F.col("w") <= F.col("cap"), F.col("level"))
    per = per.withColumn("level", F.first(fits, ignorenulls=True).over(
        by_ratio.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
    target = F.least(F.col("cap").cast("double"), F.col("level") * F.col("w"))
    return per.select("source", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def thresholds(sized: DataFrame, goals: DataFrame, prefix: str) -> DataFrame:
    """``goals`` with ``passes`` and ``threshold``: documents with a hash below it are
    taken once more than ``passes`` times.

    ``sized(source, size, hash)``; ``goals(source, source_size, target)``, one row per source.
    """
    goals = goals.withColumn("passes", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    # base: the first hash of the open bucket; budget: what is still to be taken from it
    open_ = goals.select("*", (F.col("target") - F.col("passes") * F.col("source_size")).alias("budget"), F.lit(0).cast("long").alias("base"))
    for level in range(LEVELS):
        step = 1 << (BITS * (LEVELS - 1 - level))
        same = sized["source"].eqNullSafe(open_["source"])
        inside = (sized["hash"] >= open_["base"]) & (sized["hash"] < open_["base"] + step * (1 << BITS))
        hist = (
            sized.join(open_.select("source", "base"), same & inside)
            .select(sized["source"], F.floor((sized["hash"] - F.col("base")) / step).alias("bucket"), sized["size"])
            .groupBy("source", "bucket").agg(F.sum("size").alias("size"))
        ) if level else sized.select("source", F.floor(sized["hash"] / step).alias("bucket"), "size").groupBy("source", "bucket").agg(F.sum("size").alias("size"))
        run = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, 0)
        cum = hist.withColumn("upto", F.sum("size").over(run)).withColumnRenamed("source", "s")
        within = cum.join(open_.select(F.col("source").alias("s2"), F.col("budget")), F.col("s").eqNullSafe(F.col("s2")))
        # the bucket in which the budget ends: the first whose running sum reaches it
        ends = within.where(F.col("upto") >= F.col("budget")).groupBy("s").agg(
            F.min(F.struct("bucket", (F.col("upto") - F.col("size")).alias("before"), "upto")).alias("e"))
        open_ = open_.join(ends, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
        if level < LEVELS - 1:
            more = (F.col("base") + F.coalesce(F.col("e.bucket"), F.lit(0)) * step, F.col("budget") - F.coalesce(F.col("e.before"), F.lit(0)))
        else:  # one hash value left: take it if that comes nearer to the budget
            over = (F.col("e.upto") - F.col("budget")) < (F.col("budget") - F.col("e.before"))
            more = (F.col("base") + F.coalesce(F.col("e.bucket"), F.lit(0)) + F.when(over, 1).otherwise(0), F.col("budget"))
        open_ = stored(open_.withColumns({"base": more[0].cast("long"), "budget": more[1]}).drop("e"), f"{prefix}-{level}")
    return open_.select("source", "source_size", "target", "passes", F.col("base").alias("threshold"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_passes: int = MAX_PASSES, keep: tuple[str, ...] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``size``, ``source_size``, ``target`` and
    ``taken`` (words the mix takes of the document, repeats counted) and ``copies``
    (how often it is taken)."""
    sized = stored(docs.select("source", n_words(F.col("text")).alias("size"), doc_hash(F.col("doc_id")).alias("hash")), "mix-sizes")
    goals = stored(targets(sized, weights, max_passes), "mix-targets")
    plan = thresholds(sized, goals, "mix-threshold").select(F.col("source").alias("__mix_source"), F.col("source_size").alias("__mix_size"), F.col("target").alias("__mix_target"), F.col("passes").alias("__mix_passes"), F.col("threshold").alias("__mix_threshold"))
    names = list(keep or docs.columns)
    own = docs.select(*names, F.col("source").alias("__mix_s"), n_words(F.col("text")).alias("__mix_n"), doc_hash(F.col("doc_id")).alias("__mix_h"))
    out = own.join(plan, F.col("__mix_s").eqNullSafe(F.col("__mix_source")), "left")
    copies = F.col("__mix_passes") + F.when(F.col("__mix_h") < F.col("__mix_threshold"), 1).otherwise(0)
    return out.select(
        *[own[n] for n in names],
        F.col("__mix_n").alias("__mix_doc"), F.col("__mix_size"), F.col("__mix_target"),
        (F.col("__mix_n") * copies).alias("__mix_taken"), copies.alias("__mix_copies"),
    )


def mix_report(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken``."""
    return mix(docs, keep=("doc_id",)).select(
        "doc_id", F.col("__mix_doc").alias("size"), F.col("__mix_size").alias("source_size"),
        F.col("__mix_target").alias("target"), F.col("__mix_taken").alias("taken"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: each document as often as it is taken, columns as in ``docs``."""
    out = mix(docs).where("__mix_copies > 0")
    return out.withColumn("__mix_i", F.explode(F.sequence(F.lit(1), F.col("__mix_copies").cast("int")))).select(*docs.columns)
