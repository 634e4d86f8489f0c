"""Merkle manifest of a dataset: a tree of hashes per source, and one over the sources.

Each row is a leaf, the hash of its columns ``doc_id, source, lang, n_chars, text`` (``-`` for
NULL, else byte count, ``:``, value). Within a source leaves stand in ascending
``doc_id``; every ``FAN_OUT`` neighbours hash to their parent, the last run may be
shorter, until one node is left, the subroot. The subroots in order of source (NULL
first, bytewise) give the root in the same way. Hashes are lower-case hex SHA-256 and
are hashed as that text.

Per level one window over runs: ``lag`` and ``lead`` at the fixed offsets 1 to
``FAN_OUT - 1``, masked by a node's slot and its run's length, are the siblings left and
right of a node; the first child of a run, with what leads it, hashes the parent.

Scale: only ids and hashes are sorted and shuffled, never texts. Places come from a range sort
over (source, id, hash) and the row count of each of its partitions, so a source of any size is
spread over all tasks; a window holds one run of ``FAN_OUT`` rows. There is a round
of jobs a level, the logarithm of the largest source to base ``FAN_OUT``, and each level
has a ``FAN_OUT``-th of the rows. A node's upper siblings travel as one list from a parent to its
children, a join on the run. Levels are stored in the shared folder.

Defined cases: NULL ids come first in their source; rows with equal ids are in order of
their hash; a source of one row has its leaf as subroot, and one source its subroot as
root; a NULL source is a source of its own, an empty one another; a NULL id is never tampered
with; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored

FAN_OUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_GROUP = ["g_known", "g"]  # the group of a node: NULL has a group of its own
_PATH = "array<struct<left:string,right:string>>"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def framed(value: Column) -> Column:
    """``-`` for NULL, else the byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(row: dict[str, Column]) -> Column:
    return digest(*[framed(row[f]) for f in FIELDS])


def is_tampered(doc_id: Column) -> Column:
    """Where 5 divides the id's crc32, the tamperer sets A-Z of the text in lower case."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def in_place(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``nodes`` with ``pos``, the place in the group by ``order``, and ``n``, the group's size."""
    ranked = nodes.repartitionByRange(*[F.col(c) for c in [*_GROUP, *order]]).sortWithinPartitions(*_GROUP, *order)
    # the id counts rows in a partition in its low 33 bits and partitions above
    ranked = stored(ranked.withColumn("i", F.monotonically_increasing_id()), "manifest-ranked").withColumn("part", F.shiftright("i", 33))
    runs = stored(ranked.groupBy(*_GROUP, "part").agg(F.min("i").alias("first"), F.count("*").alias("rows")), "manifest-runs")
    before = W.partitionBy(*_GROUP).orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # a row for each partition the group is in
    placed = runs.select(*_GROUP, "part", (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("shift"),
                         F.sum("rows").over(W.partitionBy(*_GROUP)).alias("n"))
    return ranked.join(placed, [*_GROUP, "part"]).withColumn("pos", F.col("i") + F.col("shift")).drop("part", "i", "shift")


def siblings(level: DataFrame, fan_out: int = FAN_OUT) -> DataFrame:
    """A level with ``run``, ``slot``, and the hashes ``left`` and ``right`` of each node in its run."""
    level = level.withColumn("run", F.floor(F.col("pos") / fan_out)).withColumn("slot", F.col("pos") % fan_out)
    level = level.withColumn("length", F.least(F.lit(fan_out), F.col("n") - F.col("run") * fan_out))
    w = W.partitionBy(*_GROUP, "run").orderBy("slot")
    lags = [F.when(F.col("slot") >= k, F.lag("h", k).over(w)).otherwise("") for k in range(fan_out - 1, 0, -1)]
    leads = [F.when(F.col("slot") + k < F.col("length"), F.lead("h", k).over(w)).otherwise("") for k in range(1, fan_out)]
    return level.withColumns({"left": F.concat(*lags), "right": F.concat(*leads)})


def parents(level: DataFrame, fan_out: int = FAN_OUT) -> DataFrame:
    """The next level: the first child of each run hashes the run; a group's last node stays as it is."""
    first = siblings(level, fan_out).where("slot = 0")
    h = F.when(F.col("n") > 1, digest(F.col("h"), F.col("right"))).otherwise(F.col("h"))
    return first.select(*_GROUP, F.col("run").alias("pos"), F.ceil(F.col("n") / fan_out).alias("n"), h.alias("h"))


def tree(leaves: DataFrame, fan_out: int = FAN_OUT) -> list[DataFrame]:
    """All levels, from ``leaves`` (``pos, n, h`` by group) to the one where each group has one node."""
    levels = [leaves]
    while not levels[-1].where("n > 1").isEmpty():
        levels.append(stored(parents(levels[-1], fan_out), f"manifest-level-{len(levels)}"))
    return levels


def with_paths(levels: list[DataFrame], tops: DataFrame, fan_out: int = FAN_OUT) -> DataFrame:
    """The lowest level with ``path``, the siblings ``left`` and ``right`` of each level from there to the top,
    and then the path in ``tops``; further columns of ``tops`` come down with it."""
    up = levels[-1].join(tops, _GROUP)
    for at in range(len(levels) - 2, -1, -1):
        above = up.drop("n", "h", "run").withColumnRenamed("pos", "run").withColumnRenamed("path", "up")
        if at < len(levels) - 2:
            above = stored(above, f"manifest-paths-{at + 1}")
        level = siblings(levels[at], fan_out)
        own = F.when(F.col("n") > 1, F.array(F.struct("left", "right"))).otherwise(F.array().cast(_PATH))
        up = level.join(above, [*_GROUP, "run"]).withColumn("path", F.concat(own, "up")).drop("left", "right", "up", "slot", "length", "run")
    return up


def folded(start: Column, path: Column) -> Column:
    """The root that ``start`` gives with the siblings of ``path``."""
    return F.aggregate(path, start, lambda h, s: digest(s["left"], h, s["right"]))


def proof(path: Column) -> Column:
    """The hash of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def manifest(docs: DataFrame, fan_out: int = FAN_OUT) -> DataFrame:
    """``doc_id, leaf, changed, subroot, root, path`` of each row; ``changed`` is the leaf of the row as
    tampered with, NULL where it is not."""
    row = {f: F.col(f) for f in FIELDS}
    changed = F.when(is_tampered(row["doc_id"]), leaf_hash({**row, "text": F.translate(row["text"], _UPPER, _LOWER)}))
    made = docs.select("doc_id", F.col("source").isNotNull().alias("g_known"), F.coalesce("source", F.lit("")).alias("g"), leaf_hash(row).alias("h"), changed.alias("changed"))
    leaves = stored(in_place(stored(made, "manifest-hashed"), ["doc_id", "h"]), "manifest-leaves")
    levels = tree(leaves, fan_out)

    # the tree over the sources: one group, whose leaves are the subroots
    subroots = levels[-1].select(F.lit(True).alias("g_known"), F.lit("").alias("g"), F.col("g_known").alias("known"), F.col("g").alias("name"), "h")
    ordered = stored(in_place(subroots, ["known", "name"]), "manifest-sources")
    upper = tree(ordered, fan_out)
    root = upper[-1].select(*_GROUP, F.col("h").alias("root"), F.array().cast(_PATH).alias("path"))
    sources = with_paths(upper, root, fan_out).select(F.col("known").alias("g_known"), F.col("name").alias("g"), F.col("h").alias("subroot"), "root", "path")
    return with_paths(levels, stored(sources, "manifest-upper"), fan_out).withColumnRenamed("h", "leaf").select("doc_id", "leaf", "changed", "subroot", "root", "path")


def manifest_report(docs: DataFrame) -> DataFrame:
    m = manifest(docs).select("doc_id", "leaf", "subroot", "root", proof(F.col("path")).alias("proof_sha256"),
                              folded(F.coalesce("changed", "leaf"), F.col("path")).alias("folded_root"))
    return m.withColumn("verified", F.col("folded_root") == F.col("root"))
