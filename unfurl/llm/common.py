"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, scratch_path

#: White space that separates words: \\x20 and \\x09 to \\x0D.
SPACES = " \t\n\x0b\x0c\r"
#: Lower-cases A-Z only (bytes of any UTF-8 text).
LOWER_AZ = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet under the shared folder and read it back: cuts
    the lineage, survives a lost executor, and is computed once however often it
    is used."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_columns_aside(docs: DataFrame, used: tuple[str, ...], stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``stage(docs)``, which keeps the columns of ``docs`` first and in order, with all columns but ``used``
    under names of no meaning meanwhile: whatever they are called, they never meet a name of the operator's own."""
    names = docs.columns
    out = stage(docs.toDF(*[c if c in used else f"column_{i}_aside" for i, c in enumerate(names)]))
    return out.toDF(*names, *out.columns[len(names):])


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, whatever the
    optimizer merges."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, in order; none for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), "[ \\t-\\r]+"), "")


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``: the smallest node that it
    reaches.

    Alternating large-star and small-star rounds (Kiveris et al. 2014): each
    round links nodes to the smallest neighbour, by shuffles on the node only;
    rounds grow with the logarithm of the graph. A node's neighbours are never
    collected, only their minimum. Each round is checkpointed to the shared
    folder. NULL ends are ignored.
    """
    ensure_checkpoint_dir(edges.sparkSession)

    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:  # every neighbour, both ways
            near = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        else:  # from the larger end to the smaller
            near = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        linked = near.join(low, "a")
        if large:
            out = linked.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
                low.select("a", F.col("m").alias("b")))
        return out.where("a <> b").distinct()

    def content(e: DataFrame):  # of distinct edges, so equal contents are equal edges
        return e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).collect()[0]

    e = edges.select("a", "b").where("a <> b").distinct().checkpoint()
    held = content(e)
    for _ in range(max_rounds):
        e = star(star(e, True), False).checkpoint()
        before, held = held, content(e)
        if held == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
