"""Kept rows, rejects and their counts from one pass over the payloads.

``json_outcomes`` / ``xml_outcomes`` parse each payload once and tag every row; one
write deals the rows to a folder for each outcome, and counts ride on that write. Both tables are then read from
what was written, so nothing is parsed again.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..plans.spec import FlattenSpec


class Outcomes(NamedTuple):
    kept: DataFrame
    rejects: DataFrame
    #: rows by reject reason; those kept under ``kept``
    counts: dict[str, int]


def write_outcomes(tagged: DataFrame, path: str, spec: FlattenSpec, *, mode: str = "errorifexists", compression: str = "snappy") -> Outcomes:
    """Write tagged rows once, as Parquet under ``path/outcome=kept`` and ``path/outcome=rejected``.

    The counts come from the write itself: one map of reason and number, which has as many entries as
    the spec has checks. Defined cases: an empty table gives two empty tables and no counts.
    """
    spark = tagged.sparkSession
    reason = F.coalesce("reject_reason", F.lit("kept"))
    seen = Observation()
    # a histogram by a fixed set of names: reasons are the labels of the spec's checks
    labels = _labels(spec)
    watched = tagged.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(reason == name).alias(f"n{i}") for i, name in enumerate(labels)])
    split = watched.withColumn("outcome", F.when(F.col("reject_reason").isNull(), "kept").otherwise("rejected"))
    split.write.mode(mode).option("compression", compression).partitionBy("outcome").parquet(path)
    got = seen.get
    counts = {name: got[f"n{i}"] for i, name in enumerate(labels) if got[f"n{i}"]}
    if sum(counts.values()) != got["rows"]:
        raise RuntimeError(f"{got['rows']} rows, but {sum(counts.values())} outcomes: {counts}")
    back = spark.read.schema(split.schema).parquet(path)
    leaves = [c for c in tagged.columns if c not in ("payload", "reject_reason")]
    keys = [k for k in spec.key_columns if k in leaves]
    kept = back.where("outcome = 'kept'").select(*leaves)
    rejects = back.where("outcome = 'rejected'").select(*keys, "payload", "reject_reason")
    return Outcomes(kept, rejects, counts)


def _labels(spec: FlattenSpec) -> list[str]:
    from ..functions.xml import element_tree, walk

    names = ["kept", "null_payload", "too_large", "malformed", "not_object", "bad_wrapper", "malformed_xml", "after_end", "trailing_text", "root_count", "unbound_prefix"]
    names += [f"node:{n.label}" for n in spec.nodes()]
    names += ["node:" + "/".join(path) for path, _, _ in walk(element_tree(spec))]
    return list(dict.fromkeys(names))
