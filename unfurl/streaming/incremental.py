"""Incremental flatten with Structured Streaming.

The flattens are stateless row transforms, so the same plans run on a
streaming DataFrame. ``flatten_new_files`` processes only files that arrived
since the last run (the checkpoint remembers what was read) and writes them
with the exactly-once file sink; ``trigger(availableNow=True)`` makes each
scheduled run drain the backlog and stop, which is how a daily job picks up
"what is new" without a bookmark service.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.json_flatten import flatten_json
from ..operators.xml_flatten import flatten_xml
from ..plans.spec import FlattenSpec


def checkpoint_for(sink_path: str) -> str:
    """The stream's state lives beside its sink, on the same store: every run
    that writes to this sink finds it again, in any application, and two sinks
    never share it."""
    return sink_path.rstrip("/") + "_checkpoint"


def flatten_stream(stream: DataFrame, payload: str, spec: FlattenSpec, *, kind: str = "json", **kw) -> DataFrame:
    """Apply the flatten to a streaming DataFrame (same plan as batch)."""
    if kind == "json":
        return flatten_json(stream, payload, spec, **kw)
    return flatten_xml(stream, payload, spec, **kw)


def flatten_new_files(
    spark: SparkSession,
    source_path: str,
    source_schema: str,
    payload: str,
    spec: FlattenSpec,
    sink_path: str,
    *,
    kind: str = "json",
    source_format: str = "parquet",
    checkpoint: str | None = None,
    max_files_per_trigger: int | None = None,
    **flatten_kw,
) -> StreamingQuery:
    reader = spark.readStream.format(source_format).schema(source_schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    out = flatten_stream(reader.load(source_path), payload, spec, kind=kind, **flatten_kw)
    return (
        out.writeStream.format("parquet")
        .option("path", sink_path)
        .option("checkpointLocation", checkpoint or checkpoint_for(sink_path))
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
