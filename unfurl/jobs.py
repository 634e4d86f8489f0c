"""The three daily batch jobs, composed from the operators.

1. ``extract_previous_day``  export scan -> previous-day window -> parquet
2. ``flatten_responses``     JSON responses -> scan + bm wide tables -> parquet,
                              then optional stored SQL over the *written* tables
3. ``flatten_payloads``      JSON-wrapped XML -> cep + bm wide tables -> CSV
                              (distributed parts, or one file on request)

Each output is one lazy plan and one write action. Row counts come from
``observe`` on the write itself, not from extra ``count()`` jobs that would
recompute the flatten. The stored SQL reads the written parquet, so it never
re-runs the flatten (the written table is the lineage cut).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .operators.json_flatten import flatten_json, json_outcomes
from .operators.xml_flatten import flatten_xml, xml_outcomes
from .operators.relational import apply_mapping, previous_day, sql_file
from .plans.catalog import BM, BM_XML, CEP_XML, SCAN
from .session import scratch_path
from .sinks.files import write_parquet, write_single_csv
from .sinks.outcomes import write_outcomes
from .sources.export import export_lines, export_rejects, read_export

JSON_MAPPING = [(c, "string", c, "string") for c in ("sk", "pk", "scanResponse", "bmResponse", "upsertTimestamp")]
XML_MAPPING = [(c, "string", c, "string") for c in ("sk", "pk", "cepPayload", "bmPayload", "upsertTimestamp")]
EXPORT_ATTRIBUTES = ("pk", "sk", "scanResponse", "bmResponse", "cepPayload", "bmPayload", "upsertTimestamp")


def _counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def extract_previous_day(spark: SparkSession, export_path: str, out_path: str, *, run_date=None,
                         attributes=None, recursive: bool = False, file_glob: str | None = None,
                         rejects_out: str | None = None) -> int:
    """Every attribute of the export unless ``attributes`` names some (``EXPORT_ATTRIBUTES``: those the
    other jobs read). ``rejects_out``: also write the lines that are no items, as text."""
    if rejects_out:
        lines = export_lines(spark, export_path, recursive=recursive, file_glob=file_glob)
        export_rejects(lines, "value").write.mode("overwrite").text(rejects_out)
    src = read_export(spark, export_path, attributes, recursive=recursive, file_glob=file_glob)
    df = previous_day(src, "upsertTimestamp", run_date=run_date)
    df, obs = _counted(df, "extract")
    write_parquet(df, out_path)
    return obs.get["rows"]


def flatten_responses(spark: SparkSession, table: DataFrame, scan_out: str, bm_out: str, *,
                      query_path: str | None = None, strict: bool = True, rejects_out: str | None = None):
    """``rejects_out``: also write the dropped rows with their reason under ``rejects_out/<scan|bm>``;
    payloads are still parsed once, kept and dropped rows are copied from one tagged table."""
    src = apply_mapping(table, JSON_MAPPING)
    counts = {}
    for name, col, spec, out in (("scan", "scanResponse", SCAN, scan_out), ("bm", "bmResponse", BM, bm_out)):
        if rejects_out:
            done = write_outcomes(json_outcomes(src, col, spec, strict=strict), scratch_path(spark, f"outcomes-{name}"), spec)
            write_parquet(done.kept, out)
            write_parquet(done.rejects, f"{rejects_out}/{name}")
            counts[name] = done.counts.get("kept", 0)
            continue
        df, obs = _counted(flatten_json(src, col, spec, strict=strict), name)
        write_parquet(df, out)
        counts[name] = obs.get["rows"]
    result = None
    if query_path:
        frames = {"scan": spark.read.parquet(scan_out), "bm": spark.read.parquet(bm_out)}
        result = sql_file(spark, query_path, frames)
    return counts, result


def flatten_payloads(spark: SparkSession, table: DataFrame, cep_out: str, bm_out: str, *, strict: bool = True,
                     single_leg: str = "drop", single_file: bool = False, rejects_out: str | None = None) -> dict:
    """CSV with a header per output. ``single_file=True`` gives exactly one CSV
    file (one writer task by definition, for small outputs); the default writes
    one part file per task so no single task receives the whole table."""
    from .sinks.files import write_csv

    src = apply_mapping(table, XML_MAPPING)
    sink = write_single_csv if single_file else write_csv
    counts = {}
    for name, col, spec, out in (("cep", "cepPayload", CEP_XML, cep_out), ("bm", "bmPayload", BM_XML, bm_out)):
        if rejects_out:
            done = write_outcomes(xml_outcomes(src, col, spec, strict=strict, single_leg=single_leg), scratch_path(spark, f"outcomes-{name}"), spec)
            sink(done.kept, out)
            write_parquet(done.rejects, f"{rejects_out}/{name}")
            counts[name] = done.counts.get("kept", 0)
            continue
        df, obs = _counted(flatten_xml(src, col, spec, strict=strict, single_leg=single_leg), name)
        sink(df, out)
        counts[name] = obs.get["rows"]
    return counts
