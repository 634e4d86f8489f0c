"""Benchmark: headline flatten queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line:
  {"metric": "flatten_total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ..., ...}

Setup (untimed): payload tables are built from the driver tables by Spark and
written once to parquet (as the production input table would exist). Timed:

* ``flatten_*``    the four flattens over the written payload table, all
                   columns computed (``noop`` sink), best of ``BENCH_REPEAT``;
* ``*_lenient``    the same with ``strict=False`` (cost of the row rules);
* ``q_*``          registered queries end to end (payload building included);
* baseline         the scan / cep flattens as row-at-a-time Python UDFs
                   returning ``map<string,string>`` with the same rules (the
                   execution model being replaced), for comparison only; not
                   part of ``value``.

Also reported: rows/s per flatten and the plan shape of each flatten (Python
nodes and exchanges, want 0; JSON parses, want 1).
"""

from __future__ import annotations

import json
import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)
sys.path.insert(0, os.path.join(HERE, "tests"))
# Python workers (UDF baseline only) import the same modules
os.environ["PYTHONPATH"] = os.pathsep.join([HERE, os.path.join(HERE, "tests"), os.environ.get("PYTHONPATH", "")])

from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from unfurl import BM, BM_XML, CEP_XML, SCAN, flatten_json, flatten_xml  # noqa: E402
from unfurl.session import get_session, scratch_path  # noqa: E402
from workloads import registry as R  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPEAT = int(os.environ.get("BENCH_REPEAT", "2"))
QUICK = os.environ.get("BENCH_QUICK", "") not in ("", "0")  # flattens only


def sf_of(path: str) -> float | str:
    base = os.path.basename(os.path.normpath(path))
    try:
        return float(base.replace("sf", ""))
    except ValueError:
        return base


def run_noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn, repeat=1) -> float:
    best = None
    for _ in range(repeat):
        t = time.perf_counter()
        fn()
        dt = time.perf_counter() - t
        best = dt if best is None else min(best, dt)
    return round(best, 3)


def main() -> None:
    spark = get_session("unfurl-bench", master=f"local[{CPUS}]", shuffle_partitions=CPUS * 2,
                        driver_memory=os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
    root = scratch_path(spark, "bench")

    # ---- setup: payload table, written once -------------------------------
    t0 = time.perf_counter()
    scan = R.scan_payloads(spark, SF_DIR)
    bm = R.bm_payloads(spark, SF_DIR).select("pk", "bmResponse")
    cep = R.cep_payloads(spark, SF_DIR).select("pk", "cepPayload")
    bmx = R.bm_xml_payloads(spark, SF_DIR).select("pk", "bmPayload")
    table = scan.join(bm, "pk").join(cep, "pk").join(bmx, "pk")
    # several files per core, as a large table would have splits: a CPU-bound
    # flatten on fewer, uneven parts would measure scheduling, not the operator
    table.repartition(CPUS * 4).write.mode("overwrite").parquet(os.path.join(root, "payloads"))
    setup_sec = round(time.perf_counter() - t0, 3)
    payloads = spark.read.parquet(os.path.join(root, "payloads"))
    n_rows = payloads.count()

    queries: dict[str, float] = {}
    flattens = {
        "flatten_scan": lambda strict=True: flatten_json(payloads, "scanResponse", SCAN, strict=strict),
        "flatten_bm": lambda strict=True: flatten_json(payloads, "bmResponse", BM, strict=strict),
        "flatten_cep_xml": lambda strict=True: flatten_xml(payloads, "cepPayload", CEP_XML, strict=strict),
        "flatten_bm_xml": lambda strict=True: flatten_xml(payloads, "bmPayload", BM_XML, strict=strict),
    }
    plan_shape = {}
    for name, build in flattens.items():
        queries[name] = timed(lambda b=build: run_noop(b()), REPEAT)
        plan = build()._jdf.queryExecution().executedPlan().toString()
        plan_shape[name] = {
            "python_nodes": plan.count("EvalPython"),
            "exchanges": plan.count("Exchange"),
            "json_parses": plan.count("parseJson"),
            "codegen_stages": plan.count("*("),
        }
    for name in ("flatten_scan", "flatten_cep_xml"):
        queries[f"{name}_lenient"] = timed(lambda b=flattens[name]: run_noop(b(strict=False)), REPEAT)

    end_to_end = ["scan_flat", "bm_flat", "json_strict_drop", "cep_xml_flat", "bm_xml_flat",
                  "prev_day_inclusive", "apply_mapping", "map_to_columns", "unnest_typed", "sql_over"]
    for name in [] if QUICK else end_to_end:
        queries[f"q_{name}"] = timed(lambda n=name: run_noop(R.QUERIES[n](spark, SF_DIR)))

    # ---- comparison: row-at-a-time Python UDFs, same rules ------------------
    from pyoracle import flatten_json_py, flatten_xml_py, walk

    def udf_flatten(fn, spec, col):
        cols = spec.columns()
        walked = walk(spec)  # once, not per document: the model being replaced does no such work per row

        def row(text, pk, sk, ts):
            out = fn(text, spec, walked=walked)
            if out is None:
                return None
            out.update({"pk": pk, "sk": sk, "upsertTimestamp": ts})
            return out

        udf = F.udf(row, T.MapType(T.StringType(), T.StringType()))
        mapped = payloads.select(udf(col, "pk", "sk", "upsertTimestamp").alias("m")).where("m IS NOT NULL")
        return mapped.select(*[F.col("m").getItem(c).alias(c) for c in cols])

    baseline = {}
    if not QUICK:
        baseline["scan"] = timed(lambda: run_noop(udf_flatten(flatten_json_py, SCAN, "scanResponse")))
        baseline["cep_xml"] = timed(lambda: run_noop(udf_flatten(flatten_xml_py, CEP_XML, "cepPayload")))

    total = round(sum(queries[k] for k in flattens), 3)
    print(json.dumps({
        "metric": "flatten_total_sec",
        "value": total,
        "unit": "sec",
        "queries": queries,
        "sf": sf_of(SF_DIR),
        "rows": n_rows,
        "rows_per_sec": {k: round(n_rows / queries[k], 1) for k in flattens},
        "python_udf_baseline_sec": baseline,
        "speedup_vs_python_udf": {k: round(v / queries[f"flatten_{k}"], 1) for k, v in baseline.items()},
        "plan_shape": plan_shape,
        "setup_sec": setup_sec,
        "cpus": CPUS,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
