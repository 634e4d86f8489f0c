"""Sinks: parquet and CSV writers.

``write_single_csv`` produces one CSV part file with a header, in the text
form of a pandas ``to_csv(index=False)`` (minimal quoting, doubled quotes,
empty field for NULL and for the empty string). It uses ``repartition(1)``,
not ``coalesce(1)``: the flatten above still runs on every task and only the
finished rows meet in the single writer task. One file means one writer, so
for large outputs prefer ``write_csv`` (one part file per task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

CSV_OPTIONS = {
    "header": "true",
    "escape": '"',
    "quote": '"',
    "emptyValue": "",
    "nullValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

# reading back: a quoted field may hold line breaks, as payload text does
CSV_READ_OPTIONS = {**CSV_OPTIONS, "multiLine": "true"}


def write_parquet(df: DataFrame, path: str, *, mode: str = "overwrite", compression: str = "snappy",
                  partition_by: list[str] | None = None) -> None:
    w = df.write.mode(mode).option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    df.write.mode(mode).options(**CSV_OPTIONS).csv(path)


def write_single_csv(df: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    write_csv(df.repartition(1), path, mode=mode)
