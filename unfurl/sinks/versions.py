"""Tables that are replaced without a gap.

``overwrite`` deletes the old files before the new ones are whole; a run that fails in between leaves
nothing. Here each write goes to a folder of its own, and a commit names the folder that counts::

    path/versions/<version>/part-...      a whole Parquet table each
    path/commits/                         one small JSON record a commit: number, version

A reader follows the commit with the highest number (``read_current``; ``read_table`` does so
by itself). The record is written by a Spark job of one row, whose file appears by
a rename when the job commits, after the version's own write has. So whatever kills a writer, readers see the old table or
the new one. Earlier versions stay as they are, for readers that have planned on them and to go back to;
``drop_old_versions`` removes them. Writers take turns: of two at once the higher number counts, and of equal numbers the higher version.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from .files import write_parquet

_COMMIT = "number long, version string"


def _commits(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """Commits of a table, oldest first; a run makes one, so they are few."""
    try:
        rows = spark.read.schema(_COMMIT).json(f"{path.rstrip('/')}/commits").collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted((r.number, r.version) for r in rows)


def current_version(spark: SparkSession, path: str) -> str | None:
    """Folder of the version that counts; None where nothing was committed."""
    commits = _commits(spark, path)
    return f"{path.rstrip('/')}/versions/{commits[-1][1]}" if commits else None


def replace_table(df: DataFrame, path: str, *, compression: str = "snappy", partition_by: list[str] | None = None) -> str:
    """Write ``df`` as the table's next version and make it the one that counts; returns its folder.

    ``df`` may read the table itself: the version it reads is not touched.
    """
    spark, root = df.sparkSession, path.rstrip("/")
    version = uuid.uuid4().hex
    folder = f"{root}/versions/{version}"
    write_parquet(df, folder, mode="errorifexists", compression=compression, partition_by=partition_by)
    _commit(spark, root, version)
    return folder


def _commit(spark: SparkSession, root: str, version: str) -> None:
    number = max((n for n, _ in _commits(spark, root)), default=0) + 1
    spark.createDataFrame([(number, version)], _COMMIT).coalesce(1).write.mode("append").json(f"{root}/commits")


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The committed version of a table; an error where there is none."""
    folder = current_version(spark, path)
    if folder is None:
        raise FileNotFoundError(f"no version of {path} was committed")
    return spark.read.parquet(folder)


def roll_back(spark: SparkSession, path: str) -> str:
    """Make the version before the current one count again (as a new commit); returns its folder."""
    commits = _commits(spark, path)
    earlier = [v for _, v in commits if v != commits[-1][1]] if commits else []
    if not earlier:
        raise FileNotFoundError(f"{path} has no earlier version")
    _commit(spark, path.rstrip("/"), earlier[-1])
    return f"{path.rstrip('/')}/versions/{earlier[-1]}"


def drop_old_versions(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Remove versions beside the last ``keep`` that were committed, and what failed writers left; returns how many.

    Not while a writer is at work: what it has written is not committed yet.
    """
    last: list[str] = []
    for _, v in reversed(_commits(spark, path)):
        if v not in last:
            last.append(v)
    root = f"{path.rstrip('/')}/versions"
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(root)
    store = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.exists(folder):
        return 0
    old = [f.getPath() for f in store.listStatus(folder) if f.getPath().getName() not in last[:max(1, keep)]]
    for p in old:
        store.delete(p, True)
    return len(old)
