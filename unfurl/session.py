"""Session helpers: defaults for the flatten jobs and the checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the flatten jobs rely on. Wide (400+ column) projections stay JVM-side;
# AQE re-plans the few shuffles (CSV single-file sink, user SQL) at run time.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(
    app: str = "unfurl",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    driver_memory: str | None = None,
) -> SparkSession:
    """Session with the defaults above. In local mode the driver JVM is the only
    executor, so its heap is sized here (``driver_memory``, default 8g); on a
    cluster memory comes from the submitter, not from code."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
        if master.startswith("local"):
            b = b.config("spark.driver.memory", driver_memory or "8g")
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as named by ``spark.checkpoint.dir``.

    Where the setting is empty, a local session (driver and executors are one
    process) gets a scratch folder; on a cluster that would be a node-local
    path other machines cannot read, so it is an error there.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder on storage that all executors share")
    root = _LOCAL_SHARED.get(sc.applicationId)
    if root is None:
        root = _LOCAL_SHARED[sc.applicationId] = tempfile.mkdtemp(prefix="unfurl-shared-")
    return root


_LOCAL_SHARED: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path (not yet created) under the shared folder."""
    return f"{shared_dir(spark)}/unfurl-scratch/{name}-{uuid.uuid4().hex[:12]}"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make ``DataFrame.checkpoint()`` usable: it writes below the shared folder."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(shared_dir(spark))
    return sc.getCheckpointDir()
