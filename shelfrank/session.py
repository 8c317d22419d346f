"""Session construction and shared scratch locations.

Cluster jobs get their settings from the cluster; `get_session` only fills in
what is unset, so the same code runs in tests (local mode) and on a cluster.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins and partition counts from
# runtime sizes; skew join splits hot keys; UTC keeps month and epoch values
# independent of the machine zone.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Python workers, the stateful streaming ones too, talk to Spark without ports.
    "spark.python.unix.domain.socket.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

def get_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "shelfrank",
    extra: dict | None = None,
) -> SparkSession:
    """Return the active session, or build one with the defaults above."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(master: str) -> bool:
    """True for masters whose driver and executors share one machine's disk."""
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder as a URI, setting it if Spark has not.

    The folder is `spark.checkpoint.dir`. Where that is unset, a local master
    (tests) gets a fresh temporary folder that is removed when the process
    ends; any other master raises, as executors would not share a local one.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    path = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not _is_local(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="shelfrank-checkpoints-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder for one run. The URI
    scheme is kept, so it names the same place from every executor."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/shelfrank/{name}-{uuid.uuid4().hex[:12]}"
