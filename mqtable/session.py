"""Session helpers: a local session for tests/bench and the shared scratch folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "16g",
}


def local_session(cores: int | str = "*", app: str = "mqtable") -> SparkSession:
    """Session for tests and the local benchmark (``local[cores]``)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in LOCAL_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master, whose driver and executors are one process, may leave it unset; a folder
    under the system temp dir is then chosen and registered.  On a cluster that raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        import tempfile

        configured = os.path.join(tempfile.gettempdir(), "mqtable-checkpoints")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder below the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/mqtable-{label}-{uuid.uuid4().hex}"


def workers_import_package(spark: SparkSession) -> None:
    """Let Python workers import ``mqtable`` (pandas UDF handlers, the Python data
    source) when the driver found it through ``sys.path`` only.

    The package root is added to ``PYTHONPATH`` of the worker environment Spark
    passes with every Python function.  On a cluster, ship the package with
    ``--py-files``; an extra path entry that does not exist there is harmless.
    """
    import mqtable

    root = os.path.dirname(os.path.dirname(os.path.abspath(mqtable.__file__)))
    env = spark.sparkContext.environment
    parts = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in parts:
        env["PYTHONPATH"] = os.pathsep.join([root, *parts])
