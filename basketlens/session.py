"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", app: str = "basketlens", memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks on one machine.

    On a cluster the session comes from ``spark-submit``; the operators rely only
    on defaults (AQE on, ANSI on), so no setting made here is needed for results.
    """
    n = cores if cores != "*" else 8
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder for checkpoints and scratch tables, as named by ``spark.checkpoint.dir``.

    Executors must all reach it, so a machine-local folder is made only for a
    local master; on a cluster the setting is required.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        root = configured
    elif spark.sparkContext.master.split("[")[0] == "local":
        root = tempfile.mkdtemp(prefix="basketlens-")
        spark.conf.set(CHECKPOINT_DIR, root)
    else:
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors can reach")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
