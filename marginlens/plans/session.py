"""Session helpers for local runs (tests, benchmark, examples).

Library functions never create a session; they take DataFrames.  On a
cluster the caller's session and its ``spark.checkpoint.dir`` (a shared
folder) are used as they are.
"""

from __future__ import annotations

import tempfile

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, app_name: str = "marginlens", driver_memory: str = "8g"
) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


class CheckpointDirMissing(RuntimeError):
    """A cluster session has no ``spark.checkpoint.dir``."""


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder.

    Only a ``local[...]`` session without one (tests, the bench) gets a
    private scratch folder.  Anywhere else a machine-local folder would be
    written by executors and read back where it does not exist, so a missing
    setting is an error: set ``spark.checkpoint.dir`` to a shared folder.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            if not sc.master.startswith("local"):
                raise CheckpointDirMissing(
                    "spark.checkpoint.dir is not set; point it at a folder every executor can reach"
                )
            configured = tempfile.mkdtemp(prefix="marginlens-ckpt-")
        sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def shared_scratch(spark: SparkSession, label: str) -> str:
    """A fresh folder under the session's checkpoint directory (shared storage
    on a cluster) for intermediate files such as round-trip exports."""
    import uuid

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/marginlens-{label}-{uuid.uuid4().hex}"


def written(df):
    """``df`` as a reliable checkpoint: lineage ends there, and later reads survive lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def metrics(observation) -> dict | None:
    """What an observation saw; None if Spark proved its rows empty and left it out of the plan."""
    try:
        return observation.get
    except Py4JJavaError:
        return None


def read_once(df, path: str):
    """``df``, which reads files under ``path``, as a checkpoint; the files are removed."""
    out = written(df)
    remove(df.sparkSession, path)
    return out


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder wherever its file system is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
