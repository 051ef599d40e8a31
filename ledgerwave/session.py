"""Session settings and the shared folder for data that outlives one query."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the operators rely on. A cluster session normally has them already;
# AQE splits hot join partitions, which the joins on fact keys count on.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def local_session(cores: int = 8, memory: str = "16g", **extra: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ledgerwave")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a folder of this machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("start the session with spark.checkpoint.dir set to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerwave-"))
    return context.getCheckpointDir()


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Point checkpoint() at the shared folder unless the cluster has done so."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def free_shuffles(spark: SparkSession) -> None:
    """Let go of what finished steps have shuffled.

    Spark removes a shuffle's files when the driver's JVM finds that nothing refers to it, and a driver with memory to
    spare does not look for half an hour.
    """
    spark.sparkContext._jvm.System.gc()
