"""Session helpers: building a session for tests/bench and locating shared scratch space."""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None, app: str = "jobsift",
                  driver_memory: str | None = None) -> SparkSession:
    """Session with what the library assumes (UTC, AQE on).

    Master, memory and partition counts come from spark-submit or the cluster's
    defaults; they are set here only when asked for, since settings in code beat
    those of the command line.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_conf(total_cores: int, input_tb: float = 100.0) -> dict[str, str]:
    """Settings for a large cluster (e.g. 1000 executors reading ~100 TB).

    Shuffles start wide (about 3 partitions per core, at least one per ~256 MB of
    input) and AQE coalesces them to ~256 MB at run time; scan splits are 256 MB;
    skewed partitions over 5x the median and 512 MB are split; broadcasts stay
    under a fixed, checked size (small dimensions only).
    """
    by_size = int(input_tb * 1024 * 1024 / 256)
    shuffle = max(total_cores * 3, min(by_size, 200_000))
    return {
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.parquet.filterPushdown": "true",
    }


def apply_conf(spark: SparkSession, conf: dict[str, str]) -> SparkSession:
    """Set SQL settings on a running session (those that can change at run time)."""
    for k, v in conf.items():
        spark.conf.set(k, v)
    return spark


def is_local(spark: SparkSession) -> bool:
    """Driver and executors are one process, so they share its folders."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Without it a cluster session raises: a machine-local folder would be a
    different one on every executor. A local session takes a temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="jobsift-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder; ``clear_scratch`` removes it."""
    root = checkpoint_root(spark).rstrip("/")
    path = f"{root}/jobsift-{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


def scratch_mark() -> int:
    """How many scratch folders have been asked for so far."""
    return len(_SCRATCH)


def clear_scratch(spark: SparkSession, since: int = 0, until: int | None = None) -> int:
    """Delete the scratch folders asked for after the mark ``since`` (and before ``until``); frames read from
    them end here. Returns how many went."""
    jvm, gone = spark.sparkContext._jvm, 0
    for path in _SCRATCH[since:until]:
        p = jvm.org.apache.hadoop.fs.Path(path)
        gone += bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True))
    del _SCRATCH[since:until]
    return gone


def materialize(df, name: str):
    """Write ``df`` as parquet under the shared folder and read it back.

    Cuts the lineage (a lost executor re-reads the files instead of recomputing the
    plan) and lets several consumers scan the result instead of recomputing it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)
