"""Sustained-threshold alerts on a stream (the "expr > X for: D" rule).

An alert fires as soon as a run of samples above the threshold has lasted D,
whether or not the run has ended. Every micro-batch goes through the same
DataFrame rule as a table of samples (``plans.metrics.threshold_runs``), whose
scans split a series by rows, so a hot series is not one task. Between batches
the open runs are kept: one row per series, written under the checkpoint by batch
id, so a replayed batch reads and writes the same state; the last two batches' are kept. Samples of a series
arrive in time order across micro-batches; inside one they may come in any order.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsift.plans.metrics import EPOCH, MICROS, _micros, threshold_runs

STATE_SCHEMA = "series string, start_us long, last_us long, n long, fired boolean"
ALERT_SCHEMA = "series string, start timestamp_ntz, fired_at timestamp_ntz, severity string"


def _time(us: str):
    return F.timestamp_add("MICROSECOND", F.col(us), F.lit(EPOCH).cast("timestamp_ntz"))


def advance(spark: SparkSession, samples: DataFrame, state: DataFrame, threshold: float, for_seconds: float, severity: str,
            max_gap_seconds: float | None = None, stale_seconds: float | None = None) -> tuple[DataFrame, DataFrame]:
    """(alerts, new state) of one micro-batch of (series, us, value) samples after the open runs in ``state``.

    A run that was open comes in as one sample at its last time that carries its
    start. With ``stale_seconds``, open runs whose last sample is that much older
    than the newest one are given up, which bounds the state.
    """
    rows = samples.select("series", "us", (F.col("value") > threshold).alias("above"), F.col("us").alias("start_us"), F.lit(1).cast("long").alias("n"),
                          F.lit(False).alias("fired"))
    carried = state.select("series", F.col("last_us").alias("us"), F.lit(True).alias("above"), "start_us", "n", "fired")
    runs = threshold_runs(rows.unionByName(carried), for_seconds, max_gap_seconds)
    alerts = (runs.where("fired_us is not null and not fired")
              .select("series", _time("start_us").alias("start"), _time("fired_us").alias("fired_at"), F.lit(severity).alias("severity")))
    still = runs.where("is_open").select("series", "start_us", "last_us", "n", (F.col("fired") | F.col("fired_us").isNotNull()).alias("fired"))
    if stale_seconds is not None:
        newest = samples.agg(F.max("us")).scalar()
        still = still.where(F.col("last_us") >= F.coalesce(newest, F.col("last_us")) - F.lit(int(stale_seconds * MICROS)))
    return alerts, still


def _forget(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def start_threshold_alerts(stream: DataFrame, out_path: str, checkpoint: str, threshold: float, for_seconds: float, severity: str,
                           series: str = "user_id", ts: str = "ts", value: str = "value", max_gap_seconds: float | None = None,
                           stale_seconds: float | None = None, available_now: bool = True, processing_time: str = "60s"):
    """Start the rule on a stream of samples; alerts are appended as parquet, one folder per batch. Returns the StreamingQuery.

    A run breaks at a sample at or below the threshold, and at a gap of more than
    ``max_gap_seconds``. Series are text: a number, a host or a container name.
    Null series, times or values take no part.
    """
    spark = stream.sparkSession
    root = f"{checkpoint.rstrip('/')}/open_runs"

    def step(batch: DataFrame, batch_id: int) -> None:
        samples = batch.select(F.col(series).cast("string").alias("series"), _micros(ts).alias("us"), F.col(value).cast("double").alias("value")).dropna()
        samples.persist()                               # parsed once, though the sort reads them twice
        state = spark.read.schema(STATE_SCHEMA).parquet(f"{root}/{batch_id - 1}") if batch_id else spark.createDataFrame([], STATE_SCHEMA)
        alerts, still = advance(spark, samples, state, threshold, for_seconds, severity, max_gap_seconds, stale_seconds)
        alerts.write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/batch={batch_id}")
        still.write.mode("overwrite").parquet(f"{root}/{batch_id}")
        samples.unpersist()
        _forget(spark, f"{root}/{batch_id - 2}")        # a replay reads the state of the batch before it, nothing older

    w = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)).start()


def read_alerts(spark: SparkSession, out_path: str) -> DataFrame:
    return spark.read.schema(ALERT_SCHEMA).option("recursiveFileLookup", "true").parquet(out_path)
