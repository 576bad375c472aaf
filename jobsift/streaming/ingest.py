"""Structured Streaming ingest: topic or landing folder -> date-foldered JSON-lines batches, unchanged.

The reference flushes every 50 records or 60 s and commits offsets after the
upload. Here the source's trigger options time each micro-batch, the
checkpoint records progress only after ``foreachBatch`` returns, and each batch
folder is derived from the batch id and the batch's own data, so a replayed batch
overwrites the same folder instead of duplicating it.
"""
from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobsift.functions.text import dedup_key_part
from jobsift.operators.clean import normalize, unwrap_envelope
from jobsift.sinks.writers import batch_path
from jobsift.sources import lenient

BATCH_RECORDS = 50        # FIXED VALUE: flush size of the ingest consumer
BATCH_MAX_DELAY = "60s"   # FIXED VALUE: flush timeout of the ingest consumer


def kafka_read_options(bootstrap: str, topic: str, starting: str = "earliest", batch_records: int = BATCH_RECORDS,
                       max_delay: str = BATCH_MAX_DELAY, most_records: int | None = None,
                       fail_on_data_loss: bool = True) -> dict[str, str]:
    """Kafka source options: from the earliest offset, a micro-batch once ``batch_records``
    are there or ``max_delay`` has passed. A backlog goes in one batch unless
    ``most_records`` bounds it. Offsets that have aged out stop the query."""
    out = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic, "startingOffsets": starting,
           "minOffsetsPerTrigger": str(batch_records), "maxTriggerDelay": max_delay,
           "failOnDataLoss": str(fail_on_data_loss).lower()}
    if most_records:
        out["maxOffsetsPerTrigger"] = str(most_records)
    return out


def scan_kafka(spark: SparkSession, bootstrap: str, topic: str, **kw) -> DataFrame:
    """Streaming frame of the topic's messages as text, one column ``value`` (needs the Kafka connector)."""
    raw = spark.readStream.format("kafka").options(**kafka_read_options(bootstrap, topic, **kw)).load()
    return raw.select(F.col("value").cast("string").alias("value"))


def scan_landing(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Streaming frame of the lines of files arriving in ``path`` (oldest files first), one column ``value``, unparsed."""
    r = spark.readStream.option("recursiveFileLookup", "true")
    if files_per_batch:
        r = r.option("maxFilesPerTrigger", str(files_per_batch))
    return r.text(path)


def parsed(stream: DataFrame, schema: T.StructType) -> DataFrame:
    """The lines' records, each field coerced by itself; lines that are no JSON object are left out
    (they stay in the raw zone, where ``rejects_report`` counts them)."""
    return lenient.records(stream.select("value"), schema).where("_corrupt is null").drop("_corrupt")


def _batch_time(latest: str | None) -> _dt.datetime | None:
    for fmt in ("%Y-%m-%dT%H:%M:%SZ", "%Y-%m-%d %H:%M:%S"):
        try:
            return _dt.datetime.strptime(latest or "", fmt)
        except ValueError:
            continue
    return None


def stream_ingest(stream: DataFrame, prefix: str, checkpoint: str, time_col: str | None = "fetched_at",
                  available_now: bool = True, processing_time: str | None = None):
    """Start the ingest query: every micro-batch's lines, unchanged, become one folder
    ``prefix/YYYY/MM/DD/<ts>_batch_<id:04d>`` after the latest ``time_col`` in it (without any,
    ``prefix/batch_<id:04d>``). Folder names follow from the batch alone, so a replayed
    batch overwrites its folder. Returns the StreamingQuery."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        latest = F.max(F.get_json_object("value", f"$.{time_col}")) if time_col else F.lit(None).cast("string")
        n, last = batch.agg(F.count(F.lit(1)), latest).first()      # one light pass, then the write
        if n:
            batch.select("value").write.mode("overwrite").text(batch_path(prefix, batch_id, _batch_time(last)))

    w = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or BATCH_MAX_DELAY)
    return w.start()


def stream_clean(stream: DataFrame, source: str, out_path: str, checkpoint: str, as_of=None,
                 available_now: bool = True, dedup_within: str | None = None):
    """Continuous cleaning of one source: envelope unwrapped and normalised record by
    record (both stateless), appended as parquet. The keep-most-complete dedup stays
    a batch step; ``dedup_within`` (e.g. "1 day") optionally drops, on the stream,
    repeats of a (company, title, city) key seen within that much collection time
    (``dropDuplicatesWithinWatermark``: state is bounded by the watermark)."""
    cleaned = normalize(unwrap_envelope(stream), source, as_of)
    if dedup_within:
        keys = {"_k_company": dedup_key_part("company"), "_k_title": dedup_key_part("title"),
                "_k_city": dedup_key_part("city")}
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        event_time = F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch, F.col("collected_at")))
        cleaned = (cleaned.withColumns(keys).withColumn("_event_time", event_time)
                   .withWatermark("_event_time", dedup_within)
                   .dropDuplicatesWithinWatermark(list(keys)).drop(*keys, "_event_time"))
    w = (cleaned.writeStream.format("parquet").option("checkpointLocation", checkpoint)
         .option("path", out_path).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=BATCH_MAX_DELAY)
    return w.start()
