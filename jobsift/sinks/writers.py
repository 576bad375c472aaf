"""Sinks: CSV, parquet, date-partitioned JSON lines, Kafka, JDBC.

Writers run one task per partition; nothing is gathered on the driver.
"""
from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from jobsift.sources.envelope import to_json_lines


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Headered UTF-8 CSV that ``scan_csv`` reads back exactly: quotes doubled, line ends inside quotes, spaces
    kept, empty strings quoted (a null is an empty cell)."""
    (df.write.mode(mode).option("header", "true").option("encoding", "UTF-8").option("quote", '"').option("escape", '"')
       .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path))
    return path


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> str:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def batch_path(prefix: str, batch_id: int, when: _dt.datetime | None = None) -> str:
    """``prefix/YYYY/MM/DD/<yyyymmdd_hhmmss>_batch_<id:04d>`` for a batch of a known time, else ``prefix/batch_<id:04d>``:
    never the clock, so a replayed batch gets its own folder again."""
    if when is None:
        return f"{prefix.rstrip('/')}/batch_{batch_id:04d}"
    return f"{prefix.rstrip('/')}/{when:%Y/%m/%d}/{when:%Y%m%d_%H%M%S}_batch_{batch_id:04d}"


def write_partitioned_jsonl(df: DataFrame, prefix: str, ts_col: str | None = None, batch_id: int | None = None,
                            when: _dt.datetime | None = None, mode: str = "append") -> str:
    """JSON lines under date folders.

    With ``ts_col``: Hive-style ``year=/month=/day=`` folders from that (event)
    time column, so readers prune partitions by date. Without it: one batch folder,
    under the date of ``when`` if given, as the ingest layout.
    """
    if ts_col:
        out = (df.withColumn("year", F.year(ts_col)).withColumn("month", F.month(ts_col))
                 .withColumn("day", F.dayofmonth(ts_col)))
        out.write.mode(mode).partitionBy("year", "month", "day").json(prefix)
        return prefix
    path = batch_path(prefix, batch_id or 0, when)
    df.write.mode(mode).json(path)
    return path


def kafka_write_options(bootstrap: str, topic: str, acks: str = "all", linger_ms: int = 100,
                        batch_size: int = 32768) -> dict[str, str]:
    """Producer options for the Kafka sink. The default acks, linger and batch size are FIXED VALUES of the producer."""
    return {"kafka.bootstrap.servers": bootstrap, "topic": topic, "kafka.acks": acks,
            "kafka.linger.ms": str(linger_ms), "kafka.batch.size": str(batch_size)}


def write_kafka(df: DataFrame, bootstrap: str, topic: str, **kw) -> None:
    """Each row as UTF-8 JSON to ``topic`` (needs the Kafka connector on the classpath)."""
    to_json_lines(df).write.format("kafka").options(**kafka_write_options(bootstrap, topic, **kw)).save()


def write_jdbc_text(df: DataFrame, url: str, table: str, properties: dict | None = None,
                    batch_size: int = 500) -> DataFrame:
    """Replace ``table`` with every column as text (drop + create + batch insert).
    Returns the input so a caller can still write it elsewhere when this fails."""
    as_text = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
    props = dict(properties or {})
    props.setdefault("batchsize", str(batch_size))
    as_text.write.mode("overwrite").jdbc(url, table, properties=props)
    return df


def write_jdbc_replace(df: DataFrame, url: str, table: str, properties: dict | None = None,
                       batch_size: int = 500) -> None:
    """Typed replace load in batches of ``batch_size`` rows per partition."""
    props = dict(properties or {})
    props.setdefault("batchsize", str(batch_size))
    df.write.mode("overwrite").jdbc(url, table, properties=props)


def write_counted(df: DataFrame, write) -> int:
    """Run ``write(df)`` and return how many rows it wrote, observed on the write itself."""
    seen = Observation(f"written-{uuid.uuid4().hex[:12]}")
    write(df.observe(seen, F.count(F.lit(1)).alias("n")))
    return int(seen.get["n"])


def verify_row_count(n_written: int, read_back: DataFrame) -> DataFrame:
    """One row with the rows written, as ``write_counted`` observed them, and the rows that are there."""
    return read_back.agg(F.count(F.lit(1)).alias("n_read")).select(F.lit(n_written).cast("long").alias("n_written"), "n_read")
