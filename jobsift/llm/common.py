"""Helpers shared by the operators of this subpackage."""
from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from jobsift.session import scratch_path

#: ASCII white space; words are the runs between it. ``bytes.split()`` splits at exactly these.
WORD = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """``df`` written as Parquet under the shared folder and read back.

    It cuts the lineage: a lost executor rereads files instead of recomputing the
    plan. The folder is a scratch folder of the session, for ``clear_scratch``.
    """
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with a row number ``key``, stored with the rows.

    A number that is made again at each read holds only while all reads make the
    same splits, and these follow the cores that are there when a read is planned.
    """
    return stored(docs.withColumn(key, F.monotonically_increasing_id()), "numbered", "zstd")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def bounded_batches(docs: DataFrame, rows: int = 1000) -> DataFrame:
    """``docs``, whose session from now on sends Python workers at most ``rows`` rows at a time.

    Texts are long: Spark's default of 10,000 rows a batch would hold tens of
    megabytes, several times over, in every worker.
    """
    key, conf = "spark.sql.execution.arrow.maxRecordsPerBatch", docs.sparkSession.conf
    if not 0 < int(conf.get(key)) <= rows:
        conf.set(key, rows)
    return docs


def text_bytes(text_col: str):
    """The text as UTF-8 bytes (null: empty), which is what the byte scanners read."""
    return F.coalesce(F.col(text_col).cast("string").cast("binary"), F.lit(b""))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, offsets) of a binary Arrow column, without a Python object per row."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec array<double>) of the rows that can take part in a search.

    Left out: null ids, null or empty vectors, vectors holding null or non-finite
    components, and vectors whose length is not the most frequent one (ties: the longer).
    Repeated rows (same id, same vector) count once.
    """
    if not isinstance(df.schema[vec_col].dataType, ArrayType):
        raise TypeError(f"{vec_col} must be an array of numbers")
    vec = F.col(vec_col).cast("array<double>")
    rows = (df.select(F.col(id_col).cast("long").alias("id"), vec.alias("vec"))
            .where(F.col("id").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0))
            .where(F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))))
    sizes = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).head()
    dim = sizes["d"] if sizes else 0
    return rows.where(F.size("vec") == dim)


def distinct_vectors(rows: DataFrame, keep: int) -> DataFrame:
    """(vec, ids): one row per different vector with its ``keep`` smallest ids.

    For k results per query, with ties to smaller ids, no other copy of a vector
    can be in a result when ``keep`` is k + 1, so a vector that a third of all rows
    share becomes one row. The group limit runs before the shuffle as well.
    """
    from pyspark.sql import Window
    w = Window.partitionBy("vec").orderBy("id")
    once = rows.select("id", F.transform("vec", lambda x: x + F.lit(0.0)).alias("vec")).dropDuplicates(["vec", "id"])
    return (once.withColumn("n", F.row_number().over(w)).where(F.col("n") <= keep)
            .groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids")))


#: Groups that hold more than one in so many of all rows are hot; there are never more hot groups than that.
HOT_SHARE = 1000


def join_groups(rows: DataFrame, groups: DataFrame, key: str, count: str) -> DataFrame:
    """``rows`` (null keys aside) with the columns of ``groups``, which has one row and a number of rows (``count``) a key.

    A key that holds many rows does not meet in one task: the groups with more than
    one in HOT_SHARE of all rows, at most HOT_SHARE of them whatever the input, are
    broadcast; the others go through a shuffle, where none is large.
    """
    total = groups.agg(F.sum(count)).head()[0] or 0
    hot = groups.where(F.col(count) * HOT_SHARE > total)
    rest = [c for c in groups.columns if c != key]
    tried = rows.join(F.broadcast(hot.select(key, F.struct(*rest).alias("_hot"))), key, "left")
    found = tried.where("_hot IS NOT NULL").select(*rows.columns, *[F.col(f"_hot.{c}").alias(c) for c in rest])
    others = tried.where("_hot IS NULL").drop("_hot").join(groups.where(F.col(count) * HOT_SHARE <= total), key)
    return found.unionByName(others.select(*found.columns))


def matrix(column: pa.Array) -> np.ndarray:
    """A list<double> Arrow column of equal lengths as a 2-d array."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = np.asarray(column.flatten(), dtype=np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def blobs(rows: np.ndarray) -> pa.Array:
    """Each row of a 2-d float64 array as bytes."""
    return pa.array([r.tobytes() for r in np.ascontiguousarray(rows, np.float64)], pa.binary())


def unblob(series, dim: int) -> np.ndarray:
    """The opposite of ``blobs`` for a pandas column."""
    return np.frombuffer(b"".join(series), np.float64).reshape(-1, dim)
