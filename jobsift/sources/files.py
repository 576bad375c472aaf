"""File sources: JSON lines, whole-file JSON, CSV, mixed directories, file listings.

Every valid record comes through: JSON is read as text and coerced field by field
(``sources.lenient``), CSV columns go by their header's names. What cannot be a
record is reported by file, never dropped in silence.
"""
from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobsift.sources import csvsplit, jsonsplit, lenient

CORRUPT = "_corrupt"
#: Bytes of a JSON document above which it is read in ranges.
SPLIT_OVER = 64 << 20
log = logging.getLogger("jobsift.sources")


def _paths(path: str | Sequence[str]) -> str | list[str]:
    return path if isinstance(path, str) else list(path)


def _text(spark: SparkSession, path: str | Sequence[str], glob: str | None, skip_unreadable: bool, whole: bool = False) -> DataFrame:
    r = (spark.read.option("recursiveFileLookup", "true")
         .option("ignoreCorruptFiles", str(skip_unreadable).lower()))
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.text(_paths(path), wholetext=whole).select("value", F.col("_metadata.file_path").alias("_file"),
                                                      F.col("_metadata.file_size").alias("_size")).where(F.trim("value") != "")


def scan_jsonl(spark: SparkSession, path: str | Sequence[str], schema: T.StructType,
               glob: str | None = None, keep_corrupt: bool = False, skip_unreadable: bool = False) -> DataFrame:
    """Every JSON-lines file under ``path`` (recursively). Blank lines are skipped.

    A valid record stays whatever the types of its fields: numbers are read from
    text, text from any value, a single value as a list of one; what cannot be
    coerced is null. Lines that are no JSON object are dropped unless
    ``keep_corrupt`` (then ``_corrupt`` holds the line); ``rejects_report`` counts
    them. ``_file`` is the source file of each row.
    """
    df = lenient.records(_text(spark, path, glob, skip_unreadable).drop("_size"), schema, corrupt=CORRUPT)
    return df if keep_corrupt else df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def rejects_report(spark: SparkSession, path: str | Sequence[str], glob: str | None = None) -> DataFrame:
    """Records and rejected lines per file (blank lines ignored); they add up to the file's lines.

    A line is rejected exactly when ``scan_jsonl`` drops it: it is no JSON object.
    """
    lines = lenient.records(_text(spark, path, glob, False).drop("_size"), T.StructType([]), corrupt=CORRUPT)
    bad = F.col(CORRUPT).isNotNull()
    return lines.groupBy("_file").agg(F.count_if(~bad).alias("n_good"), F.count_if(bad).alias("n_bad"))


def scan_json_docs(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, glob: str | None = None,
                   skip_unreadable: bool = False, keep_corrupt: bool = False, split_over: int = SPLIT_OVER) -> DataFrame:
    """Whole-file JSON documents: each file is one object or an array of objects, coerced as in ``scan_jsonl``.

    A file that is no JSON, or an entry that is no object, is dropped unless
    ``keep_corrupt``; ``docs_report`` counts them by file. A file over ``split_over`` bytes is read by several
    tasks (``sources.jsonsplit``); of one that is no JSON, only its beginning is kept as reject.
    """
    df = _objects(_entries(spark, path, glob, skip_unreadable, split_over), schema)
    return (df if keep_corrupt else df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)).drop("_file")


def _entries(spark: SparkSession, path: str | Sequence[str], glob: str | None, skip_unreadable: bool, split_over: int) -> DataFrame:
    """(_file, __bad, __v) of all documents: small files whole, large ones in ranges."""
    text = _text(spark, path, glob, skip_unreadable, whole=True).where(F.col("_size") <= split_over)
    parsed = lenient.whole_value(text, "value", "__v")
    many = F.try_variant_get("__v", "$", "array<variant>")
    small = parsed.select("_file", F.when(F.col("__v").isNull(), F.col("value")).alias("__bad"), F.explode(F.coalesce(many, F.array("__v"))).alias("__v"))
    sizes = _listing(spark, path, glob).where(F.col("length") > split_over)
    return small if sizes.isEmpty() else small.unionByName(jsonsplit.entries(spark, path, glob, skip_unreadable, split_over))


def _objects(entries: DataFrame, schema: T.StructType) -> DataFrame:
    bad = F.col("__v").isNull() | ~lenient.is_object(F.col("__v"))
    return entries.select(*[lenient.field(F.col("__v"), f.dataType, "$" + lenient._step(f.name)).alias(f.name) for f in schema.fields],
                          F.when(bad, F.coalesce("__bad", F.to_json("__v"))).alias(CORRUPT), "_file")


def docs_report(spark: SparkSession, path: str | Sequence[str], glob: str | None = None, split_over: int = SPLIT_OVER) -> DataFrame:
    """Records and rejected entries per whole-file JSON document."""
    bad = F.col(CORRUPT).isNotNull()
    return (_objects(_entries(spark, path, glob, False, split_over), T.StructType([])).groupBy("_file")
            .agg(F.count_if(~bad).alias("n_good"), F.count_if(bad).alias("n_bad")))


def scan_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | None = None,
             glob: str | None = None, skip_unreadable: bool = False) -> DataFrame:
    """Headered UTF-8 CSV, columns by the names of each file's own header.

    With a schema its columns are taken by name and cast one by one (a value that
    cannot be cast is null, a column that a file lacks is null); without one, all
    columns come as text. Quotes are doubled and quoted text may hold line ends; a
    large file is read by several tasks all the same (``sources.csvsplit``). Lines end
    with ``\\n`` or ``\\r\\n``; blank lines between records are skipped; the header is one line.
    """
    return csvsplit.read(spark, path, schema, glob, skip_unreadable)


def _has_files(spark: SparkSession, path: str, glob: str) -> bool:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob) \
        .load(path).select("length").limit(1).count() > 0


def scan_mixed_dir(spark: SparkSession, path: str, schema: T.StructType,
                   lines_glob: str = "*.jsonl", doc_glob: str = "*.json", csv_glob: str = "*.csv",
                   csv_schema: T.StructType | None = None, skip_unreadable: bool = False) -> DataFrame:
    """Dispatch files by extension (JSON lines, JSON documents, CSV), ignore others,
    and union the results by column name.

    A damaged file fails the read; with ``skip_unreadable`` what can be read of it
    is taken and ``files_report`` tells which files gave how many records.
    """
    parts = []
    if _has_files(spark, path, lines_glob):
        parts.append(scan_jsonl(spark, path, schema, glob=lines_glob, skip_unreadable=skip_unreadable).drop("_file"))
    if _has_files(spark, path, doc_glob):
        parts.append(scan_json_docs(spark, path, schema, glob=doc_glob, skip_unreadable=skip_unreadable))
    if _has_files(spark, path, csv_glob):
        parts.append(scan_csv(spark, path, csv_schema, glob=csv_glob, skip_unreadable=skip_unreadable))
    if not parts:
        return spark.createDataFrame([], schema)
    if skip_unreadable:
        log.warning("damaged files under %s are skipped; files_report lists what each file gave", path)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def files_report(spark: SparkSession, path: str, lines_glob: str = "*.jsonl", doc_glob: str = "*.json") -> DataFrame:
    """Every listed JSON file with its records and rejects; both null for a file of which nothing could be read."""
    found = None
    for glob, whole in ((lines_glob, False), (doc_glob, True)):
        if not _has_files(spark, path, glob):
            continue
        rows = (_objects(_entries(spark, path, glob, True, SPLIT_OVER), T.StructType([])) if whole
                else lenient.records(_text(spark, path, glob, True).drop("_size"), T.StructType([]), corrupt=CORRUPT))
        bad = F.col(CORRUPT).isNotNull()
        counts = rows.groupBy("_file").agg(F.count_if(~bad).alias("n_good"), F.count_if(bad).alias("n_bad"))
        listed = list_files(spark, path, glob).select(F.col("path").alias("_file"), "length")
        one = listed.join(counts, "_file", "left")
        found = one if found is None else found.unionByName(one)
    return found if found is not None else spark.createDataFrame([], "_file string, length long, n_good long, n_bad long")


def _listing(spark: SparkSession, path: str | Sequence[str], glob: str | None) -> DataFrame:
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(_paths(path)).select("path", "modificationTime", "length")


def list_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Non-empty files under ``path`` with size and modification time, newest first.
    Only file metadata is read (the content column is pruned)."""
    return _listing(spark, path, glob).filter(F.col("length") > 0).orderBy(F.desc("modificationTime"), F.asc("path"))


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A JSON-lines snapshot of a table with its types back; an empty frame of the schema when there is none."""
    if not _has_files(spark, path, "*.json*"):
        return spark.createDataFrame([], schema)
    return scan_jsonl(spark, path, schema, glob="*.json*").select(*schema.fieldNames())


def read_served_table(spark: SparkSession, url: str, table: str, properties: dict | None = None,
                      schema: T.StructType | None = None, partition_column: str | None = None,
                      bounds: tuple[int, int] | None = None, num_partitions: int = 8, retries: int = 5,
                      wait_seconds: float = 3.0) -> DataFrame:
    """Read the served table over JDBC (parallel by ``partition_column`` when given),
    retrying ``retries`` times; an empty frame of ``schema`` when it stays unreachable."""
    import time
    props = dict(properties or {})
    last = None
    for attempt in range(retries):
        try:
            if partition_column and bounds:
                df = spark.read.jdbc(url, table, column=partition_column, lowerBound=bounds[0],
                                     upperBound=bounds[1], numPartitions=num_partitions, properties=props)
            else:
                log.warning("reading %s in one task: give partition_column and bounds to read it in parallel", table)
                df = spark.read.jdbc(url, table, properties=props)
            df.schema  # noqa: B018  (forces the connection)
            return df
        except Exception as exc:  # noqa: BLE001
            last = exc
            if attempt < retries - 1:
                time.sleep(wait_seconds)
    if schema is None:
        raise RuntimeError(f"served table unreachable: {last}")
    return spark.createDataFrame([], schema)
