"""Registered queries for sources, sinks and streaming.

Each writes data derived from a driver table under the shared checkpoint folder,
reads it back with the operator under test, and is checked against the table.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobsift.operators.clean import unwrap_envelope
from jobsift.plans import catalog_clean as cc
from jobsift.plans import fixtures as fx
from jobsift.plans import sqltext as S
from jobsift.plans.registry import P, _p, register
from jobsift.session import scratch_path
from jobsift.sinks import writers
from jobsift.sources import envelope, files
from jobsift.streaming import ingest

MICROS_JSON = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}   # keep microseconds through JSON
FETCHED = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def _ntz(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if t == "timestamp" else F.col(c) for c, t in df.dtypes])


def _event_envelopes(spark, d) -> DataFrame:
    ev = fx.load(spark, d, "events")
    return ev.select(
        F.lit("api").alias("source"), F.lit("fr").alias("country"), F.lit("data scientist").alias("search_query"),
        F.lit(1).alias("page"), F.date_format("ts", FETCHED).alias("fetched_at"),
        F.struct("event_id", "event_type", "value", "user_id").alias("data"))


def _write_event_lines(spark, d, damaged: bool) -> tuple[str, T.StructType]:
    """Events as envelope JSON lines; when ``damaged``, 'error' events are cut short
    (malformed) and 'signup' events are followed by a blank line."""
    env = _event_envelopes(spark, d)
    schema = env.schema
    line = env.select(F.to_json(F.struct(*env.columns)).alias("value"), F.col("data.event_type").alias("event_type"))
    if damaged:
        line = line.select(F.when(F.col("event_type") == "error", F.expr("substring(value, 1, length(value) - 3)"))
                           .when(F.col("event_type") == "signup", F.concat(F.col("value"), F.lit("\n")))
                           .otherwise(F.col("value")).alias("value"))
    path = scratch_path(spark, "landing")
    line.select("value").write.text(path)
    return path, schema


_EVENT_COLS = "event_id, event_type, value, user_id"


def _loose_lines(spark, d) -> tuple[str, T.StructType]:
    """Events as plain JSON lines whose fields change their JSON type from row to row, with fields no schema knows;
    every seventh line is broken."""
    ev = fx.load(spark, d, "events")
    k = F.col("event_id") % 4
    number, text = F.col("event_id").cast("string"), F.concat(F.lit('"'), F.col("event_id").cast("string"), F.lit('"'))
    tags = F.when(k == 0, F.format_string('["%s","x"]', "event_type")).when(k == 1, F.format_string('"%s"', "event_type")).otherwise(F.lit("null"))
    line = F.concat(F.lit('{"event_id":'), F.when(k == 2, text).otherwise(number), F.lit(',"user_id":'), F.col("user_id").cast("string"),
                    F.lit(',"label":'), F.when(k == 3, F.lit("17")).otherwise(F.format_string('"%s"', "event_type")),
                    F.lit(',"tags":'), tags, F.lit(',"unknown":{"a":['), number, F.lit(']}}'))
    line = F.when(F.col("event_id") % 7 == 0, F.expr("concat('{broken ', event_id)")).otherwise(line)
    path = scratch_path(spark, "loose")
    ev.select(line.alias("value")).write.text(path)
    return path, T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.StringType()),
                               T.StructField("label", T.StringType()), T.StructField("tags", T.ArrayType(T.StringType()))])


@register("scan_jsonl_mistyped", """
SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, CASE WHEN event_id % 4 = 3 THEN '17' ELSE event_type END AS label,
       CASE event_id % 4 WHEN 0 THEN event_type || ',x' WHEN 1 THEN event_type END AS tags
FROM events WHERE event_id % 7 <> 0""")
def q_scan_jsonl_mistyped(spark, d):
    """Every valid record comes through, whatever the JSON types of its fields."""
    path, schema = _loose_lines(spark, d)
    return files.scan_jsonl(spark, path, schema).select("event_id", "user_id", "label", F.array_join("tags", ",").alias("tags"))


@register("rejects_are_lines_minus_records", """
SELECT COUNT(*) AS n_lines, COUNT(*) FILTER (WHERE event_id % 7 <> 0) AS n_records, COUNT(*) FILTER (WHERE event_id % 7 = 0) AS n_rejected FROM events""")
def q_rejects_are_lines_minus_records(spark, d):
    path, schema = _loose_lines(spark, d)
    report = files.rejects_report(spark, path).agg(F.sum("n_bad").alias("n_rejected"))
    lines = spark.read.text(path).agg(F.count(F.lit(1)).alias("n_lines"))
    records = files.scan_jsonl(spark, path, schema).agg(F.count(F.lit(1)).alias("n_records"))
    return lines.select("n_lines", records.scalar().alias("n_records"), report.scalar().cast("long").alias("n_rejected"))


@register("scan_jsonl", f"""
SELECT {_EVENT_COLS}, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS _fetched_at FROM events WHERE event_type <> 'error'""")
def q_scan_jsonl(spark, d):
    path, schema = _write_event_lines(spark, d, damaged=True)
    return unwrap_envelope(files.scan_jsonl(spark, path, schema).drop("_file")).select(
        "event_id", "event_type", "value", "user_id", "_fetched_at")


@register("rejects_report", """
SELECT CAST(COUNT_IF(event_type <> 'error') AS BIGINT) AS n_good, CAST(COUNT_IF(event_type = 'error') AS BIGINT) AS n_bad FROM events""")
def q_rejects_report(spark, d):
    path, _ = _write_event_lines(spark, d, damaged=True)
    per_file = files.rejects_report(spark, path)
    return per_file.agg(F.sum("n_good").cast("bigint").alias("n_good"), F.sum("n_bad").cast("bigint").alias("n_bad"))


def _write_json_documents(df: DataFrame, path: str, per_file: int = 100) -> None:
    """Whole-file JSON documents: each file holds one array of at most ``per_file``
    records (groups of consecutive keys), so the number of files grows with the
    data while every group stays bounded."""
    key = df.columns[0]
    docs = (df.groupBy(F.floor(F.col(key) / per_file).alias("_g"))
              .agg(F.concat(F.lit("["), F.concat_ws(",", F.collect_list(F.to_json(F.struct(*df.columns)))), F.lit("]"))
                   .alias("value")))
    docs.select("value").write.option("maxRecordsPerFile", 1).text(path)


@register("scan_json_docs", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def q_scan_json_docs(spark, d):
    cust = fx.load(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    path = scratch_path(spark, "docs")
    _write_json_documents(cust, path)
    return files.scan_json_docs(spark, path, cust.schema, glob="*.txt")


@register("scan_csv", "SELECT * FROM customer")
def q_scan_csv(spark, d):
    cust = fx.load(spark, d, "customer")
    path = writers.write_csv(cust, scratch_path(spark, "csv"))
    return files.scan_csv(spark, path, cust.schema)


_NOTE = "c_name || ' said \"hé, \"\"ça\"\"\"' || chr(10) || '  then, ' || c_mktsegment || chr(10)"


@register("scan_csv_by_header", f"""
SELECT c_custkey, {_NOTE} AS note, CASE WHEN c_custkey % 3 <> 2 THEN c_acctbal END AS c_acctbal,
       CASE WHEN c_custkey % 3 = 0 THEN c_name END AS c_name FROM customer""")
def q_scan_csv_by_header(spark, d):
    """Three kinds of files in one folder, with columns in another order, a column missing, and quoted text over several lines."""
    c = fx.load(spark, d, "customer").withColumn("note", F.expr(_NOTE.replace("chr(10)", "char(10)")))
    root = scratch_path(spark, "csv_kinds")
    for i, cols in enumerate((["c_custkey", "note", "c_acctbal", "c_name"], ["c_acctbal", "c_custkey", "note"], ["note", "c_custkey"])):
        writers.write_csv(c.where(F.col("c_custkey") % 3 == i).select(*cols), f"{root}/{i}")
    wanted = T.StructType([c.schema["c_custkey"], T.StructField("note", T.StringType()), c.schema["c_acctbal"], c.schema["c_name"]])
    return files.scan_csv(spark, root, wanted)


_KEYED = T.StructType([T.StructField("key", T.LongType()), T.StructField("name", T.StringType())])


@register("scan_mixed_dir", "SELECT c_custkey AS key, c_name AS name FROM customer")
def q_scan_mixed_dir(spark, d):
    """Customers split over three file kinds in one folder, dispatched by extension:
    CSV (.csv), gzipped JSON lines (.txt.gz) and whole-file JSON documents (.txt)."""
    cust = fx.load(spark, d, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
                                                  "c_mktsegment")
    root = scratch_path(spark, "mixed")
    seg = F.col("c_mktsegment")
    writers.write_csv(cust.filter(seg.isin("AUTOMOBILE", "BUILDING")).drop("c_mktsegment"), f"{root}/csv")
    (envelope.to_json_lines(cust.filter(seg.isin("FURNITURE", "HOUSEHOLD")).drop("c_mktsegment"))
     .write.option("compression", "gzip").text(f"{root}/lines"))
    _write_json_documents(cust.filter(seg == "MACHINERY").drop("c_mktsegment"), f"{root}/docs")
    return files.scan_mixed_dir(spark, root, _KEYED, lines_glob="*.txt.gz", doc_glob="*.txt", csv_glob="*.csv",
                                csv_schema=_KEYED)


@register("list_files", "SELECT CAST(c_nationkey AS VARCHAR) AS folder, COUNT(DISTINCT c_nationkey) AS n_files, TRUE AS all_filled FROM customer GROUP BY 1")
def q_list_files(spark, d):
    """One file in a folder of each nation; the listing gives them with their lengths."""
    cust = fx.load(spark, d, "customer")
    path = scratch_path(spark, "listed")
    cust.repartition("c_nationkey").write.partitionBy("c_nationkey").option("header", "true").csv(path)
    listed = files.list_files(spark, path, glob="*.csv")
    folder = F.regexp_extract("path", r"c_nationkey=(\d+)/", 1).alias("folder")
    return listed.groupBy(folder).agg(F.count(F.lit(1)).alias("n_files"), F.bool_and(F.col("length") > 0).alias("all_filled"))


@register("wrap_envelope", f"""
SELECT 'api' AS source, 'fr' AS country, 'data scientist' AS search_query, CAST(c_custkey % 5 + 1 AS INTEGER) AS page,
       '{fx.ORDERS_AS_OF[:10]}T{fx.ORDERS_AS_OF[11:]}Z' AS fetched_at, c_custkey, c_name FROM customer""")
def q_wrap_envelope(spark, d):
    cust = fx.load(spark, d, "customer").select("c_custkey", "c_name")
    env = envelope.wrap_envelope(cust, "api", page=(F.col("c_custkey") % 5 + 1), fetched_at=fx.ORDERS_AS_OF)
    return env.select("source", "country", "search_query", "page", "fetched_at", "data.c_custkey", "data.c_name")


_CSV_COLS = ["posting_id", "title", "company", "salary_avg", "tech_stack", "description"]


@register("write_csv", S.with_(P) + f"SELECT {', '.join(_CSV_COLS)} FROM postings")
def q_write_csv(spark, d):
    df = _p(spark, d).select(*_CSV_COLS)
    path = writers.write_csv(df, scratch_path(spark, "clean_csv"))
    return files.scan_csv(spark, path, df.schema)


@register("write_partitioned_jsonl", """
SELECT CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
       COUNT(*) AS n, CAST(SUM(event_id) AS BIGINT) AS id_sum FROM events GROUP BY 1, 2, 3""")
def q_write_partitioned_jsonl(spark, d):
    ev = fx.load(spark, d, "events").select("event_id", "ts")
    path = writers.write_partitioned_jsonl(ev, scratch_path(spark, "by_day"), ts_col="ts")
    back = spark.read.json(path)
    return back.groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("n"),
                                                    F.sum("event_id").alias("id_sum"))


@register("verify_row_count", S.with_(P) + "SELECT COUNT(*) AS n_written, COUNT(*) AS n_read FROM postings")
def q_verify_row_count(spark, d):
    df = _p(spark, d)
    path = scratch_path(spark, "served")
    n = writers.write_counted(df, lambda rows: writers.write_parquet(rows, path))
    return writers.verify_row_count(n, spark.read.parquet(path))


@register("stream_ingest", f"SELECT {_EVENT_COLS}, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS fetched_at FROM events")
def q_stream_ingest(spark, d):
    landing, schema = _write_event_lines(spark, d, damaged=False)
    out, ckpt = scratch_path(spark, "raw"), scratch_path(spark, "ingest_ckpt")
    q = ingest.stream_ingest(ingest.scan_landing(spark, landing, files_per_batch=2), out, ckpt)
    q.awaitTermination()
    back = spark.read.schema(schema).option("recursiveFileLookup", "true").json(out)
    return back.select("data.*", "fetched_at")


_RAW_LINE = """CASE WHEN event_id % 7 = 0 THEN '{broken ' || event_id
  ELSE '{"event_id":' || event_id || ',"extra" : {"a": [' || user_id || ']},  "kind":"' || event_type || '"}' END"""


@register("stream_ingest_unchanged", f"SELECT {_RAW_LINE} AS value FROM events")
def q_stream_ingest_unchanged(spark, d):
    """The raw zone holds the landed lines byte for byte, with fields no schema knows and broken lines."""
    landing, out, ckpt = scratch_path(spark, "landing"), scratch_path(spark, "raw"), scratch_path(spark, "ingest_ckpt")
    fx.load(spark, d, "events").select(F.expr(_RAW_LINE).alias("value")).write.text(landing)
    ingest.stream_ingest(ingest.scan_landing(spark, landing, files_per_batch=2), out, ckpt).awaitTermination()
    return spark.read.option("recursiveFileLookup", "true").text(out).select("value")


_SNAP = ["posting_id", "title", "salary_avg", "published_at", "tech_stack"]


@register("read_snapshot", S.with_(P) + f"SELECT {', '.join(_SNAP)} FROM postings")
def q_read_snapshot(spark, d):
    df = _p(spark, d).select(*_SNAP)
    path = scratch_path(spark, "snapshot")
    df.write.options(**MICROS_JSON).json(path)
    return files.read_snapshot(spark, path, df.schema)


def _api_envelopes(spark, d) -> DataFrame:
    api = cc.api_shape(_p(spark, d))
    return api.select(F.lit("api").alias("source"), F.lit(fx.ORDERS_AS_OF[:10] + "T" + fx.ORDERS_AS_OF[11:] + "Z").alias("fetched_at"),
                      F.struct(*api.columns).alias("data"))


STREAM_CLEAN_SQL = S.with_(P, f"""
n_api AS ({cc._norm_sql('api', 'title', 'company', 'city', 'contract_type', 'salary_min', 'salary_max', "'EUR'",
                        'tech_stack', 'CAST(published_at AS VARCHAR)', 'url', 'CAST(posting_id AS VARCHAR)')}
          FROM postings)""") + """
SELECT title, company, city, contract_type, salary_min, salary_max, salary_avg, currency, description,
       published_at, url, source, collected_at, source_id FROM n_api"""


@register("stream_clean", STREAM_CLEAN_SQL)
def q_stream_clean(spark, d):
    env = _api_envelopes(spark, d)
    landing = scratch_path(spark, "api_landing")
    env.write.json(landing)
    out, ckpt = scratch_path(spark, "clean_stream"), scratch_path(spark, "clean_ckpt")
    stream = ingest.parsed(ingest.scan_landing(spark, landing, files_per_batch=2), env.schema)
    q = ingest.stream_clean(stream, "api", out, ckpt, as_of=fx.ORDERS_AS_OF)
    q.awaitTermination()
    back = _ntz(spark.read.parquet(out))
    return back.select("title", "company", "city", "contract_type", "salary_min", "salary_max", "salary_avg", "currency",
                       "description", "published_at", "url", "source", "collected_at", "source_id")


@register("clean_job", cc.BUILD_CLEAN_SQL)
def q_clean_job(spark, d):
    """The whole batch job from files: raw feeds written from the postings view
    (API and scraped feeds as envelope JSON lines, the third feed as CSV), then
    scanned, cleaned and written to the parquet store, which is returned."""
    from jobsift.plans import job
    slices = cc.raw_slices(spark, d)
    fetched = fx.ORDERS_AS_OF[:10] + "T" + fx.ORDERS_AS_OF[11:] + "Z"
    root = scratch_path(spark, "feeds")
    feeds = {}
    for kind in ("api", "scraped"):
        raw = slices[kind]
        env = raw.select(F.lit(kind).alias("source"), F.lit(fetched).alias("fetched_at"), F.struct(*raw.columns).alias("data"))
        env.write.json(f"{root}/{kind}")
        feeds[kind] = job.load_feed(spark, f"{root}/{kind}", env.schema)
    third = slices["third"]
    writers.write_csv(third, f"{root}/third")
    feeds["third"] = job.load_feed(spark, f"{root}/third", third.schema, kind="mixed", csv_schema=third.schema)
    table = job.run_clean_job(spark, feeds, scratch_path(spark, "clean_out"), as_of=cc.CLEAN_AS_OF, skills=cc.PART_SKILLS)
    return _ntz(table)


@register("clean_new_files", cc.BUILD_CLEAN_SQL)
def q_clean_new_files(spark, d):
    """The raw feeds land in two parts; each time only the new files are cleaned and merged into the versioned store."""
    from jobsift.plans import job
    from jobsift.sinks.versioned import VersionedTable
    slices, root = cc.raw_slices(spark, d), scratch_path(spark, "landed")
    store = VersionedTable(spark, scratch_path(spark, "clean_store"), "published_at", "yyyy")
    schemas = {kind: T.StructType([T.StructField("fetched_at", T.StringType()), T.StructField("data", raw.schema)]) for kind, raw in slices.items()}
    fetched = F.lit(fx.ORDERS_AS_OF[:10] + "T" + fx.ORDERS_AS_OF[11:] + "Z").alias("fetched_at")

    def reader(kind):
        return lambda paths: job.load_feed(spark, paths, schemas[kind])

    feeds = {kind: (f"{root}/{kind}", reader(kind)) for kind in slices}
    for part in (0, 1):
        for kind, raw in slices.items():
            key = F.pmod(F.xxhash64(*raw.columns), F.lit(2))
            (raw.where(key == part).select(fetched, F.struct(*raw.columns).alias("data")).write.mode("append").options(**MICROS_JSON).json(f"{root}/{kind}"))
        job.clean_new_files(store, feeds, as_of=cc.CLEAN_AS_OF)
    return _ntz(job.cleaned_rows(store, cc.PART_SKILLS))


ALERT_THRESHOLD, ALERT_FOR = 25.0, 300


@register("sustained_threshold_stream", f"""
WITH s AS (SELECT user_id, ts, CAST(value <= {ALERT_THRESHOLD} AS INTEGER) AS ok FROM events),
r AS (SELECT *, SUM(ok) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM s),
g AS (SELECT user_id, run, ts, MIN(ts) OVER (PARTITION BY user_id, run) AS start FROM r WHERE ok = 0)
SELECT 'host-' || user_id AS series, start, MIN(ts) AS fired_at, 'critical' AS severity
FROM g WHERE epoch_us(ts) - epoch_us(start) >= {ALERT_FOR * 1_000_000} GROUP BY user_id, run, start""")
def q_sustained_threshold_stream(spark, d):
    """Events arrive in three time slices, one bounded run of the query after each; a rule fires when its time is
    reached, whether or not the run above the threshold has ended."""
    from jobsift.streaming.alerts import read_alerts, start_threshold_alerts
    ev = fx.load(spark, d, "events").select(F.concat(F.lit("host-"), "user_id").alias("host"), "ts", "value")
    landing, out, ckpt = scratch_path(spark, "alert_landing"), scratch_path(spark, "alerts"), scratch_path(spark, "alerts_ckpt")
    bounds = ev.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
    cuts = [bounds["lo"] + (bounds["hi"] - bounds["lo"]) * i / 3 for i in (1, 2)]
    for i in range(3):
        part = ev.where(F.col("ts") >= F.lit(cuts[i - 1])) if i else ev
        part = part.where(F.col("ts") < F.lit(cuts[i])) if i < 2 else part
        part.write.mode("append").options(**MICROS_JSON).json(landing)
        stream = ingest.parsed(ingest.scan_landing(spark, landing), ev.schema)
        start_threshold_alerts(stream, out, ckpt, ALERT_THRESHOLD, ALERT_FOR, "critical", series="host").awaitTermination()
    return read_alerts(spark, out)
