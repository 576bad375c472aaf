"""Streaming ingest: bounded runs, restart from the checkpoint without duplicates."""
from pyspark.sql import functions as F

from jobsift.session import scratch_path
from jobsift.streaming import ingest


def _land(spark, path, start, n):
    df = spark.range(start, start + n).select(
        F.col("id").alias("event_id"), F.lit("api").alias("source"),
        F.lit("2026-03-15T12:00:00Z").alias("fetched_at"))
    df.repartition(2).write.mode("append").json(path)
    return df.schema


def test_ingest_restart_processes_only_new_files(spark):
    landing, out, ckpt = (scratch_path(spark, x) for x in ("land", "raw", "ckpt"))
    schema = _land(spark, landing, 0, 40)
    ingest.stream_ingest(ingest.scan_landing(spark, landing, files_per_batch=1), out, ckpt).awaitTermination()
    first = spark.read.schema(schema).option("recursiveFileLookup", "true").json(out)
    assert first.count() == 40
    _land(spark, landing, 40, 20)
    ingest.stream_ingest(ingest.scan_landing(spark, landing, files_per_batch=1), out, ckpt).awaitTermination()
    back = spark.read.schema(schema).option("recursiveFileLookup", "true").json(out)
    ids = [r[0] for r in back.select("event_id").collect()]
    assert sorted(ids) == list(range(60))


def test_batch_folders_follow_layout(spark):
    landing, out, ckpt = (scratch_path(spark, x) for x in ("land2", "raw2", "ckpt2"))
    schema = _land(spark, landing, 0, 10)
    ingest.stream_ingest(ingest.scan_landing(spark, landing, files_per_batch=1), out, ckpt).awaitTermination()
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(out).select("path").collect()
    paths = [r[0] for r in files if r[0].endswith(".txt")]
    assert paths and all("/2026/03/15/20260315_120000_batch_" in p for p in paths)


def test_kafka_options():
    opts = ingest.kafka_read_options("broker:9092", "jobs")
    assert opts["startingOffsets"] == "earliest" and opts["minOffsetsPerTrigger"] == "50"
    assert "maxOffsetsPerTrigger" not in opts and opts["failOnDataLoss"] == "true"
    assert ingest.kafka_read_options("broker:9092", "t", most_records=500)["maxOffsetsPerTrigger"] == "500"
    assert opts["maxTriggerDelay"] == "60s"


def test_replay_without_a_time_overwrites_its_folder(spark):
    from jobsift.sinks.writers import batch_path
    assert batch_path("s3a://b/raw", 3) == "s3a://b/raw/batch_0003"
    landing, out = scratch_path(spark, "land3"), scratch_path(spark, "raw3")
    spark.createDataFrame([("{no json",), ('{"a":1}',), ("é\\u00e9",)], "value string").coalesce(1).write.text(landing)
    for _ in range(2):                                       # a lost checkpoint: the batch comes again
        ingest.stream_ingest(ingest.scan_landing(spark, landing), out, scratch_path(spark, "ckpt3")).awaitTermination()
    back = spark.read.option("recursiveFileLookup", "true").text(out).collect()
    assert sorted(r.value for r in back) == sorted(["{no json", '{"a":1}', "é\\u00e9"])


def _alerts_over(spark, df, slices, **kw):
    from jobsift.streaming.alerts import read_alerts, start_threshold_alerts
    landing, out, ckpt = (scratch_path(spark, x) for x in ("alerts_t", "alerts_out", "alerts_ck"))
    for part in slices:
        part.write.mode("append").options(timestampNTZFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(landing)
        stream = ingest.parsed(ingest.scan_landing(spark, landing), df.schema)
        start_threshold_alerts(stream, out, ckpt, 25.0, 300, "warning", **kw).awaitTermination()
    return sorted((r.series, r.start, r.fired_at) for r in read_alerts(spark, out).collect())


def test_stream_alerts_match_batch_rule(spark):
    import datetime as dt

    from jobsift.plans import metrics
    base = dt.datetime(2024, 1, 1)
    vals = [30, 31, 10, 40, 41, 42, 5, 50, 50, 50, 50, 1, 60, 61]     # runs cross the slices below
    rows = [("web-1", base + dt.timedelta(minutes=3 * i), float(v)) for i, v in enumerate(vals)]
    rows += [("db", base + dt.timedelta(minutes=10 * i), float(v)) for i, v in enumerate([90, 90, 90, 0])]
    rows += [("open", base + dt.timedelta(minutes=i), 99.0) for i in range(42)]                # still above at the end
    df = spark.createDataFrame(rows, "user_id string, ts timestamp_ntz, value double")
    cut = [F.lit(base + dt.timedelta(minutes=m)) for m in (12, 27)]
    slices = [df.where(F.col("ts") < cut[0]), df.where((F.col("ts") >= cut[0]) & (F.col("ts") < cut[1])), df.where(F.col("ts") >= cut[1])]
    for gap in (None, 240):
        got = _alerts_over(spark, df, slices, max_gap_seconds=gap)
        want = sorted((r.series, r.start, r.fired_at) for r in metrics.fired_alerts(df, 25.0, 300, "warning", max_gap_seconds=gap, ranges=5).collect())
        assert got == want
        assert ("open", base, base + dt.timedelta(minutes=5)) in got          # fired while the condition held
        assert ("db" in {s for s, _, _ in got}) == (gap is None)              # ten minutes apart is a gap
        assert len(got) == (4 if gap is None else 3)


def test_stream_clean_drops_repeats_within_watermark(spark):
    import json
    import os
    landing, out, ckpt = (scratch_path(spark, x) for x in ("cl_land", "cl_out", "cl_ckpt"))
    rec = lambda t, c: {"source": "api", "fetched_at": "2026-03-15T12:00:00Z",
                        "data": {"title": t, "company": {"display_name": c}, "location": {"display_name": "Paris"},
                                 "created": "2026-03-14T09:00:00Z", "redirect_url": "https://x", "id": "1"}}
    local = landing.replace("file:", "")
    os.makedirs(local, exist_ok=True)
    with open(f"{local}/a.json", "w") as f:
        for r in [rec("Data Scientist", "Acme"), rec("data scientist ", "ACME"), rec("Data Engineer", "Acme")]:
            f.write(json.dumps(r) + "\n")
    from jobsift.schema import RAW_API
    stream = ingest.parsed(ingest.scan_landing(spark, landing), RAW_API)
    ingest.stream_clean(stream, "api", out, ckpt, dedup_within="1 day").awaitTermination()
    titles = sorted(r[0] for r in spark.read.parquet(out).select("title").collect())
    assert len(titles) == 2 and "Data Engineer" in titles


def test_command_line_ingest(spark):
    import json
    import os

    from jobsift.__main__ import main
    landing, out, ckpt = (scratch_path(spark, x) for x in ("cli_land", "cli_raw", "cli_ckpt"))
    local = landing.replace("file:", "")
    os.makedirs(local, exist_ok=True)
    with open(f"{local}/a.json", "w") as f:
        for i in range(3):
            f.write(json.dumps({"source": "api", "page": 1, "fetched_at": "2026-03-15T12:00:00Z",
                                "data": {"id": str(i), "title": f"T{i}"}}) + "\n")
    assert main(["ingest", "--landing", landing, "--out", out, "--checkpoint", ckpt]) == 0
    back = spark.read.option("recursiveFileLookup", "true").json(out)
    assert sorted(r[0] for r in back.select("data.id").collect()) == ["0", "1", "2"]


def test_stale_runs_leave_the_state(spark):
    from jobsift.streaming.alerts import STATE_SCHEMA, advance
    state = spark.createDataFrame([("old", 0, 10_000_000, 3, False), ("new", 0, 900_000_000, 3, True)], STATE_SCHEMA)
    samples = spark.createDataFrame([("other", 1_000_000_000, 99.0)], "series string, us long, value double")
    _, still = advance(spark, samples, state, 25.0, 300, "warning", stale_seconds=600)
    assert sorted((r.series, r.fired) for r in still.collect()) == [("new", True), ("other", False)]


def test_alerts_parse_a_batch_once(spark):
    from jobsift.streaming.alerts import start_threshold_alerts
    landing, out, ckpt = (scratch_path(spark, x) for x in ("al_once", "al_once_out", "al_once_ck"))
    df = spark.range(500).select((F.col("id") % 7).cast("string").alias("user_id"), F.timestamp_micros(F.col("id") * 60_000_000).cast("timestamp_ntz").alias("ts"),
                                 F.when(F.col("id") % 50 == 0, 0.0).otherwise(50.0).alias("value"))
    df.write.json(landing)
    q = start_threshold_alerts(ingest.parsed(ingest.scan_landing(spark, landing), df.schema), out, ckpt, 25.0, 300, "warning")
    q.awaitTermination()
    assert sum(p["numInputRows"] for p in q.recentProgress) == 500


def test_only_rows_above_are_scanned_for_runs(spark, monkeypatch):
    from jobsift.plans import metrics
    seen, scan = [], metrics.prefix_scan
    monkeypatch.setattr(metrics, "prefix_scan", lambda df, *a, **kw: (seen.append(df), scan(df, *a, **kw))[1])
    rows = spark.createDataFrame([("a", 1, True), ("a", 2, False), ("a", 3, True), ("a", 4, True), ("b", 1, True), ("b", 9, False)], "series string, us long, above boolean")
    runs = metrics.threshold_runs(rows.selectExpr("*", "us start_us", "1L n", "false fired"), 1e-6)
    assert sorted((r.series, r.start_us, r.last_us, r.fired_us, r.is_open) for r in runs.collect()) == [
        ("a", 1, 1, None, False), ("a", 3, 4, 4, True), ("b", 1, 1, None, False)]
    assert [df.count() for df in seen] == [6, 4]
