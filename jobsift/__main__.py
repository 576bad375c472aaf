"""Command line: ``python -m jobsift clean|ingest|report ...``.

clean   raw feeds (folders) -> cleaned parquet store + CSV (+ JDBC)
ingest  landing folder or Kafka topic -> date-foldered JSON-lines batches (bounded run)
report  one dashboard page over the cleaned store: every report whole, one Parquet folder each under --out;
        a preview of up to 20 rows each is printed
"""
from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="jobsift")
    sub = ap.add_subparsers(dest="cmd", required=True)
    c = sub.add_parser("clean")
    c.add_argument("--api"), c.add_argument("--third"), c.add_argument("--scraped")
    c.add_argument("--out", required=True), c.add_argument("--as-of")
    c.add_argument("--jdbc-url"), c.add_argument("--jdbc-table")
    i = sub.add_parser("ingest")
    i.add_argument("--landing"), i.add_argument("--kafka-bootstrap"), i.add_argument("--topic")
    i.add_argument("--out", required=True), i.add_argument("--checkpoint", required=True)
    r = sub.add_parser("report")
    r.add_argument("--store", required=True), r.add_argument("--page", default="overview"), r.add_argument("--out", required=True)
    r.add_argument("--city", default="ALL"), r.add_argument("--contract", default="ALL")
    r.add_argument("--salary-k", nargs=2, type=float), r.add_argument("--as-of")
    a = ap.parse_args(argv)

    if a.cmd == "clean" and a.jdbc_url and not a.jdbc_table:
        ap.error("--jdbc-url needs --jdbc-table")
    if a.cmd == "ingest" and a.kafka_bootstrap and not a.topic:
        ap.error("--kafka-bootstrap needs --topic")

    from jobsift import schema
    from jobsift.session import build_session, clear_scratch, scratch_mark
    spark, mark = build_session(), scratch_mark()
    if a.cmd == "clean":
        from jobsift.plans import job
        feeds = {}
        if a.api:
            feeds["api"] = job.load_feed(spark, a.api, schema.RAW_API)
        if a.scraped:
            feeds["scraped"] = job.load_feed(spark, a.scraped, schema.RAW_SCRAPED)
        if a.third:
            feeds["third"] = job.load_feed(spark, a.third, schema.RAW_THIRD, kind="mixed", csv_schema=schema.RAW_THIRD)
        table = job.run_clean_job(spark, feeds, a.out, as_of=a.as_of, jdbc_url=a.jdbc_url, jdbc_table=a.jdbc_table)
        print(f"cleaned rows: {table.count()} -> {a.out}")
    elif a.cmd == "ingest":
        from jobsift.streaming import ingest
        if a.kafka_bootstrap:
            stream = ingest.scan_kafka(spark, a.kafka_bootstrap, a.topic)
        else:
            stream = ingest.scan_landing(spark, a.landing)
        ingest.stream_ingest(stream, a.out, a.checkpoint).awaitTermination()
    else:
        from jobsift.operators.lookups import with_dashboard_columns
        from jobsift.plans.dashboard import page_reports
        served = with_dashboard_columns(spark.read.parquet(a.store))
        rng = tuple(a.salary_k) if a.salary_k else None
        for name, df in page_reports(served, a.page, a.city, a.contract, rng, a.as_of).items():
            path = f"{a.out.rstrip('/')}/{name}"
            df.write.mode("overwrite").parquet(path)
            print(f"== {name} (preview of {path})")
            spark.read.parquet(path).show(20, truncate=60)
    clear_scratch(spark, mark)
    return 0


if __name__ == "__main__":
    sys.exit(main())
