"""Cleaning job: dedup rules, source shapes, envelope, malformed input, the whole run."""
import json

from pyspark.sql import functions as F

from jobsift.operators import clean
from jobsift.session import scratch_path
from jobsift.sinks.writers import batch_path
from jobsift.sources import envelope, files

API_RECORDS = [
    {"title": "Data Scientist Senior", "company": {"display_name": "TechCorp"},
     "location": {"display_name": "Paris, Ile-de-France"}, "description": "Python, SQL, machine learning, Docker",
     "salary_min": 50000, "salary_max": 65000, "created": "2026-03-15T10:00:00Z",
     "redirect_url": "https://example.com/1", "id": "1"},
    {"title": "Data Engineer", "company": {"display_name": "DataInc"}, "location": {"display_name": "Lyon"},
     "description": "Spark, Kafka, AWS, Airflow", "salary_min": 45000, "salary_max": 55000,
     "created": "2026-03-14T09:00:00Z", "redirect_url": "https://example.com/2", "id": "2"},
    {"title": "Stage Data Analyst", "company": {"display_name": "StartupAI"}, "location": {"display_name": "Toulouse"},
     "description": "SQL et Power BI", "salary_min": None, "salary_max": None,
     "created": "2026-03-13T08:00:00Z", "redirect_url": "https://example.com/3", "id": "3"},
]
API_SCHEMA = ("title string, company struct<display_name string>, location struct<display_name string>, "
              "description string, salary_min int, salary_max int, created string, redirect_url string, id string")


def api_df(spark, records=API_RECORDS):
    return spark.createDataFrame([tuple(r[k] if not isinstance(r[k], dict) else (r[k]["display_name"],)
                                        for k in ["title", "company", "location", "description", "salary_min",
                                                  "salary_max", "created", "redirect_url", "id"]) for r in records],
                                 API_SCHEMA)


def test_clean_three_api_records(spark):
    out = clean.build_clean({"api": api_df(spark)}, as_of="2026-03-16 00:00:00")
    rows = out.collect()
    assert out.columns == clean.lexicon.TARGET_COLUMNS
    assert len(rows) == 3
    assert sum(r["salary_avg"] is not None for r in rows) >= 2
    by_title = {r["title"]: r for r in rows}
    assert by_title["Data Scientist Senior"]["city"] == "Paris"
    assert by_title["Data Scientist Senior"]["tech_stack"] == "Python, SQL, Docker, Machine Learning"
    assert by_title["Stage Data Analyst"]["contract_type"] == "Stage"
    assert by_title["Data Engineer"]["salary_avg"] == 50000.0


def test_clean_doubled_record_dedups(spark):
    out = clean.build_clean({"api": api_df(spark, API_RECORDS + [API_RECORDS[0]])}, as_of="2026-03-16 00:00:00")
    assert out.count() == 3


def test_dedup_rules(spark):
    df = spark.createDataFrame([
        ("Data Scientist", "TechCorp", "Paris", 50000.0),
        ("Data Scientist", "TechCorp", "Paris", 50000.0),
        ("data scientist ", "techcorp", "paris", None),
        ("Data Engineer", "TechCorp", "Paris", None),
        ("Data Engineer", "TechCorp", "Paris", 60000.0),
        ("ML Engineer", None, "Lyon", None),
        ("ML Engineer", None, "Lyon", 1.0),
    ], "title string, company string, city string, salary_avg double")
    rows = clean.dedup_keep_most_complete(df).collect()
    assert len(rows) == 3
    got = {(r["title"].strip().lower(), r["salary_avg"]) for r in rows}
    assert got == {("data scientist", 50000.0), ("data engineer", 60000.0), ("ml engineer", 1.0)}


def test_third_source_synonyms(spark):
    df = spark.createDataFrame([("Dev", None, "Acme", "lyon", "CDD", "40k-50k€", "2026-01-02", "https://x/1"),
                                (None, "Analyste", "Beta", "Nantes", "stage", None, None, "https://x/2")],
                               "job_title string, titre_poste string, entreprise string, ville string, type_contrat string, "
                               "salaire string, date_publication string, link string")
    rows = {r["company"]: r for r in clean.normalize(df, "third", as_of="2026-03-16 00:00:00").collect()}
    assert rows["Acme"]["title"] == "Dev" and rows["Beta"]["title"] == "Analyste"
    assert rows["Acme"]["city"] == "Lyon" and rows["Acme"]["contract_type"] == "CDD"
    assert (rows["Acme"]["salary_min"], rows["Acme"]["salary_max"], rows["Acme"]["salary_avg"]) == (40000, 50000, 45000)
    assert rows["Beta"]["contract_type"] == "Stage" and rows["Beta"]["currency"] == "EUR"


def test_scraped_record_shape(spark):
    df = spark.createDataFrame([("Data Analyst", "Gamma", "33000 Bordeaux, France", "Télétravail partiel", "CDI",
                                 "45K€", "https://x/3", "Analyse avec SQL")],
                               "title string, company string, location string, remote string, contract_type string, "
                               "salary string, url string, description string")
    r = clean.normalize(df, "scraped", as_of="2026-03-16 00:00:00").first()
    assert (r["city"], r["contract_type"], r["salary_avg"], r["remote"]) == ("33000 Bordeaux", "CDI", 45000.0,
                                                                            "Télétravail partiel")


def test_envelope_roundtrip_and_malformed_lines(spark):
    records = [{"source": "api", "country": "fr", "search_query": "data", "page": 2,
                "fetched_at": "2026-03-15T12:00:00Z", "data": {"title": "A", "id": "1"}},
               {"title": "B", "id": "2"}]
    path = scratch_path(spark, "test_jsonl")
    lines = [json.dumps(records[0]), "", "{not json", json.dumps(records[1]), "   "]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    schema = spark.createDataFrame([], "source string, country string, search_query string, page int, "
                                       "fetched_at string, data struct<title string, id string>, title string, id string").schema
    df = files.scan_jsonl(spark, path, schema)
    rows = sorted(clean.unwrap_envelope(df).select("title", "id", "_fetched_at").collect())
    assert [tuple(r) for r in rows] == [("A", "1", "2026-03-15T12:00:00Z"), ("B", "2", None)]
    rep = files.rejects_report(spark, path).agg(F.sum("n_good"), F.sum("n_bad")).first()
    assert tuple(rep) == (2, 1)


def test_wrap_envelope(spark):
    df = spark.createDataFrame([("A", 1)], "title string, n int")
    r = envelope.wrap_envelope(df, "api", page=3, fetched_at="2026-03-15 12:00:00").first()
    assert (r["source"], r["page"], r["fetched_at"], r["data"]["title"]) == ("api", 3, "2026-03-15T12:00:00Z", "A")


def test_batch_path_format():
    import datetime as dt
    when = dt.datetime(2026, 3, 15, 12, 30, 5)
    assert batch_path("raw/api", 7, when) == "raw/api/2026/03/15/20260315_123005_batch_0007"
    assert batch_path("raw/api/", 42, when).endswith("_batch_0042")


def test_flatten_struct(spark):
    df = spark.createDataFrame([(("X", ("Y",)), [1, 2])], "a struct<b string, c struct<d string>>, l array<int>")
    assert clean.flatten_struct(df).columns == ["a.b", "a.c.d", "l"]


def test_json_docs_array_and_object(spark):
    path = scratch_path(spark, "test_docs")
    import os
    local = path.replace("file:", "")
    os.makedirs(local, exist_ok=True)
    with open(f"{local}/a.json", "w") as f:
        json.dump([{"title": "A"}, {"title": "B"}], f, indent=2)
    with open(f"{local}/b.json", "w") as f:
        json.dump({"title": "C"}, f, indent=2)
    df = files.scan_json_docs(spark, path, spark.createDataFrame([], "title string").schema)
    assert sorted(r[0] for r in df.collect()) == ["A", "B", "C"]


def test_empty_postings_schema(spark):
    from jobsift.operators.filters import filter_postings
    df = clean.empty_postings(spark)
    assert df.columns == clean.lexicon.TARGET_COLUMNS
    assert filter_postings(df.withColumn("city_clean", F.col("city")), city="Paris", salary_range_k=(1, 2)).count() == 0
