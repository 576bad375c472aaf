"""Report functions on a hand-made frame with hand-computed answers, and the shared filter."""
import datetime as dt

import pytest

from jobsift.operators import filters
from jobsift.plans import geo, overview, quality, salary, skills, temporal

SCHEMA = ("title string, company string, city string, city_clean string, contract_type string, salary_avg double, "
          "salary_min double, salary_max double, tech_stack string, published_at timestamp_ntz, description string, "
          "source string, lat double, lon double")


@pytest.fixture(scope="module")
def frame(spark):
    rows = [
        ("Data Scientist", "TechCorp", "Paris", "Paris", "CDI", 50000.0, 45000.0, 55000.0, "Python, SQL",
         dt.datetime(2026, 3, 16, 10), "Python et SQL en full remote", "api", 48.85, 2.35),
        ("Data Engineer", "DataInc", "Lyon", "Lyon", "CDD", 45000.0, 40000.0, 50000.0, "Spark, Python",
         dt.datetime(2026, 3, 14, 9), "Spark hybride 2 jours / semaine", "api", 45.76, 4.83),
        ("ML Engineer", "AI Lab", "Paris", "Paris", "CDI", None, None, None, "PyTorch",
         dt.datetime(2026, 3, 10, 15), "Deep learning sur site", "scraped", 48.85, 2.35),
        ("Stage Data", "StartupAI", "Toulouse", "Toulouse", "Stage", 35000.0, 30000.0, 40000.0, "",
         dt.datetime(2026, 3, 16, 8), "Stage SQL", None, None, None),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_filter_combinations(frame):
    assert filters.filter_postings(frame).count() == 4
    assert filters.filter_postings(frame, city="Paris").count() == 2
    got = filters.filter_postings(frame, salary_range_k=(40, 55)).select("salary_avg").collect()
    assert sorted((r[0] is None, r[0] or 0) for r in got) == [(False, 45000.0), (False, 50000.0), (True, 0)]
    assert filters.filter_postings(frame, city="Nowhere").count() == 0
    assert filters.filter_postings(frame, contract="CDI", city="Paris").count() == 2


def test_overview_kpis(frame):
    r = overview.overview_kpis(frame).first()
    assert r["n_rows"] == 4 and r["n_cdi"] == 2 and r["pct_cdi"] == 50.0
    assert r["salary_mean"] == (50000 + 45000 + 35000) / 3
    assert r["salary_median"] == 45000.0 and r["salary_min"] == 30000.0 and r["salary_max"] == 55000.0
    assert (r["n_companies"], r["n_cities"], r["n_with_skills"]) == (4, 3, 3)


def test_top_skills_and_share(frame):
    got = [(r["skill"], r["n"]) for r in overview.top_skills(frame).collect()]
    assert got == [("Python", 2), ("PyTorch", 1), ("SQL", 1), ("Spark", 1)]
    shares = {r["label"]: r["n"] for r in overview.contract_share(frame).collect()}
    assert shares == {"CDI": 2, "CDD": 1, "Stage": 1}


def test_salary_reports(frame):
    k = salary.salary_kpis(frame).first()
    assert k["pct_with_salary"] == 75.0 and k["salary_median"] == 45000.0
    box = {r["contract_label"]: r for r in salary.salary_box(frame).collect()}
    assert box["CDI"]["median"] == 50000.0 and box["CDI"]["n"] == 1
    assert (box["CDI"]["whisker_low"], box["CDI"]["whisker_high"]) == (50000.0, 50000.0)
    by_city = salary.salary_by_city(frame, min_rows=1).collect()
    assert [r["city_clean"] for r in by_city] == ["Paris", "Lyon", "Toulouse"]


def test_skills_page(frame):
    k = skills.skills_kpis(frame).first()
    assert k["n_distinct_skills"] == 4 and k["pct_a"] == 50.0 and k["pct_b"] == 50.0
    trio = {r["combo"]: r["pct"] for r in skills.power_trio(frame).collect()}
    assert trio["a_b"] == 25.0 and trio["trio"] == 0.0
    hs = skills.hard_vs_soft(frame, hard=["python", "sql", "spark", "java"], soft=["stage"], top=2).collect()
    assert [(r["kind"], r["keyword"], r["n"]) for r in hs] == [("Hard Skill", "python", 2), ("Hard Skill", "sql", 2),
                                                               ("Soft Skill", "stage", 1)]


def test_geo_and_work_mode(frame):
    g = geo.geo_kpis(frame).first()
    assert (g["n_cities"], g["top_city"], g["pct_remote"], g["pct_hybrid"], g["pct_home"]) == (3, "Paris", 25.0, 25.0, 50.0)
    modes = {r["work_mode"]: r["n"] for r in geo.work_mode_salary(frame).collect()}
    assert modes == {"Full Remote": 1, "Hybride": 1, "Présentiel": 1, "Non précisé": 1}


def test_time_reports(frame):
    t = temporal.time_kpis(frame, "2026-03-17 00:00:00").first()
    assert (t["n_days"], t["peak_day"], t["n_recent"]) == (3, dt.date(2026, 3, 16), 4)
    fresh = {r["bucket"]: r["n"] for r in temporal.freshness_buckets(frame, "2026-03-17 00:00:00").collect()}
    assert fresh == {"< 1j": 2, "1-3j": 1, "3-7j": 1, "7-14j": 0, "14-30j": 0, "> 30j": 0}
    wd = {r["weekday"]: r["n"] for r in temporal.by_weekday(frame).collect()}
    assert len(wd) == 7 and sum(wd.values()) == 4
    cum = [r["cumulative"] for r in temporal.cumulative_count(frame).orderBy("date").collect()]
    assert cum == [1, 2, 4]


def test_quality(frame):
    q = quality.quality_kpis(frame).first()
    assert q["n_rows"] == 4 and q["n_duplicates"] == 0 and q["n_sources"] == 2
    src = {(r["kind"], r["label"]): r["n"] for r in quality.source_and_duplicates(frame).collect()}
    assert src[("source", "Inconnue")] == 1 and src[("dedup", "Uniques")] == 4
