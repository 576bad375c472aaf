"""Lexicon sanity and the page-level entry point."""
import re

from jobsift import lexicon
from jobsift.plans import dashboard


def test_lexicon_sanity():
    assert len(lexicon.CITY_COORDS) == 28 and set(lexicon.CITY_COORDS) == set(lexicon.CITY_POPULATION)
    assert all(41 < la < 52 and -5 < lo < 10 for la, lo in lexicon.CITY_COORDS.values())
    assert len(lexicon.TECH_SKILLS) == 56 and len(set(s.lower() for s in lexicon.TECH_SKILLS)) == 56
    assert len(lexicon.TARGET_COLUMNS) == 15 and len(set(lexicon.TARGET_COLUMNS)) == 15
    assert len(lexicon.WEEKDAY_FR) == 7 and len(lexicon.AGE_BUCKET_LABELS) == len(lexicon.AGE_BUCKET_EDGES) - 1
    for _, pat in lexicon.WORK_MODE_PATTERNS:
        re.compile(pat)
    assert set(lexicon.CONTRACT_MAP.values()) == {"CDI", "CDD", "Freelance", "Stage", "Alternance", "Temps partiel"}


def test_page_reports(spark):
    import datetime as dt
    rows = [("Data Scientist", "A", "Paris", "Paris", "CDI", 50000.0, 45000.0, 55000.0, "Python, SQL",
             dt.datetime(2026, 3, 16, 10), "Python", "api", 48.85, 2.35),
            ("Data Engineer", "B", "Lyon", "Lyon", "CDD", None, None, None, "Spark",
             dt.datetime(2026, 3, 14, 9), "Spark", "api", 45.76, 4.83)]
    served = spark.createDataFrame(rows, "title string, company string, city string, city_clean string, "
                                         "contract_type string, salary_avg double, salary_min double, salary_max double, "
                                         "tech_stack string, published_at timestamp_ntz, description string, source string, "
                                         "lat double, lon double")
    for page in dashboard.PAGES:
        reports = dashboard.page_reports(served, page, city="Paris", as_of="2026-03-17 00:00:00")
        assert set(reports) == set(dashboard.PAGES[page])
        for df in reports.values():
            df.collect()
    kpis = dashboard.page_reports(served, "overview", city="Paris")["kpis"].first()
    assert kpis["n_rows"] == 1


def test_cluster_conf():
    from jobsift.session import cluster_conf
    c = cluster_conf(8000, 100)
    assert int(c["spark.sql.shuffle.partitions"]) >= 24000
    assert c["spark.sql.adaptive.enabled"] == "true" and c["spark.sql.files.maxPartitionBytes"] == "256m"
