"""Column functions, restating the reference's unit assertions (salary, dates,
contracts, cities, skills, work mode) plus rules it left untested."""
import pytest
from pyspark.sql import functions as F

from jobsift import functions as J


def one(spark, expr, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


@pytest.mark.parametrize("raw,lo,hi,cur", [
    ("45k-55k€", 45000, 55000, "EUR"),
    ("45 000 - 55 000 EUR", 45000, 55000, "EUR"),
    ("50K€", 50000, 50000, "EUR"),
    ("80000 USD", 80000, 80000, "USD"),
    ("£60000", 60000, 60000, "GBP"),
    ("90K CHF", 90000, 90000, "CHF"),
    ("", None, None, "EUR"),
    (None, None, None, "EUR"),
    ("salaire compétitif", None, None, "EUR"),
    ("60k-40k€", 40000, 60000, "EUR"),
    ("45 000 €", 45000, 45000, "EUR"),
    ("35,5k", 35500, 35500, "EUR"),
])
def test_parse_salary(spark, raw, lo, hi, cur):
    r = one(spark, J.parse_salary(F.col("x")), raw)
    assert (r["salary_min"], r["salary_max"], r["currency"]) == (lo, hi, cur)


def test_parse_salary_min_not_above_max(spark):
    r = one(spark, J.parse_salary(F.col("x")), "60k-40k€")
    assert r["salary_min"] <= r["salary_max"]


def test_salary_avg_outliers(spark):
    df = spark.createDataFrame([(1000.0, 1000.0), (1001.0, 1001.0), (500000.0, 500000.0), (None, 40000.0), (None, None)],
                               "a double, b double")
    got = [r[0] for r in df.select(J.salary_avg("a", "b")).collect()]
    assert got == [None, 1001.0, None, 40000.0, None]


def test_normalize_date(spark):
    df = spark.createDataFrame([("2026-03-15T12:00:00Z",), ("not-a-date",), ("2026-01-01",), (None,), ("bad",)], "x string")
    got = [r[0] for r in df.select(J.normalize_date("x")).collect()]
    assert got[0] is not None and got[2] is not None
    assert got[1] is None and got[3] is None and got[4] is None


@pytest.mark.parametrize("raw,label", [
    ("permanent", "CDI"), ("cdi", "CDI"), ("full_time", "CDI"), ("contract", "CDD"), ("cdd", "CDD"),
    ("temporary", "CDD"), ("freelance", "Freelance"), ("internship", "Stage"), ("stage", "Stage"),
    ("apprenticeship", "Alternance"), ("alternance", "Alternance"), ("part_time", "Temps partiel"),
    ("  CDI  ", "CDI"), (None, None), ("Something", "something"),
])
def test_normalize_contract(spark, raw, label):
    assert one(spark, J.normalize_contract(F.col("x")), raw) == label


def test_infer_contract(spark):
    rows = [(None, "Stage data scientist", None), ("CDI", "Alternance data", "stage ou alternance"),
            ("CDD", "Data engineer", "Poste de stagiaire"), (None, "Data engineer", None), ("Freelance", "stage", None),
            (None, "Internationale", None)]
    df = spark.createDataFrame(rows, "c string, t string, d string")
    got = [r[0] for r in df.select(J.infer_contract("c", "t", "d")).collect()]
    assert got == ["Stage", "Alternance", "Stage", None, "Freelance", None]


@pytest.mark.parametrize("raw,city", [
    ("paris", "Paris"), ("Paris, France", "Paris"), ("ile-de-france", "Paris"), (None, "Non precise"),
    ("France", "Non precise"), ("<div>Lyon</div>", "Non precise"), ("1er arrondissement, Paris", "Paris"),
    ("Bordeaux, Gironde", "Bordeaux"), ("Gironde, Nouvelle-Aquitaine", "Bordeaux"), ("  lyon ", "Lyon"),
])
def test_normalize_city(spark, raw, city):
    assert one(spark, J.normalize_city(F.col("x")), raw) == city


@pytest.mark.parametrize("s", ["ile-de-france", "provence-alpes-côte d'azur", "1er arrondissement", "SAINT-ÉTIENNE",
                               "la défense", "o'neil mc-donald", "x_y z9a", ""])
def test_title_case_matches_python(spark, s):
    assert one(spark, J.title_case(F.col("x")), s) == s.title()


def test_city_clean(spark):
    df = spark.createDataFrame([("Paris, France",), (None,), (" Lyon ",)], "x string")
    assert [r[0] for r in df.select(J.city_clean("x")).collect()] == ["Paris", "Non précisé", "Lyon"]


@pytest.mark.parametrize("text,expected", [
    ("Maîtrise de Python, SQL et Docker requise.", {"Python", "SQL", "Docker"}),
    ("connaissance en PYTORCH et tensorflow", {"PyTorch", "TensorFlow"}),
    ("AWS, Azure et GCP", {"AWS", "Azure", "GCP"}),
    ("", set()), (None, set()), ("Gestion de projet et communication", set()),
    ("React et Golang", set()), ("Go et R", {"Go", "R"}), ("CI/CD, Power BI", {"CI/CD", "Power BI"}),
])
def test_extract_skills(spark, text, expected):
    got = one(spark, J.extract_skills_text(F.col("x")), text)
    assert set(s for s in got.split(", ") if s) == expected


def test_extract_skills_list_order_and_overlaps(spark):
    skills = ["Of", "Of the", "The", "Machine", "Machine Learning", "Learning"]
    got = one(spark, J.extract_skills(F.col("x"), skills), "the rest of the machine learning")
    assert got == ["Of", "Of the", "The", "Machine", "Machine Learning", "Learning"]


@pytest.mark.parametrize("text,mode", [
    ("Poste en full remote", "Full Remote"), ("Poste hybride 3j/semaine", "Hybride"),
    ("Poste sur site uniquement", "Présentiel"), ("Rien", "Non précisé"), ("2 jours / semaine", "Hybride"),
])
def test_work_mode(spark, text, mode):
    assert one(spark, J.detect_work_mode(F.col("x")), text) == mode


def test_keywords_and_words(spark):
    df = spark.createDataFrame([("python et sql",), ("pythonic sqlite",), ("ragout",)], "x string")
    out = df.select(J.has_word("x", "python").alias("w"), J.has_any_keyword("x", ["rag", "sql"]).alias("k")).collect()
    assert [r["w"] for r in out] == [True, False, False]
    assert [r["k"] for r in out] == [True, True, True]


def test_age_bucket_edges(spark):
    df = spark.createDataFrame([(x,) for x in [0.0, 0.5, 1.0, 3.0, 7.0, 14.0, 30.0, 999.0, 1000.0]], "x double")
    got = [r[0] for r in df.select(J.age_bucket("x")).collect()]
    assert got == [None, "< 1j", "< 1j", "1-3j", "3-7j", "7-14j", "14-30j", "> 30j", None]


def test_contract_labels(spark):
    df = spark.createDataFrame([("CDI",), ("contrat à durée déterminée",), (None,), ("xyz",), ("stage de fin",)], "x string")
    exact = [r[0] for r in df.select(J.contract_label_exact("x")).collect()]
    sub = [r[0] for r in df.select(J.contract_label_substr("x")).collect()]
    assert exact == ["CDI", "CDD", "Non précisé", "Non précisé", "Stage"]
    assert sub == ["CDI", "Autre", "Autre", "Autre", "Stage"]


def test_weekday_monday_zero(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:00",)], "x string").select(F.col("x").cast("timestamp_ntz").alias("t"))
    r = df.select(J.publication_weekday("t").alias("w"), J.weekday_label_fr(J.publication_weekday("t")).alias("l")).first()
    assert (r["w"], r["l"]) == (0, "Lundi")
