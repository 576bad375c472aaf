"""Page fields on a hand-written page; CPU and usage percentages by hand."""
import datetime as dt

from pyspark.sql import functions as F

from jobsift.plans import metrics, pages

PAGE = """<html><head><script>var x = "<p>not text</p>";</script><style>p{}</style></head><body>
<!-- <h1>comment</h1> -->
<h1> Data   <b>Engineer</b> &amp; ML </h1>
<a href="/organization/acme">  Acme &amp; Co </a>
<div><img src="i.png" alt="location"> Lyon, France</div>
<div><img alt="remote" src="r.png">Télétravail partiel</div>
<ul><li><a href="/fr/job/1">one</a></li><li><a href="https://other.org/fr/job/2">two</a></li><li><a href="/fr/job/1">dup</a></li></ul>
<span>Contrat : CDI</span><span>Salaire 45 k€ brut</span>
<p>Short text.</p>
<p>Nous utilisons des cookies pour améliorer votre expérience de navigation.</p>
<p>Vous rejoindrez une équipe de données qui construit des pipelines.<p>Second paragraph that is long enough to be kept.
</body></html>"""


def test_page_fields(spark):
    df = spark.createDataFrame([(1, "https://jobs.example.com/fr/job/9?x=1", PAGE)], "page_id long, url string, html string")
    r = pages.extract_page_fields(df).first()
    assert r["title"] == "DataEngineer& ML"            # text nodes stripped and joined, as get_text(strip=True)
    assert r["company"] == "Acme & Co"
    assert r["location"] == "Lyon, France" and r["remote"] == "Télétravail partiel"
    assert r["contract_type"] == "Contrat : CDI" and r["salary"] == "Salaire 45 k€ brut"
    assert r["description"].split("\n") == ["Vous rejoindrez une équipe de données qui construit des pipelines.",
                                            "Second paragraph that is long enough to be kept."]
    links = [(x["position"], x["link"]) for x in pages.extract_links(df).orderBy("position").collect()]
    assert links == [(0, "https://jobs.example.com/fr/job/1"), (1, "https://other.org/fr/job/2")]


def test_location_fallback(spark):
    html = "<div><span>75008 Paris, France</span></div>"
    df = spark.createDataFrame([(1, "https://x.org/a", html)], "page_id long, url string, html string")
    assert pages.extract_page_fields(df).first()["location"] == "75008 Paris, France"


def test_delta_and_usage_percent(spark):
    rows = [(1, 7, dt.datetime(2024, 1, 1, 0, 0, 0), 10.00, '{"k": 2, "eth1": 5}'),
            (2, 7, dt.datetime(2024, 1, 1, 0, 0, 10), 12.50, '{"k": 2, "eth1": 7}'),
            (3, 7, dt.datetime(2024, 1, 1, 0, 0, 20), 11.00, '{"k": 0}')]
    df = spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp_ntz, value double, props string")
    cpu = {r["event_id"]: r["cpu_pct"] for r in
           metrics.delta_percent(df, cpus=F.get_json_object("props", "$.k")).collect()}
    assert cpu == {1: 0.0, 2: 2.5 / 10 * 2 * 100, 3: 0.0}
    use = {r["event_id"]: (r["mem_pct"], r["net_total"]) for r in metrics.usage_percent(
        df, "value", F.get_json_object("props", "$.k").cast("bigint"),
        F.map_values(F.from_json("props", "map<string,bigint>"))).collect()}
    assert use == {1: (500.0, 7), 2: (625.0, 9), 3: (0.0, 0)}


def test_pages_of_one_row_group_are_parsed_by_many_tasks(spark):
    df = spark.range(0, 400, 1, 1).select(F.col("id").alias("page_id"), F.lit("https://x.org/a").alias("url"), F.lit(PAGE).alias("html"))
    tasks = pages.extract_page_fields(df).groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) >= 8 and sum(r["count"] for r in tasks) == 400 and max(r["count"] for r in tasks) <= 100
