"""Postings-shaped views over the driver's tables, so every operator runs on
data whose size grows with the scale factor.

* ``postings_view``: orders x customer x nation, with the order's sorted
  distinct part types as its skill list.
* ``event_postings_view``: events as publications (times of day, 30 days).
* ``doc_postings_view``: documents as postings with long free text.

The SQL text of each view (for the DuckDB check) is next to it.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsift.functions.text import extract_skills_text

# --- test lexicon: words that occur in the documents table ------------------
TEST_SKILLS = ["The", "And", "That", "Of", "Of the", "Der", "Und", "Le", "La", "Des", "Que", "El", "License"]
TEST_GENAI = ["the", "und", "que", "license", "qqqq"]
TEST_TRADITIONAL = ["der", "pour", "zzzz", "with"]
TEST_HARD = ["the", "and", "of", "to", "in", "is", "that", "it", "was", "for"]
TEST_SOFT = ["de", "la", "et", "le", "des", "les", "un", "du", "en", "pour"]
TEST_CLOUD = ["le", "el", "the"]
TEST_PROVIDERS = {"EN": ["the", "and"], "FR": ["les", "des"], "DE": ["der", "und"]}
TEST_WORK_MODES = [("EN", r"the\s+of|of\s+the"), ("FR", r"les\s+des|des\s+les"), ("DE", r"und\s+der|der\s+und")]
TEST_CONTRACT_RULES = [("EN", ["en"]), ("FR", ["fr"]), ("DE", ["de"])]
TEST_AS_OF = "2024-02-01 00:00:00"
ORDERS_AS_OF = "2001-09-01 00:00:00"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order: its distinct part types, sorted, ', '-joined.

    The aggregate's output is hash-partitioned by order key, which is the key of
    the next join, so orders is the only side shuffled for it.
    """
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    part = load(spark, sf_dir, "part").select("p_partkey", "p_type")
    return (li.join(part, li.l_partkey == part.p_partkey)
              .groupBy("l_orderkey")
              .agg(F.array_join(F.array_sort(F.collect_set("p_type")), ", ").alias("tech_stack")))


def postings_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    c = load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = load(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    stacks = order_skills(spark, sf_dir)
    salary = F.when(F.col("o_orderkey") % 7 == 0, F.lit(None).cast("double")).otherwise(F.col("o_totalprice"))
    contract = (F.when(F.col("o_orderstatus") == "F", "CDI")
                 .when(F.col("o_orderstatus") == "O", "CDD")
                 .when(F.col("o_orderpriority") == "1-URGENT", "Alternance")
                 .otherwise("Stage"))
    j = (o.join(stacks, o.o_orderkey == stacks.l_orderkey, "left")
          .join(c, o.o_custkey == c.c_custkey)
          .join(n, c.c_nationkey == n.n_nationkey))
    return j.select(
        F.col("o_orderkey").alias("posting_id"),
        F.col("o_orderpriority").alias("title"),
        F.col("c_name").alias("company"),
        F.col("n_name").alias("city"),
        contract.alias("contract_type"),
        (salary - 500).alias("salary_min"),
        (salary + 500).alias("salary_max"),
        salary.alias("salary_avg"),
        F.lit("EUR").alias("currency"),
        F.lit(None).cast("string").alias("description"),
        F.lit(None).cast("string").alias("category"),
        F.col("o_orderdate").alias("published_at"),
        F.concat(F.lit("https://example.com/"), F.col("o_orderkey").cast("string")).alias("url"),
        F.col("c_mktsegment").alias("source"),
        F.col("tech_stack"),
        (F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("collected_at"),
        F.col("n_name").alias("city_clean"),
    )


POSTINGS_SQL = """
stacks AS (
  SELECT l_orderkey, array_to_string(list_sort(list_distinct(list(p_type))), ', ') AS tech_stack
  FROM lineitem JOIN part ON l_partkey = p_partkey
  GROUP BY l_orderkey
),
postings AS (
  SELECT o_orderkey AS posting_id, o_orderpriority AS title, c_name AS company, n_name AS city,
         CASE WHEN o_orderstatus = 'F' THEN 'CDI' WHEN o_orderstatus = 'O' THEN 'CDD'
              WHEN o_orderpriority = '1-URGENT' THEN 'Alternance' ELSE 'Stage' END AS contract_type,
         CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END - 500 AS salary_min,
         CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END + 500 AS salary_max,
         CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS salary_avg,
         'EUR' AS currency, CAST(NULL AS VARCHAR) AS description, CAST(NULL AS VARCHAR) AS category,
         o_orderdate AS published_at, 'https://example.com/' || CAST(o_orderkey AS VARCHAR) AS url,
         c_mktsegment AS source, tech_stack, o_orderdate + INTERVAL 1 DAY AS collected_at,
         n_name AS city_clean
  FROM orders LEFT JOIN stacks ON o_orderkey = l_orderkey
       JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey
)"""


def nation_coords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A coordinates dimension derived from nation by a fixed rule."""
    n = load(spark, sf_dir, "nation")
    known = F.col("n_regionkey") != 4  # one region without coordinates
    return n.select(F.col("n_name").alias("city_clean"),
                    F.when(known, F.lit(41.0) + F.col("n_nationkey") * F.lit(0.5)).alias("lat"),
                    F.when(known, F.lit(-4.0) + F.col("n_nationkey") * F.lit(0.25)).alias("lon"))


def nation_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = load(spark, sf_dir, "nation")
    return n.select(F.col("n_name").alias("city"),
                    ((F.col("n_nationkey") + 1) * 100000).cast("bigint").alias("population"))


NATION_COORDS_SQL = """
coords AS (SELECT n_name AS city_clean,
                  CASE WHEN n_regionkey <> 4 THEN CAST(41.0 AS DOUBLE) + n_nationkey * CAST(0.5 AS DOUBLE) END AS lat,
                  CASE WHEN n_regionkey <> 4 THEN CAST(-4.0 AS DOUBLE) + n_nationkey * CAST(0.25 AS DOUBLE) END AS lon FROM nation)"""
NATION_POP_SQL = """
pop AS (SELECT n_name AS city, CAST((n_nationkey + 1) * 100000 AS BIGINT) AS population FROM nation)"""


def event_postings_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events")
    return e.select(F.col("event_id").alias("posting_id"), F.col("ts").alias("published_at"),
                    F.col("event_type").alias("source"), F.col("user_id"), F.col("value"))


EVENTS_SQL = """
eposts AS (SELECT event_id AS posting_id, ts AS published_at, event_type AS source, user_id, value FROM events)"""


def doc_postings_view(spark: SparkSession, sf_dir: str, skills=TEST_SKILLS) -> DataFrame:
    d = load(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").alias("posting_id"), F.col("lang").alias("title"),
                    F.concat_ws(" ", "source", "lang").alias("contract_type"), F.col("text").alias("description"),
                    F.col("n_chars").cast("double").alias("salary_avg"),
                    F.col("source"), extract_skills_text(F.col("text"), skills).alias("tech_stack"))


def docs_sql(skills=TEST_SKILLS) -> str:
    from jobsift.plans import sqltext as S
    return (f"docs AS (SELECT doc_id AS posting_id, lang AS title, concat_ws(' ', source, lang) AS contract_type, "
            f"text AS description, CAST(n_chars AS DOUBLE) AS salary_avg, source, "
            f"{S.extract_skills_text('text', skills)} AS tech_stack FROM documents)")


# --- derived text columns for the scalar functions ---------------------------



def places_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw place texts in ten shapes built from customer x nation."""
    c = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = load(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = c.join(n, c.c_nationkey == n.n_nationkey)
    k = F.col("c_custkey") % 10
    name = F.col("n_name")
    raw = (F.when(k == 0, F.lower(name))
            .when(k == 1, F.concat(F.lit("  "), name, F.lit(", france  ")))
            .when(k == 2, F.concat(F.lit("<b>"), name, F.lit("</b>")))
            .when(k == 3, F.lit("paris, france"))
            .when(k == 4, F.concat((F.col("c_nationkey") + 1).cast("string"), F.lit("er arrondissement, paris")))
            .when(k == 5, F.lit("ile-de-france"))
            .when(k == 6, F.lit(None).cast("string"))
            .when(k == 7, F.lit("france"))
            .when(k == 8, F.concat(F.lower(name), F.lit(" {props}")))
            .otherwise(F.lit("bouches-du-rhône, provence-alpes-côte d'azur")))
    return j.select("c_custkey", raw.alias("raw_city"))


PLACES_SQL = """
places AS (SELECT c_custkey, CASE c_custkey % 10
    WHEN 0 THEN lower(n_name) WHEN 1 THEN '  ' || n_name || ', france  ' WHEN 2 THEN '<b>' || n_name || '</b>'
    WHEN 3 THEN 'paris, france' WHEN 4 THEN CAST(c_nationkey + 1 AS VARCHAR) || 'er arrondissement, paris'
    WHEN 5 THEN 'ile-de-france' WHEN 6 THEN NULL WHEN 7 THEN 'france' WHEN 8 THEN lower(n_name) || ' {props}'
    ELSE 'bouches-du-rhône, provence-alpes-côte d''azur' END AS raw_city
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


def salary_texts_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Free-text salaries in eight shapes built from customer balances."""
    c = load(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    a = F.abs(F.floor("c_acctbal")) % 200 + 20
    s = lambda x: x.cast("string")
    k = F.col("c_custkey") % 8
    raw = (F.when(k == 0, F.concat(s(a), F.lit("k-"), s(a + 10), F.lit("k€")))
            .when(k == 1, F.concat(s(a), F.lit(" 000 - "), s(a + 5), F.lit(" 000 EUR")))
            .when(k == 2, F.concat(F.lit("$"), s(a * 1000)))
            .when(k == 3, F.concat(F.lit("£"), s(a), F.lit("K")))
            .when(k == 4, F.concat(s(a), F.lit("K CHF")))
            .when(k == 5, F.lit("salaire compétitif"))
            .when(k == 6, F.lit(None).cast("string"))
            .otherwise(F.concat(s(a + 30), F.lit("k-"), s(a), F.lit("k€"))))
    return c.select("c_custkey", raw.alias("raw_salary"))


def _sql_a() -> str:
    return "CAST(abs(FLOOR(c_acctbal)) AS BIGINT) % 200 + 20"


SALARY_TEXTS_SQL = f"""
salaries AS (SELECT c_custkey, CASE c_custkey % 8
    WHEN 0 THEN CAST({_sql_a()} AS VARCHAR) || 'k-' || CAST({_sql_a()} + 10 AS VARCHAR) || 'k€'
    WHEN 1 THEN CAST({_sql_a()} AS VARCHAR) || ' 000 - ' || CAST({_sql_a()} + 5 AS VARCHAR) || ' 000 EUR'
    WHEN 2 THEN '$' || CAST(({_sql_a()}) * 1000 AS VARCHAR)
    WHEN 3 THEN '£' || CAST({_sql_a()} AS VARCHAR) || 'K'
    WHEN 4 THEN CAST({_sql_a()} AS VARCHAR) || 'K CHF'
    WHEN 5 THEN 'salaire compétitif' WHEN 6 THEN NULL
    ELSE CAST({_sql_a()} + 30 AS VARCHAR) || 'k-' || CAST({_sql_a()} AS VARCHAR) || 'k€' END AS raw_salary
  FROM customer)"""

# FIXED VALUES (test input): raw contract texts cycled over orders
CONTRACT_TEXTS = ["permanent", " CDI ", "full_time", "Contract", "cdd", "temporary", "freelance", "independent",
                  "internship", "stage", "intern", "apprenticeship", "alternance", "part_time",
                  "Contrat à durée déterminée (CDD)", None]


def contract_texts_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders").select("o_orderkey")
    arr = F.array(*[F.lit(x).cast("string") for x in CONTRACT_TEXTS])
    return o.select("o_orderkey", F.element_at(arr, (F.col("o_orderkey") % len(CONTRACT_TEXTS) + 1).cast("int")).alias("raw_contract"))


def _sql_list(values) -> str:
    return "[" + ", ".join("NULL" if v is None else "'" + v.replace("'", "''") + "'" for v in values) + "]"


CONTRACT_TEXTS_SQL = f"""
contracts AS (SELECT o_orderkey, CAST({_sql_list(CONTRACT_TEXTS)} AS VARCHAR[])[o_orderkey % {len(CONTRACT_TEXTS)} + 1] AS raw_contract
  FROM orders)"""


def date_texts_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date texts in five shapes (zone-explicit, so parsing does not depend on the session zone)."""
    e = load(spark, sf_dir, "events").select("event_id", "ts")
    k = F.col("event_id") % 5
    raw = (F.when(k == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
            .when(k == 1, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+02:00'"))
            .when(k == 2, F.lit("not-a-date"))
            .when(k == 3, F.lit(None).cast("string"))
            .otherwise(F.date_format("ts", "yyyy-13-dd'T'HH:mm:ss'Z'")))
    return e.select("event_id", raw.alias("raw_date"))


DATE_TEXTS_SQL = """
dates AS (SELECT event_id, CASE event_id % 5
    WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S+02:00')
    WHEN 2 THEN 'not-a-date' WHEN 3 THEN NULL ELSE strftime(ts, '%Y-13-%dT%H:%M:%SZ') END AS raw_date
  FROM events)"""
