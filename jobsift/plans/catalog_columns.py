"""Registered queries for the Column functions (one row per input row)."""
from __future__ import annotations

from pyspark.sql import functions as F

from jobsift import lexicon
from jobsift import functions as J
from jobsift.plans import fixtures as fx
from jobsift.plans import sqltext as S
from jobsift.plans.registry import DOCS, E, P, _d, _e, _p, register

# ---------------------------------------------------------------- places


@register("normalize_city", S.with_(fx.PLACES_SQL) + f"""
SELECT c_custkey, raw_city, {S.normalize_city('raw_city')} AS city, {S.title_case('trim(raw_city)')} AS city_title,
       {S.city_clean('raw_city')} AS city_clean
FROM places""")
def q_normalize_city(spark, d):
    pl = fx.places_view(spark, d)
    return pl.select("c_custkey", "raw_city", J.normalize_city("raw_city").alias("city"),
                     J.title_case(F.trim("raw_city")).alias("city_title"), J.city_clean("raw_city").alias("city_clean"))


@register("title_case", S.with_(fx.PLACES_SQL) + f"""
SELECT c_custkey, {S.title_case('raw_city')} AS title FROM places""")
def q_title_case(spark, d):
    return fx.places_view(spark, d).select("c_custkey", J.title_case("raw_city").alias("title"))


@register("city_clean", S.with_(fx.PLACES_SQL) + f"""
SELECT c_custkey, {S.city_clean('raw_city')} AS city_clean FROM places""")
def q_city_clean(spark, d):
    return fx.places_view(spark, d).select("c_custkey", J.city_clean("raw_city").alias("city_clean"))


_JUNK = " OR ".join(f"contains({S.title_case('trim(raw_city)')}, {S.q(f)})" for f in lexicon.PLACE_JUNK_FRAGMENTS)


@register("filter_junk_place", S.with_(fx.PLACES_SQL) + f"""
SELECT c_custkey, raw_city FROM places WHERE {_JUNK}""")
def q_filter_junk_place(spark, d):
    from jobsift.operators.filters import filter_junk_place
    pl = fx.places_view(spark, d).withColumn("city_title", J.title_case(F.trim("raw_city")))
    return filter_junk_place(pl, "city_title").select("c_custkey", "raw_city")


_EXPLORE_CITY = S.case_map(S.title_case("trim(raw_city)"), lexicon.EXPLORE_CITY_ALIASES, S.title_case("trim(raw_city)"))


@register("normalize_city_explore", S.with_(fx.PLACES_SQL) + f"""
SELECT c_custkey, {_EXPLORE_CITY} AS city FROM places""")
def q_normalize_city_explore(spark, d):
    return fx.places_view(spark, d).select("c_custkey", J.normalize_city_explore("raw_city").alias("city"))


# ---------------------------------------------------------------- salaries

_LO, _HI, _CUR = S.parse_salary_parts("raw_salary")


@register("parse_salary", S.with_(fx.SALARY_TEXTS_SQL, f"""
p AS (SELECT c_custkey, raw_salary, {_LO} AS salary_min, {_HI} AS salary_max, {_CUR} AS currency FROM salaries)""") + f"""
SELECT c_custkey, raw_salary, salary_min, salary_max, currency, {S.salary_avg('salary_min', 'salary_max')} AS salary_avg FROM p""")
def q_parse_salary(spark, d):
    s = fx.salary_texts_view(spark, d).withColumn("p", J.parse_salary("raw_salary"))
    return s.select("c_custkey", "raw_salary", "p.salary_min", "p.salary_max", "p.currency",
                    J.salary_avg("p.salary_min", "p.salary_max").alias("salary_avg"))


@register("detect_currency", S.with_(fx.SALARY_TEXTS_SQL) + """
SELECT c_custkey, CASE WHEN contains(upper(raw_salary), '$') OR contains(upper(raw_salary), 'USD') THEN 'USD'
  WHEN contains(upper(raw_salary), '£') OR contains(upper(raw_salary), 'GBP') THEN 'GBP'
  WHEN contains(upper(raw_salary), 'CHF') THEN 'CHF' ELSE 'EUR' END AS currency FROM salaries""")
def q_detect_currency(spark, d):
    return fx.salary_texts_view(spark, d).select("c_custkey", J.detect_currency("raw_salary").alias("currency"))


@register("salary_avg", S.with_(P) + f"""
SELECT posting_id, {S.salary_avg('salary_min', 'CAST(NULL AS DOUBLE)')} AS salary_avg_min_only,
       {S.salary_avg('salary_min', 'salary_max')} AS salary_avg,
       CASE WHEN (salary_min + salary_max) / 2 >= 1000 AND (salary_min + salary_max) / 2 <= 200000
            THEN (salary_min + salary_max) / 2 END AS salary_avg_explore
FROM postings""")
def q_salary_avg(spark, d):
    p = _p(spark, d)
    return p.select("posting_id", J.salary_avg("salary_min", F.lit(None).cast("double")).alias("salary_avg_min_only"),
                    J.salary_avg("salary_min", "salary_max").alias("salary_avg"),
                    J.salary_avg_explore("salary_min", "salary_max").alias("salary_avg_explore"))


# ---------------------------------------------------------------- contracts


@register("normalize_contract", S.with_(fx.CONTRACT_TEXTS_SQL) + f"""
SELECT o_orderkey, raw_contract, {S.normalize_contract('raw_contract')} AS contract_type,
       {S.normalize_contract('raw_contract', lexicon.EXPLORE_CONTRACT_MAP)} AS contract_explore FROM contracts""")
def q_normalize_contract(spark, d):
    c = fx.contract_texts_view(spark, d)
    return c.select("o_orderkey", "raw_contract", J.normalize_contract("raw_contract").alias("contract_type"),
                    J.normalize_contract("raw_contract", lexicon.EXPLORE_CONTRACT_MAP).alias("contract_explore"))


@register("contract_label_exact", S.with_(fx.CONTRACT_TEXTS_SQL) + f"""
SELECT o_orderkey, {S.contract_label_exact('raw_contract')} AS label FROM contracts""")
def q_contract_label_exact(spark, d):
    return fx.contract_texts_view(spark, d).select("o_orderkey", J.contract_label_exact("raw_contract").alias("label"))


@register("contract_label_substr", S.with_(fx.CONTRACT_TEXTS_SQL) + f"""
SELECT o_orderkey, {S.contract_label_substr('raw_contract')} AS label FROM contracts""")
def q_contract_label_substr(spark, d):
    return fx.contract_texts_view(spark, d).select("o_orderkey", J.contract_label_substr("raw_contract").alias("label"))


INFER_STAGE = ["les", "the"]
INFER_ALT = ["und", "que"]
_DOC_CONTRACTS = ["cdi", None, "cdd", "freelance", " CDI "]


def _infer_sql(c: str, text: str) -> str:
    alt, stage = S.has_words(text, INFER_ALT), S.has_words(text, INFER_STAGE)
    return (f"CASE WHEN {c} IS NULL OR {c} IN ('CDI', 'CDD') THEN CASE WHEN {alt} THEN 'Alternance' "
            f"WHEN {stage} THEN 'Stage' ELSE {c} END ELSE {c} END")


@register("infer_contract", S.with_(f"""
d AS (SELECT doc_id, lang AS title, text AS description,
             {S.normalize_contract(f"CAST({fx._sql_list(_DOC_CONTRACTS)} AS VARCHAR[])[doc_id % 5 + 1]")} AS c FROM documents)""") + f"""
SELECT doc_id, {_infer_sql('c', "COALESCE(title, '') || ' ' || COALESCE(description, '')")} AS contract_type FROM d""")
def q_infer_contract(spark, d):
    docs = fx.load(spark, d, "documents")
    raw = F.element_at(F.array(*[F.lit(x).cast("string") for x in _DOC_CONTRACTS]), (F.col("doc_id") % 5 + 1).cast("int"))
    c = J.normalize_contract(raw)
    return docs.select("doc_id", J.infer_contract(c, F.col("lang"), F.col("text"), INFER_STAGE, INFER_ALT).alias("contract_type"))


@register("contract_inference_counts", S.with_(f"""
d AS (SELECT doc_id, lang AS title, text AS description,
             {S.normalize_contract(f"CAST({fx._sql_list(_DOC_CONTRACTS)} AS VARCHAR[])[doc_id % 5 + 1]")} AS c FROM documents)""", f"""
i AS (SELECT {_infer_sql('c', "COALESCE(title, '') || ' ' || COALESCE(description, '')")} AS contract_type FROM d)""") + """
SELECT CAST(COUNT_IF(contract_type = 'Stage') AS BIGINT) AS n_stage, CAST(COUNT_IF(contract_type = 'Alternance') AS BIGINT) AS n_alternance,
       CAST(COUNT_IF(contract_type IS NULL) AS BIGINT) AS n_missing FROM i""")
def q_contract_inference_counts(spark, d):
    inferred = q_infer_contract(spark, d)
    ct = F.col("contract_type")
    return inferred.agg(F.count_if(ct == "Stage").alias("n_stage"), F.count_if(ct == "Alternance").alias("n_alternance"),
                        F.count_if(ct.isNull()).alias("n_missing"))


# ---------------------------------------------------------------- dates and time parts


@register("normalize_date", S.with_(fx.DATE_TEXTS_SQL) + """
SELECT event_id, raw_date, epoch_us(TRY_CAST(raw_date AS TIMESTAMPTZ)) AS published_us FROM dates""")
def q_normalize_date(spark, d):
    t = fx.date_texts_view(spark, d)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return t.select("event_id", "raw_date",
                    F.timestamp_diff("MICROSECOND", epoch, J.normalize_date("raw_date")).alias("published_us"))


_AS_OF = f"TIMESTAMP '{fx.TEST_AS_OF}'"
_AGE = f"(epoch_us({_AS_OF}) - epoch_us(published_at))"


@register("publication_parts", S.with_(E) + f"""
SELECT posting_id, CAST(published_at AS DATE) AS date, CAST(hour(published_at) AS INTEGER) AS hour,
       CAST(isodow(published_at) - 1 AS INTEGER) AS weekday, strftime(published_at, '%Y-%m') AS month,
       [{', '.join(S.q(x) for x in lexicon.WEEKDAY_FR)}][isodow(published_at)] AS weekday_label
FROM eposts""")
def q_publication_parts(spark, d):
    e = _e(spark, d)
    return e.select("posting_id", J.publication_date("published_at").alias("date"),
                    J.publication_hour("published_at").alias("hour"),
                    J.publication_weekday("published_at").alias("weekday"),
                    J.publication_month("published_at").alias("month"),
                    J.weekday_label_fr(J.publication_weekday("published_at")).alias("weekday_label"))


@register("age_days", S.with_(E) + f"""
SELECT posting_id, {_AGE} / 86400000000 AS age_days, CAST(FLOOR({_AGE} / 86400000000) AS BIGINT) AS age_whole_days,
       {S.age_bucket(f'({_AGE} / 86400000000)')} AS age_bucket
FROM eposts""")
def q_age_days(spark, d):
    e = _e(spark, d)
    a = J.age_days("published_at", fx.TEST_AS_OF)
    return e.select("posting_id", a.alias("age_days"), J.age_whole_days("published_at", fx.TEST_AS_OF).alias("age_whole_days"),
                    J.age_bucket(a).alias("age_bucket"))


# ---------------------------------------------------------------- text search


@register("extract_skills_text", f"""
SELECT doc_id, {S.extract_skills_text('text', fx.TEST_SKILLS)} AS tech_stack FROM documents""")
def q_extract_skills_text(spark, d):
    return fx.load(spark, d, "documents").select("doc_id", J.extract_skills_text("text", fx.TEST_SKILLS).alias("tech_stack"))


@register("text_search", S.with_(DOCS) + f"""
SELECT posting_id, CAST(length({S.blob()}) AS INTEGER) AS blob_chars, {S.has_any(S.blob(), fx.TEST_GENAI)} AS has_any_keyword,
       {S.has_word(S.blob(), 'the')} AS has_word_the, {S.has_words(S.blob(), ['und', 'que'])} AS has_any_word
FROM docs""")
def q_text_search(spark, d):
    docs = _d(spark, d)
    blob = J.text_blob("description", "tech_stack")
    return docs.select("posting_id", F.length(blob).alias("blob_chars"),
                       J.has_any_keyword(blob, fx.TEST_GENAI).alias("has_any_keyword"),
                       J.has_word(blob, "the").alias("has_word_the"),
                       J.has_any_keyword(blob, ["und", "que"], match="word").alias("has_any_word"))


@register("detect_work_mode", S.with_(DOCS) + f"""
SELECT posting_id, {S.work_mode("COALESCE(description, '') || ' ' || COALESCE(title, '')", fx.TEST_WORK_MODES)} AS work_mode FROM docs""")
def q_detect_work_mode(spark, d):
    docs = _d(spark, d)
    return docs.select("posting_id", J.detect_work_mode(J.work_mode_text("description", "title"), fx.TEST_WORK_MODES).alias("work_mode"))


@register("split_skills", S.with_(P) + f"""
SELECT posting_id, array_to_string({S.split_skills('tech_stack')}, '|') AS skills,
       CAST(len({S.split_skills('tech_stack', lower=True)}) AS INTEGER) AS n_skills FROM postings""")
def q_split_skills(spark, d):
    p = _p(spark, d)
    return p.select("posting_id", F.array_join(J.split_skills("tech_stack"), "|").alias("skills"),
                    F.size(J.split_skills("tech_stack", lower=True)).alias("n_skills"))


@register("is_filled_norm_key", S.with_(P) + f"""
SELECT posting_id, {S.is_filled('tech_stack')} AS tech_stack_filled, {S.is_filled('salary_avg')} AS salary_filled,
       {S.is_filled('description')} AS description_filled, lower(trim(COALESCE(company, ''))) AS company_key
FROM postings""")
def q_is_filled_norm_key(spark, d):
    p = _p(spark, d)
    return p.select("posting_id", J.is_filled("tech_stack").alias("tech_stack_filled"),
                    J.is_filled("salary_avg").alias("salary_filled"), J.is_filled("description").alias("description_filled"),
                    J.norm_key("company").alias("company_key"))


@register("truncate_text", """
SELECT doc_id, CAST(length(substring(text, 1, 5000)) AS INTEGER) AS n_chars_kept, substring(text, 1, 5000) = text AS whole FROM documents""")
def q_truncate_text(spark, d):
    docs = fx.load(spark, d, "documents")
    t = J.truncate_text("text", lexicon.DESCRIPTION_MAX_CHARS)
    return docs.select("doc_id", F.length(t).alias("n_chars_kept"), (t == F.col("text")).alias("whole"))


@register("enrich_coverage", S.with_(DOCS) + """
SELECT COUNT(*) AS n_rows, CAST(COUNT_IF(tech_stack <> '') AS BIGINT) AS n_with_skills, COUNT_IF(tech_stack <> '') * 100 / COUNT(*) AS pct
FROM docs""")
def q_enrich_coverage(spark, d):
    from jobsift.operators.aggs import pct
    docs = _d(spark, d)
    return docs.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("tech_stack") != "").alias("n_with_skills"),
                    pct(F.col("tech_stack") != "").alias("pct"))
