"""Registered queries for cleaning, dedup, filters, lookups, profiling, governance, sort/limit."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsift import lexicon
from jobsift import functions as J
from jobsift.operators import clean, filters, governance, lookups, profile
from jobsift.plans import explore, fixtures as fx, sqltext as S
from jobsift.plans.registry import SQL, E, P, _e, _p, register
from jobsift.session import scratch_path
from jobsift.sinks.versioned import VersionedTable

POSTING_COLS = ["posting_id", "title", "company", "city", "contract_type", "salary_min", "salary_max", "salary_avg",
                "currency", "description", "category", "published_at", "url", "source", "tech_stack", "collected_at",
                "city_clean"]
_NULLS = " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in POSTING_COLS)

# ---------------------------------------------------------------- dedup


@register("dedup_keep_most_complete", S.with_(P) + f"""
SELECT {', '.join(POSTING_COLS)} FROM (
  SELECT *, ROW_NUMBER() OVER (
    PARTITION BY COALESCE(lower(trim(company)), 'nan'), COALESCE(lower(trim(title)), 'nan'), COALESCE(lower(trim(city)), 'nan')
    ORDER BY {_NULLS}, posting_id) AS rn
  FROM postings) WHERE rn = 1""")
def q_dedup_keep_most_complete(spark, d):
    return clean.dedup_keep_most_complete(_p(spark, d))


@register("dedup_ignoring_collected_at", S.with_(P) + f"""
SELECT {', '.join(POSTING_COLS)} FROM (
  SELECT *, ROW_NUMBER() OVER (
    PARTITION BY lower(trim(COALESCE(title, ''))), lower(trim(COALESCE(company, ''))), lower(trim(COALESCE(city, '')))
    ORDER BY {_NULLS}, posting_id) AS rn
  FROM postings) WHERE rn = 1""")
def q_dedup_ignoring_collected_at(spark, d):
    return clean.dedup_ignoring(_p(spark, d), ignore=("collected_at",))


@register("distinct_rows", S.with_(P) + """
SELECT DISTINCT title, company, city, contract_type, source FROM postings""")
def q_distinct_rows(spark, d):
    return clean.distinct_rows(_p(spark, d).select("title", "company", "city", "contract_type", "source"))


@register("dedup_counts", S.with_(P) + """
SELECT COUNT(*) AS n_before,
       (SELECT COUNT(*) FROM (SELECT DISTINCT title, company, city, contract_type, source FROM postings)) AS n_after_exact,
       COUNT(DISTINCT (COALESCE(lower(trim(company)), 'nan'), COALESCE(lower(trim(title)), 'nan'),
                       COALESCE(lower(trim(city)), 'nan'))) AS n_after
FROM postings""")
def q_dedup_counts(spark, d):
    p = _p(spark, d)
    exact = p.select("title", "company", "city", "contract_type", "source").dropDuplicates().agg(F.count(F.lit(1))).scalar()
    key = F.struct(J.dedup_key_part("company"), J.dedup_key_part("title"), J.dedup_key_part("city"))
    return p.agg(F.count(F.lit(1)).alias("n_before"), F.count_distinct(key).alias("n_after")).select(
        "n_before", exact.alias("n_after_exact"), "n_after")


@register("stringify_complex", """
SELECT doc_id, to_json(list_filter([CASE WHEN regexp_matches(text, '(?i)(^|[^\\p{L}\\p{N}_])und([^\\p{L}\\p{N}_]|$)') THEN 'Und' END,
                                    CASE WHEN regexp_matches(text, '(?i)(^|[^\\p{L}\\p{N}_])que([^\\p{L}\\p{N}_]|$)') THEN 'Que' END],
                                   lambda s: s IS NOT NULL))::VARCHAR AS skills FROM documents""")
def q_stringify_complex(spark, d):
    docs = fx.load(spark, d, "documents").select("doc_id", J.extract_skills("text", ["Und", "Que"]).alias("skills"))
    return clean.stringify_complex(docs)


# ---------------------------------------------------------------- shaping and the whole cleaning job

PART_SKILLS = ["Standard", "Medium", "Promo", "Large", "Small", "Economy"]
API_SOURCES = ("AUTOMOBILE", "BUILDING")
THIRD_SOURCES = ("FURNITURE", "HOUSEHOLD")
SCRAPED_SOURCES = ("MACHINERY",)
CLEAN_AS_OF = fx.ORDERS_AS_OF


def api_shape(p: DataFrame) -> DataFrame:
    """Postings as the API's raw records."""
    return p.select(
        "title", F.struct(F.col("company").alias("display_name")).alias("company"),
        F.struct(F.col("city").alias("display_name")).alias("location"), "contract_type", "salary_min", "salary_max",
        F.col("tech_stack").alias("description"), F.col("published_at").cast("string").alias("created"),
        F.col("url").alias("redirect_url"), F.col("posting_id").cast("string").alias("id"))


def raw_slices(spark, d) -> dict[str, DataFrame]:
    """The postings view split by market segment into three sources, each in its own raw shape.

    The view is written once to the shared folder and the three sources scan it,
    as three raw feeds would be scanned, instead of recomputing its joins three times.
    """
    from jobsift.session import materialize
    p = materialize(_p(spark, d), "postings")
    k = lambda c: F.floor(F.col(c) / 1000).cast("string")
    api = api_shape(p.filter(F.col("source").isin(*API_SOURCES)))
    third = p.filter(F.col("source").isin(*THIRD_SOURCES)).select(
        F.col("title").alias("job_title"), F.col("company").alias("entreprise"), F.col("city").alias("ville"),
        F.col("contract_type").alias("type_contrat"),
        F.concat(k("salary_min"), F.lit("k-"), k("salary_max"), F.lit("k€")).alias("salaire"),
        F.col("published_at").cast("string").alias("date_publication"), F.col("url").alias("link"))
    scraped = p.filter(F.col("source").isin(*SCRAPED_SOURCES)).select(
        "title", "company", F.col("city").alias("location"), "contract_type",
        F.concat(F.floor("salary_avg").cast("string"), F.lit(" EUR")).alias("salary"), "url",
        F.col("tech_stack").alias("description"))
    return {"api": api, "third": third, "scraped": scraped}


def _in(values) -> str:
    return "(" + ", ".join(S.q(v) for v in values) + ")"


def _norm_sql(src: str, title, company, city, contract, smin, smax, currency, desc, published, url, source_id) -> str:
    text = f"COALESCE({title}, '') || ' ' || COALESCE({desc}, '')"
    alt = S.has_words(text, lexicon.ALTERNANCE_WORDS)
    stage = S.has_words(text, lexicon.STAGE_WORDS)
    c = S.normalize_contract(contract)
    inferred = (f"CASE WHEN ({c}) IS NULL OR ({c}) IN ('CDI', 'CDD') THEN CASE WHEN {alt} THEN 'Alternance' "
                f"WHEN {stage} THEN 'Stage' ELSE {c} END ELSE {c} END")
    return (f"SELECT {title} AS title, {company} AS company, {S.normalize_city(city)} AS city, {inferred} AS contract_type, "
            f"{smin} AS salary_min, {smax} AS salary_max, {S.salary_avg(smin, smax)} AS salary_avg, {currency} AS currency, "
            f"{desc} AS description, CAST(NULL AS VARCHAR) AS category, TRY_CAST({published} AS TIMESTAMP) AS published_at, "
            f"{url} AS url, '{src}' AS source, TIMESTAMP '{CLEAN_AS_OF}' AS collected_at, CAST(NULL AS VARCHAR) AS contract_time, "
            f"{source_id} AS source_id, CAST(NULL AS VARCHAR) AS remote")


_THIRD_SAL = ("CAST(CAST(FLOOR(salary_min / 1000) AS BIGINT) AS VARCHAR) || 'k-' || "
              "CAST(CAST(FLOOR(salary_max / 1000) AS BIGINT) AS VARCHAR) || 'k€'")
_SCR_SAL = "CAST(CAST(FLOOR(salary_avg) AS BIGINT) AS VARCHAR) || ' EUR'"
_T_LO, _T_HI, _T_CUR = S.parse_salary_parts("raw_salary")
CLEAN_COLS = ["title", "company", "city", "contract_type", "salary_min", "salary_max", "salary_avg", "currency",
              "description", "category", "published_at", "url", "source", "collected_at", "contract_time", "source_id",
              "remote"]
_CLEAN_NULLS = " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in CLEAN_COLS)
_CLEAN_ORDER = ", ".join(f"{c} NULLS FIRST" for c in CLEAN_COLS)

BUILD_CLEAN_SQL = S.with_(P, f"""
n_api AS ({_norm_sql('api', 'title', 'company', 'city', 'contract_type', 'salary_min', 'salary_max', "'EUR'",
                     'tech_stack', 'CAST(published_at AS VARCHAR)', 'url', 'CAST(posting_id AS VARCHAR)')}
          FROM postings WHERE source IN {_in(API_SOURCES)})""", f"""
t_raw AS (SELECT *, {_THIRD_SAL} AS raw_salary FROM postings WHERE source IN {_in(THIRD_SOURCES)})""", f"""
n_third AS ({_norm_sql('third', 'title', 'company', 'city', 'contract_type', _T_LO, _T_HI, _T_CUR,
                       'CAST(NULL AS VARCHAR)', 'CAST(published_at AS VARCHAR)', 'url', 'CAST(NULL AS VARCHAR)')} FROM t_raw)""", f"""
s_raw AS (SELECT *, {_SCR_SAL} AS raw_salary FROM postings WHERE source IN {_in(SCRAPED_SOURCES)})""", f"""
n_scraped AS ({_norm_sql('scraped', 'title', 'company', 'city', 'contract_type', _T_LO, _T_HI, _T_CUR,
                         'tech_stack', 'CAST(NULL AS VARCHAR)', 'url', 'CAST(NULL AS VARCHAR)')} FROM s_raw)""", """
u AS (SELECT * FROM n_api UNION ALL SELECT * FROM n_third UNION ALL SELECT * FROM n_scraped)""", f"""
dd AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (
         PARTITION BY COALESCE(lower(trim(company)), 'nan'), COALESCE(lower(trim(title)), 'nan'), COALESCE(lower(trim(city)), 'nan')
         ORDER BY {_CLEAN_NULLS}, {_CLEAN_ORDER}) AS rn FROM u) WHERE rn = 1)""") + f"""
SELECT title, company, city, contract_type, salary_min, salary_max, salary_avg, currency, description, category,
       published_at, url, source, {S.extract_skills_text('description', PART_SKILLS)} AS tech_stack, collected_at
FROM dd"""


def _ntz(df: DataFrame) -> DataFrame:
    """Timestamps as zone-free wall clock, so results do not depend on the session zone."""
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if t == "timestamp" else F.col(c) for c, t in df.dtypes])


@register("build_clean", BUILD_CLEAN_SQL)
def q_build_clean(spark, d):
    return _ntz(clean.build_clean(raw_slices(spark, d), as_of=CLEAN_AS_OF, skills=PART_SKILLS))


_UNION_SQL = S.with_(P) + f"""
SELECT title, company, city, contract_type, salary_min, salary_max, CAST(NULL AS DOUBLE) AS salary_avg,
       CAST(NULL AS VARCHAR) AS currency, tech_stack AS description, CAST(NULL AS VARCHAR) AS category,
       CAST(published_at AS VARCHAR) AS published_at, url, 'api' AS source, CAST(NULL AS VARCHAR) AS tech_stack,
       CAST(NULL AS TIMESTAMP) AS collected_at
FROM postings WHERE source IN {_in(API_SOURCES)}
UNION ALL
SELECT title, company, city, contract_type, NULL, NULL, NULL, NULL, NULL, NULL, CAST(published_at AS VARCHAR), url, 'third',
       NULL, NULL
FROM postings WHERE source IN {_in(THIRD_SOURCES)}
UNION ALL
SELECT title, company, city, contract_type, NULL, NULL, NULL, NULL, tech_stack, NULL, NULL, url, 'scraped', NULL, NULL
FROM postings WHERE source IN {_in(SCRAPED_SOURCES)}"""


@register("union_sources", _UNION_SQL)
def q_union_sources(spark, d):
    maps = clean.SOURCE_MAPS
    renamed = [clean.rename_to_target(df, maps[kind], kind) for kind, df in raw_slices(spark, d).items()]
    return clean.project_target(clean.union_sources(renamed))


@register("flatten_struct", S.with_(P) + f"""
SELECT title, company AS "company.display_name", city AS "location.display_name", posting_id
FROM postings""")
def q_flatten_struct(spark, d):
    p = _p(spark, d)
    nested = p.select("title", F.struct(F.col("company").alias("display_name")).alias("company"),
                      F.struct(F.col("city").alias("display_name")).alias("location"), "posting_id")
    return clean.flatten_struct(nested)


# ---------------------------------------------------------------- filters


@register("filter_postings", S.with_(P) + """
SELECT posting_id, city_clean, contract_type, salary_avg FROM postings
WHERE city_clean = 'NATION_3' AND contract_type = 'CDI' AND (salary_avg IS NULL OR salary_avg BETWEEN 100000 AND 300000)""")
def q_filter_postings(spark, d):
    out = filters.filter_postings(_p(spark, d), city="NATION_3", contract="CDI", salary_range_k=(100, 300))
    return out.select("posting_id", "city_clean", "contract_type", "salary_avg")


@register("filter_has_salary", S.with_(P) + """
SELECT posting_id, salary_avg FROM postings WHERE salary_avg IS NOT NULL""")
def q_filter_has_salary(spark, d):
    return filters.filter_has_salary(_p(spark, d)).select("posting_id", "salary_avg")


@register("filter_has_date", S.with_(E) + """
SELECT posting_id, published_at FROM eposts WHERE published_at IS NOT NULL""")
def q_filter_has_date(spark, d):
    return filters.filter_has_date(_e(spark, d)).select("posting_id", "published_at")


@register("filter_has_geo", S.with_(P, fx.NATION_COORDS_SQL) + """
SELECT posting_id, p.city_clean, lat, lon FROM postings p LEFT JOIN coords c ON p.city_clean = c.city_clean
WHERE lat IS NOT NULL AND lon IS NOT NULL""")
def q_filter_has_geo(spark, d):
    j = lookups.join_city_coords(_p(spark, d), fx.nation_coords(spark, d))
    return filters.filter_has_geo(j).select("posting_id", "city_clean", "lat", "lon")


@register("filter_outlier_salary", S.with_(P) + """
SELECT posting_id, CASE WHEN salary_avg > 50000 AND salary_avg < 400000 THEN salary_avg END AS salary_avg FROM postings""")
def q_filter_outlier_salary(spark, d):
    return filters.filter_outlier_salary(_p(spark, d), low=50000, high=400000).select("posting_id", "salary_avg")


@register("filter_min_count", S.with_(P) + """
SELECT company, COUNT(*) AS count FROM postings GROUP BY company HAVING COUNT(*) >= 15""")
def q_filter_min_count(spark, d):
    grouped = _p(spark, d).groupBy("company").agg(F.count(F.lit(1)).alias("count"))
    return filters.filter_min_count(grouped, 15)


@register("filter_in_top", S.with_(P, """
t AS (SELECT company FROM postings WHERE company IS NOT NULL GROUP BY company ORDER BY COUNT(*) DESC, company LIMIT 50)""") + """
SELECT posting_id, company FROM postings WHERE company IN (SELECT company FROM t)""")
def q_filter_in_top(spark, d):
    return filters.filter_in_top(_p(spark, d), "company", 50).select("posting_id", "company")


@register("filter_options", S.with_(P) + """
SELECT DISTINCT city_clean FROM postings WHERE city_clean IS NOT NULL""")
def q_filter_options(spark, d):
    return filters.filter_options(_p(spark, d), "city_clean")


# ---------------------------------------------------------------- lookups


@register("join_city_coords", S.with_(P, fx.NATION_COORDS_SQL) + """
SELECT posting_id, p.city_clean, lat, lon FROM postings p LEFT JOIN coords c ON p.city_clean = c.city_clean""")
def q_join_city_coords(spark, d):
    return lookups.join_city_coords(_p(spark, d), fx.nation_coords(spark, d)).select("posting_id", "city_clean", "lat", "lon")


@register("join_city_population", S.with_(P, fx.NATION_POP_SQL) + """
SELECT posting_id, p.city, population FROM postings p JOIN pop ON p.city = pop.city""")
def q_join_city_population(spark, d):
    return lookups.join_city_population(_p(spark, d), fx.nation_population(spark, d)).select("posting_id", "city", "population")


@register("join_calendar_zero_fill", S.with_(E, """
c AS (SELECT CAST(hour(published_at) AS INTEGER) AS hour, COUNT(*) AS n FROM eposts GROUP BY 1)""", """
dim AS (SELECT CAST(range AS INTEGER) AS hour FROM range(48))""") + """
SELECT dim.hour, CAST(COALESCE(c.n, 0) AS BIGINT) AS n FROM dim LEFT JOIN c ON dim.hour = c.hour""")
def q_join_calendar_zero_fill(spark, d):
    e = _e(spark, d)                      # the domain is wider than a day: its second half has no row
    counts = e.groupBy(J.publication_hour("published_at").alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    return lookups.zero_fill(counts, lookups.calendar_dim(spark, "hour", 48), "hour", "n")


@register("join_global_scalar", S.with_(P, f"""
g AS (SELECT {S.mean_money('salary_avg')} AS global_mean FROM postings)""") + f"""
SELECT source, {S.mean_money('salary_avg')} AS salary_mean, ANY_VALUE(global_mean) AS global_mean
FROM postings, g GROUP BY source""")
def q_join_global_scalar(spark, d):
    from jobsift.operators.aggs import money_mean
    p = _p(spark, d)
    per = p.groupBy("source").agg(money_mean("salary_avg").alias("salary_mean"))
    return lookups.with_global_scalar(per, p.agg(money_mean("salary_avg")), "global_mean")


# ---------------------------------------------------------------- profiling and shaping


_MISSING_UNION = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {S.pct(f'{c} IS NULL')} AS missing_pct FROM postings" for c in POSTING_COLS)


@register("missing_profile", S.with_(P, f"m AS ({_MISSING_UNION})") + """
SELECT column_name, missing_pct FROM m WHERE missing_pct > 0""")
def q_missing_profile(spark, d):
    return profile.missing_profile(_p(spark, d))


@register("drop_sparse_columns", S.with_(P) + f"""
SELECT {', '.join(c for c in POSTING_COLS if c not in ('description', 'category'))} FROM postings""")
def q_drop_sparse_columns(spark, d):
    return profile.drop_sparse_columns(_p(spark, d))


@register("fill_constants", S.with_(P) + """
SELECT posting_id, COALESCE(description, '') AS description, COALESCE(tech_stack, 'Non précisé') AS tech_stack,
       COALESCE(category, 'Autre') AS category FROM postings""")
def q_fill_constants(spark, d):
    out = profile.fill_constants(_p(spark, d), {"description": "", "tech_stack": "Non précisé", "category": "Autre"})
    return out.select("posting_id", "description", "tech_stack", "category")


@register("truncate_for_export", """
SELECT doc_id, substring(text, 1, 5000) AS text, CAST(n_chars AS VARCHAR) AS n_chars FROM documents""")
def q_truncate_for_export(spark, d):
    docs = fx.load(spark, d, "documents").select("doc_id", "text", "n_chars")
    return profile.truncate_for_export(docs, text_cols=("text",), n=lexicon.DESCRIPTION_MAX_CHARS, date_cols=("n_chars",))


# ---------------------------------------------------------------- governance


@register("retention_filter", S.with_(P) + f"""
SELECT posting_id, collected_at FROM postings WHERE collected_at >= TIMESTAMP '{fx.ORDERS_AS_OF}' - INTERVAL 90 DAY""")
def q_retention_filter(spark, d):
    return governance.retention_filter(_p(spark, d), 90, fx.ORDERS_AS_OF).select("posting_id", "collected_at")


@register("takedown", S.with_(P) + """
SELECT posting_id, company FROM postings WHERE company NOT IN (SELECT c_name FROM customer WHERE c_acctbal < 0)""")
def q_takedown(spark, d):
    req = fx.load(spark, d, "customer").filter(F.col("c_acctbal") < 0).select(F.col("c_name").alias("company"))
    return governance.takedown(_p(spark, d), req).select("posting_id", "company")


_MONTH = "strftime(collected_at, '%Y-%m')"


def _store(spark, d, name) -> VersionedTable:
    """The postings as a versioned table of months, in a scratch folder: its version 1."""
    store = VersionedTable(spark, scratch_path(spark, name), "collected_at", "yyyy-MM")
    store.overwrite(_p(spark, d).select("posting_id", "company", "title", "collected_at").repartition("title"))
    return store


@register("takedown_versions", S.with_(P) + f"""
, r AS (SELECT *, company IN (SELECT c_name FROM customer WHERE c_acctbal < 0) AS gone FROM postings)
SELECT 1 AS version, {_MONTH} AS month, COUNT(*) AS n, COUNT(DISTINCT company) AS companies, CAST(SUM(posting_id) AS BIGINT) AS ids FROM r GROUP BY 2
UNION ALL
SELECT 2, {_MONTH}, COUNT(*), COUNT(DISTINCT company), CAST(SUM(posting_id) AS BIGINT) FROM r WHERE NOT gone GROUP BY 2""")
def q_takedown_versions(spark, d):
    """Remove, commit, and read both versions."""
    store = _store(spark, d, "takedown")
    req = fx.load(spark, d, "customer").filter(F.col("c_acctbal") < 0).select(F.col("c_name").alias("company"))
    governance.takedown_commit(store, req)
    out = None
    for version in store.versions():
        rows = store.read(version)
        per_company = rows.groupBy(F.date_format("collected_at", "yyyy-MM").alias("month"), "company").agg(F.count("*").alias("n"), F.sum("posting_id").alias("ids"))
        one = per_company.groupBy("month").agg(F.sum("n").alias("n"), F.count("company").alias("companies"), F.sum("ids").alias("ids"))
        one = one.select(F.lit(version).alias("version"), "month", "n", "companies", "ids")
        out = one if out is None else out.unionByName(one)
    return out


@register("retention_purge", S.with_(P) + f"""
SELECT posting_id, collected_at FROM postings WHERE collected_at >= TIMESTAMP '{fx.ORDERS_AS_OF}' - INTERVAL 900 DAY""")
def q_retention_purge(spark, d):
    """Purge by partition, and read what the new version holds."""
    store = _store(spark, d, "purge")
    governance.retention_purge(store, 900, fx.ORDERS_AS_OF)
    return store.read().select("posting_id", "collected_at")


# ---------------------------------------------------------------- sort / limit


@register("top_k_by_value", S.with_(P) + """
SELECT posting_id, salary_avg FROM postings WHERE salary_avg IS NOT NULL ORDER BY salary_avg DESC, posting_id LIMIT 10""")
def q_top_k_by_value(spark, d):
    return (_p(spark, d).filter(F.col("salary_avg").isNotNull()).select("posting_id", "salary_avg")
            .orderBy(F.desc("salary_avg"), F.asc("posting_id")).limit(10))


@register("limit_preview", S.with_(P) + """
SELECT posting_id, title, company FROM postings ORDER BY posting_id LIMIT 5""")
def q_limit_preview(spark, d):
    return _p(spark, d).select("posting_id", "title", "company").orderBy("posting_id").limit(5)


@register("detail_table_page", S.with_(P) + """
SELECT title, company, city_clean, contract_type, salary_avg, tech_stack FROM postings
WHERE contract_type = 'CDI' ORDER BY salary_avg DESC NULLS LAST, company, title LIMIT 12 OFFSET 24""")
def q_detail_table_page(spark, d):
    from jobsift.plans.overview import detail_table
    return detail_table(_p(spark, d), order_by=[F.desc_nulls_last("salary_avg"), "company", "title"], page=2,
                        where="contract_type = 'CDI'")


@register("salary_imputed_describe", S.with_(P, f"""
m AS (SELECT title, {S.median_money('salary_avg')} AS med FROM postings WHERE title IS NOT NULL GROUP BY title)""", """
i AS (SELECT p.title, COALESCE(p.salary_avg, m.med) AS salary_avg FROM postings p LEFT JOIN m ON p.title = m.title)""") + f"""
SELECT title, COUNT(*) AS n, {S.mean_money('salary_avg')} AS mean FROM i GROUP BY title""")
def q_salary_imputed_describe(spark, d):
    from jobsift.operators.aggs import money_mean
    imputed = explore.impute_group_median(_p(spark, d))
    return imputed.groupBy("title").agg(F.count(F.lit(1)).alias("n"), money_mean("salary_avg").alias("mean"))


# ---------------------------------------------------------------- more shaping and lookups


@register("cast_types", S.with_(P) + """
SELECT posting_id, TRY_CAST(CASE WHEN posting_id % 11 = 0 THEN 'n/a' ELSE CAST(salary_avg AS VARCHAR) END AS DOUBLE) AS salary_avg,
       TRY_CAST(CASE WHEN posting_id % 13 = 0 THEN 'soon' ELSE CAST(published_at AS VARCHAR) END AS TIMESTAMP) AS published_at,
       CAST(title AS VARCHAR) AS title
FROM postings""")
def q_cast_types(spark, d):
    p = _p(spark, d)
    raw = p.select("posting_id",
                   F.when(F.col("posting_id") % 11 == 0, F.lit("n/a")).otherwise(F.col("salary_avg").cast("string")).alias("salary_avg"),
                   F.when(F.col("posting_id") % 13 == 0, F.lit("soon")).otherwise(F.col("published_at").cast("string")).alias("published_at"),
                   "title")
    return _ntz(clean.cast_types(raw))


@register("semi_join_top_keys", S.with_(P, """
t AS (SELECT city FROM postings WHERE city IS NOT NULL GROUP BY city ORDER BY COUNT(*) DESC, city LIMIT 5)""") + """
SELECT posting_id, city FROM postings WHERE city IN (SELECT city FROM t)""")
def q_semi_join_top_keys(spark, d):
    return filters.filter_in_top(_p(spark, d), "city", 5).select("posting_id", "city")



@register("explore_export", S.with_(P) + f"""
SELECT title AS intitule_poste, company AS entreprise, city AS ville, contract_type AS type_contrat,
       salary_min AS salaire_min, salary_max AS salaire_max,
       CASE WHEN (salary_min + salary_max) / 2 >= 1000 AND (salary_min + salary_max) / 2 <= 200000
            THEN (salary_min + salary_max) / 2 END AS salaire_moyen,
       substring(tech_stack, 1, 5000) AS description, CAST(published_at AS VARCHAR) AS date_publication,
       'api' AS source, url
FROM postings""")
def q_explore_export(spark, d):
    return profile.explore_export(_explored(spark, d), n=lexicon.DESCRIPTION_MAX_CHARS)


def _explored(spark, d):
    renamed = profile.explore_rename(api_shape(_p(spark, d)), lexicon.EXPLORE_API_RENAME, source="api")
    return renamed.withColumn("salaire_moyen", J.salary_avg_explore("salaire_min", "salaire_max"))


@register("explore_export_whole", SQL["explore_export"].replace("substring(tech_stack, 1, 5000)", "tech_stack"))
def q_explore_export_whole(spark, d):
    return profile.explore_export(_explored(spark, d))
