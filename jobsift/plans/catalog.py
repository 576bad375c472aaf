"""Registered queries: one per operator, each on a view of the driver's tables,
with the SQL text DuckDB runs for the cross-check.

``QUERIES[name](spark, sf_dir) -> DataFrame``; ``SQL[name] -> str``. A query
without SQL is checked by row count only (non-SQL operators).
"""
from __future__ import annotations

from pyspark.sql import functions as F

from jobsift import lexicon
from jobsift.plans import explore, geo, overview, quality, salary, skills, temporal
from jobsift.plans import fixtures as fx
from jobsift.plans import sqltext as S

from jobsift.plans.registry import DOC_BLOB, DOCS, QUERIES, SQL, E, P, _d, _e, _p, register  # noqa: F401

# ---------------------------------------------------------------- overview page


@register("overview_kpis", S.with_(P) + f"""
SELECT COUNT(*) AS n_rows, {S.mean_money('salary_avg')} AS salary_mean, {S.median_money('salary_avg')} AS salary_median,
       MIN(salary_min) AS salary_min, MAX(salary_max) AS salary_max,
       CAST(COUNT_IF(contract_type = 'CDI') AS BIGINT) AS n_cdi, {S.pct("contract_type = 'CDI'")} AS pct_cdi,
       CAST(COUNT_IF(contract_type = 'Stage') AS BIGINT) AS n_stage, {S.pct("contract_type = 'Stage'")} AS pct_stage,
       CAST(COUNT_IF(contract_type = 'Alternance') AS BIGINT) AS n_alternance, {S.pct("contract_type = 'Alternance'")} AS pct_alternance,
       COUNT(DISTINCT company) AS n_companies, COUNT(DISTINCT city_clean) AS n_cities,
       CAST(COUNT_IF(COALESCE(tech_stack, '') <> '') AS BIGINT) AS n_with_skills
FROM postings""")
def q_overview_kpis(spark, d):
    return overview.overview_kpis(_p(spark, d))


@register("header_stats", S.with_(P) + f"""
SELECT COUNT(*) AS n_rows, COUNT(DISTINCT company) AS n_companies, COUNT(DISTINCT city_clean) AS n_cities,
       {S.mean_money('salary_avg')} AS salary_mean FROM postings""")
def q_header_stats(spark, d):
    return overview.header_stats(_p(spark, d))


@register("salary_histogram", S.with_(P, """
c AS (SELECT CAST(ROUND(salary_avg * 100) AS BIGINT) AS c FROM postings WHERE salary_avg IS NOT NULL)""", """
b AS (SELECT MIN(c) AS lo, MAX(c) AS hi FROM c)""", """
x AS (SELECT CAST(CASE WHEN hi = lo THEN 1 ELSE LEAST(FLOOR((c - lo) * 25 / (hi - lo)) + 1, 25) END AS INTEGER) AS bin, lo, hi
      FROM c, b)""") + """
SELECT bin, (lo * 25 + (bin - 1) * (hi - lo)) / 2500 AS bin_start, (lo * 25 + bin * (hi - lo)) / 2500 AS bin_end,
       COUNT(*) AS n
FROM x GROUP BY bin, lo, hi""")
def q_salary_histogram(spark, d):
    return overview.salary_histogram(_p(spark, d))


_LABEL = S.contract_label_exact("contract_type")


@register("contract_share", S.with_(P, f"""
c AS (SELECT {_LABEL} AS label, COUNT(*) AS n FROM postings GROUP BY 1)""", """
t AS (SELECT label, n, SUM(n) OVER () AS total FROM c)""") + f"""
SELECT CASE WHEN n < total * {lexicon.CONTRACT_SHARE_MIN} THEN 'Autre' ELSE label END AS label, CAST(SUM(n) AS BIGINT) AS n
FROM t GROUP BY 1""")
def q_contract_share(spark, d):
    return overview.contract_share(_p(spark, d))


@register("city_map", S.with_(P, fx.NATION_COORDS_SQL) + f"""
SELECT p.city_clean, MIN(lat) AS lat, MIN(lon) AS lon, COUNT(*) AS n, {S.mean_money('salary_avg')} AS salary_mean
FROM postings p JOIN coords c ON p.city_clean = c.city_clean
WHERE lat IS NOT NULL AND lon IS NOT NULL GROUP BY p.city_clean""")
def q_city_map(spark, d):
    from jobsift.operators.lookups import join_city_coords
    return overview.city_map(join_city_coords(_p(spark, d), fx.nation_coords(spark, d)))


@register("top_skills", S.with_(P) + f"""
SELECT skill, COUNT(*) AS n FROM (SELECT unnest({S.split_skills('tech_stack')}) AS skill FROM postings)
GROUP BY skill ORDER BY n DESC, skill LIMIT 15""")
def q_top_skills(spark, d):
    return overview.top_skills(_p(spark, d))


@register("detail_table", S.with_(P) + """
SELECT title, company, city_clean, contract_type, salary_avg, tech_stack FROM postings""")
def q_detail_table(spark, d):
    return overview.detail_table(_p(spark, d), order_by=["salary_avg"])


# ---------------------------------------------------------------- skills page (documents, test lexicon)


@register("skills_kpis", S.with_(DOCS, f"""
b AS (SELECT {DOC_BLOB} AS blob, tech_stack FROM docs)""") + f"""
SELECT (SELECT COUNT(DISTINCT s) FROM (SELECT unnest({S.split_skills('tech_stack')}) AS s FROM docs)) AS n_distinct_skills,
       {S.pct(S.has_word('blob', 'the'))} AS pct_a, {S.pct(S.has_word('blob', 'und'))} AS pct_b,
       {S.pct(S.has_any('blob', fx.TEST_CLOUD))} AS pct_cloud, {S.pct(S.has_any('blob', fx.TEST_GENAI))} AS pct_genai
FROM b""")
def q_skills_kpis(spark, d):
    return skills.skills_kpis(_d(spark, d), "the", "und", fx.TEST_CLOUD, fx.TEST_GENAI)


@register("power_trio", S.with_(DOCS, f"""
b AS (SELECT {S.has_word(DOC_BLOB, 'the')} AS a, {S.has_word(DOC_BLOB, 'und')} AS s,
             {S.has_any(DOC_BLOB, fx.TEST_CLOUD)} AS c FROM docs)""") + f"""
SELECT combo, pct FROM (
  SELECT {S.pct('a AND s AND c')} AS trio, {S.pct('a AND s')} AS a_b, {S.pct('a AND c')} AS a_cloud, {S.pct('s AND c')} AS b_cloud FROM b
) UNPIVOT (pct FOR combo IN (trio, a_b, a_cloud, b_cloud))""")
def q_power_trio(spark, d):
    return skills.power_trio(_d(spark, d), "the", "und", fx.TEST_CLOUD)


def _kw_values(families: dict) -> str:
    rows = [f"({S.q(fam)}, {S.q(kw)}, {i}, {S.q('(?i)(' + S.re_quote(kw) + ')')})"
            for fam, kws in families.items() for i, kw in enumerate(kws)]
    return "kw(family, keyword, position, pattern) AS (VALUES " + ", ".join(rows) + ")"


def _kw_counts_sql(families: dict) -> str:
    return f"""
counts AS (SELECT family, keyword, CAST(position AS INTEGER) AS position,
                  CAST(COUNT_IF(regexp_matches(b.blob, kw.pattern)) AS BIGINT) AS n
           FROM kw, (SELECT {DOC_BLOB} AS blob FROM docs) b GROUP BY family, keyword, position)"""


_FAM = {"IA Générative": fx.TEST_GENAI, "Traditionnel": fx.TEST_TRADITIONAL}


@register("keyword_family_counts", S.with_(DOCS, _kw_values(_FAM), _kw_counts_sql(_FAM)) + """
SELECT family, keyword, n FROM counts WHERE n > 0""")
def q_keyword_family_counts(spark, d):
    return skills.keyword_family_counts(_d(spark, d), fx.TEST_GENAI, fx.TEST_TRADITIONAL)


_HS = {"Hard Skill": fx.TEST_HARD, "Soft Skill": fx.TEST_SOFT}


@register("hard_vs_soft", S.with_(DOCS, _kw_values(_HS), _kw_counts_sql(_HS)) + """
SELECT kind, keyword, n, rank FROM (
  SELECT family AS kind, keyword, n,
         CAST(ROW_NUMBER() OVER (PARTITION BY family ORDER BY n DESC, position) AS INTEGER) AS rank FROM counts)
WHERE rank <= 8 AND n > 0""")
def q_hard_vs_soft(spark, d):
    return skills.hard_vs_soft(_d(spark, d), fx.TEST_HARD, fx.TEST_SOFT)


@register("cloud_providers", S.with_(DOCS, f"b AS (SELECT {DOC_BLOB} AS blob FROM docs)") + " UNION ALL ".join(
    f"SELECT {S.q(p)} AS provider, CAST(COUNT_IF({S.has_any('blob', kws)}) AS BIGINT) AS n FROM b"
    for p, kws in fx.TEST_PROVIDERS.items()))
def q_cloud_providers(spark, d):
    return skills.cloud_providers(_d(spark, d), fx.TEST_PROVIDERS)


@register("skills_by_contract", S.with_(DOCS, f"""
b AS (SELECT {S.contract_label_substr('contract_type', fx.TEST_CONTRACT_RULES)} AS label, {DOC_BLOB} AS blob FROM docs)""", f"""
sc AS (SELECT skill, COUNT(*) AS n FROM (SELECT unnest({S.split_skills('tech_stack')}) AS skill FROM docs)
       GROUP BY skill ORDER BY n DESC, skill LIMIT 10)""", """
grid AS (SELECT sc.skill, l.label FROM sc, (SELECT DISTINCT label FROM b) l)""", """
hits AS (SELECT sc.skill, b.label, COUNT(*) AS n FROM b JOIN sc ON contains(b.blob, lower(sc.skill)) GROUP BY 1, 2)""") + """
SELECT g.skill, g.label, CAST(COALESCE(h.n, 0) AS BIGINT) AS n FROM grid g LEFT JOIN hits h ON g.skill = h.skill AND g.label = h.label""")
def q_skills_by_contract(spark, d):
    return skills.skills_by_contract(_d(spark, d), 10, fx.TEST_CONTRACT_RULES)


# ---------------------------------------------------------------- salary page


@register("salary_kpis", S.with_(P) + f"""
SELECT {S.mean_money('salary_avg')} AS salary_mean,
       MIN(CASE WHEN salary_avg IS NOT NULL THEN salary_min END) AS salary_min,
       MAX(CASE WHEN salary_avg IS NOT NULL THEN salary_max END) AS salary_max,
       {S.median_money('salary_avg')} AS salary_median, COUNT(salary_avg) * 100 / COUNT(*) AS pct_with_salary
FROM postings""")
def q_salary_kpis(spark, d):
    return salary.salary_kpis(_p(spark, d))


@register("skill_premium", S.with_(P, """
sal AS (SELECT * FROM postings WHERE salary_avg IS NOT NULL)""", f"""
g AS (SELECT {S.mean_money('salary_avg')} AS gm, COUNT(*) AS n_sal FROM sal)""", f"""
top AS (SELECT skill FROM (SELECT unnest({S.split_skills('tech_stack', lower=True)}) AS skill FROM postings)
        GROUP BY skill ORDER BY COUNT(*) DESC, skill LIMIT 20)""", f"""
per_row AS (SELECT salary_avg, unnest(list_distinct({S.split_skills('tech_stack', lower=True)})) AS skill FROM sal)""", f"""
per_skill AS (SELECT skill, COUNT(*) AS n, {S.mean_money('salary_avg')} AS salary_mean FROM per_row
              WHERE skill IN (SELECT skill FROM top) GROUP BY skill HAVING COUNT(*) >= 2)""") + f"""
SELECT {S.title_case('skill')} AS skill, n, salary_mean, (salary_mean - gm) / gm * 100 AS premium
FROM per_skill, g WHERE n_sal >= 3 ORDER BY premium DESC, skill LIMIT 15""")
def q_skill_premium(spark, d):
    from jobsift.session import materialize
    return salary.skill_premium(materialize(_p(spark, d).select("salary_avg", "tech_stack"), "salaries"))   # two narrow columns, read by every pass


@register("salary_by_source", S.with_(P) + f"""
SELECT source, {S.mean_money('salary_avg')} AS salary_mean, {S.median_money('salary_avg')} AS salary_median, COUNT(*) AS n
FROM postings WHERE salary_avg IS NOT NULL GROUP BY source""")
def q_salary_by_source(spark, d):
    return salary.salary_by_source(_p(spark, d))


@register("salary_by_city", S.with_(P) + f"""
SELECT city_clean, {S.mean_money('salary_avg')} AS salary_mean, COUNT(*) AS n
FROM postings WHERE salary_avg IS NOT NULL GROUP BY city_clean HAVING COUNT(*) >= 3
ORDER BY salary_mean DESC, city_clean LIMIT 10""")
def q_salary_by_city(spark, d):
    return salary.salary_by_city(_p(spark, d))


def _box_sql(by_expr: str, by_name: str, source: str, where: str = "TRUE") -> str:
    return f"""
bx_src AS (SELECT {by_expr} AS {by_name}, salary_avg FROM {source} WHERE salary_avg IS NOT NULL AND {where}),
bx_q AS (SELECT {by_name}, COUNT(*) AS n,
                quantile_cont(CAST(ROUND(salary_avg * 100) AS BIGINT), [0.0, 0.25, 0.5, 0.75, 1.0]) AS qs
         FROM bx_src GROUP BY 1),
bx AS (SELECT {by_name}, n, qs[1] / 100 AS min, qs[2] / 100 AS q1, qs[3] / 100 AS median, qs[4] / 100 AS q3,
              qs[5] / 100 AS max, qs[2] / 100 - (qs[4] / 100 - qs[2] / 100) * 1.5 AS lower_fence,
              qs[4] / 100 + (qs[4] / 100 - qs[2] / 100) * 1.5 AS upper_fence FROM bx_q),
bx_w AS (SELECT s.{by_name}, MIN(s.salary_avg) AS whisker_low, MAX(s.salary_avg) AS whisker_high
         FROM bx_src s JOIN bx ON s.{by_name} = bx.{by_name}
         WHERE s.salary_avg BETWEEN bx.lower_fence AND bx.upper_fence GROUP BY 1)
SELECT bx.*, bx_w.whisker_low, bx_w.whisker_high FROM bx LEFT JOIN bx_w ON bx.{by_name} = bx_w.{by_name}"""


@register("salary_box", "WITH " + P.strip() + "," + _box_sql(S.contract_label_substr("contract_type"), "contract_label", "postings"))
def q_salary_box(spark, d):
    return salary.salary_box(_p(spark, d))


@register("salary_box_by_title", S.with_(P, """
t AS (SELECT title FROM postings WHERE salary_avg IS NOT NULL AND title IS NOT NULL GROUP BY title
      HAVING COUNT(*) >= 3 ORDER BY COUNT(*) DESC, title LIMIT 12)""").rstrip() + ","
          + _box_sql("title", "title", "postings", "title IN (SELECT title FROM t)"))
def q_salary_box_by_title(spark, d):
    return salary.salary_box_by_title(_p(spark, d))


# ---------------------------------------------------------------- geography page

HOME = "NATION_1"


@register("geo_kpis", S.with_(P, """
cc AS (SELECT city_clean, COUNT(*) AS n FROM postings WHERE city_clean IS NOT NULL GROUP BY 1)""", f"""
w AS (SELECT *, {S.work_mode("COALESCE(description, '') || ' ' || COALESCE(title, '')")} AS work_mode FROM postings)""") + f"""
SELECT COUNT(DISTINCT city_clean) AS n_cities,
       (SELECT city_clean FROM cc ORDER BY n DESC, city_clean LIMIT 1) AS top_city,
       {S.pct("work_mode = 'Full Remote'")} AS pct_remote, {S.pct("work_mode = 'Hybride'")} AS pct_hybrid,
       {S.pct(f"city_clean = {S.q(HOME)}")} AS pct_home
FROM w""")
def q_geo_kpis(spark, d):
    return geo.geo_kpis(_p(spark, d), HOME)


@register("work_mode_salary", S.with_(DOCS) + f"""
SELECT work_mode, COUNT(*) AS n, {S.mean_money('salary_avg')} AS salary_mean FROM (
  SELECT *, {S.work_mode("COALESCE(description, '') || ' ' || COALESCE(title, '')", fx.TEST_WORK_MODES)} AS work_mode FROM docs)
GROUP BY work_mode""")
def q_work_mode_salary(spark, d):
    return geo.work_mode_salary(_d(spark, d), fx.TEST_WORK_MODES)


@register("hub_density", S.with_(P, fx.NATION_POP_SQL, """
t AS (SELECT city_clean AS city, COUNT(*) AS n FROM postings WHERE city_clean IS NOT NULL GROUP BY 1
      ORDER BY n DESC, city LIMIT 15)""") + """
SELECT t.city, n, population, n / population * 100000 AS per_100k FROM t JOIN pop ON t.city = pop.city""")
def q_hub_density(spark, d):
    return geo.hub_density(_p(spark, d), fx.nation_population(spark, d))


@register("top_cities", S.with_(P) + """
SELECT city_clean, COUNT(*) AS n FROM postings WHERE city_clean IS NOT NULL GROUP BY 1 ORDER BY n DESC, city_clean LIMIT 10""")
def q_top_cities(spark, d):
    return geo.top_cities(_p(spark, d))


@register("city_share_other", S.with_(P, """
k AS (SELECT city_clean FROM postings WHERE city_clean IS NOT NULL GROUP BY 1 ORDER BY COUNT(*) DESC, city_clean LIMIT 8)""") + """
SELECT CASE WHEN city_clean IN (SELECT city_clean FROM k) THEN city_clean ELSE 'Autres' END AS city_clean, COUNT(*) AS n
FROM postings WHERE city_clean IS NOT NULL GROUP BY 1""")
def q_city_share_other(spark, d):
    return geo.city_share_other(_p(spark, d))


# ---------------------------------------------------------------- time page (events)

AS_OF_SQL = f"TIMESTAMP '{fx.TEST_AS_OF}'"


@register("time_kpis", S.with_(E, f"""
daily AS (SELECT CAST(published_at AS DATE) AS date, COUNT(*) AS n,
                 COUNT_IF(published_at >= {AS_OF_SQL} - INTERVAL 7 DAY) AS recent
          FROM eposts WHERE published_at IS NOT NULL GROUP BY 1)""") + """
SELECT COUNT(*) AS n_days, SUM(n) / GREATEST(COUNT(*), 1) AS per_day,
       (SELECT date FROM daily ORDER BY n DESC, date LIMIT 1) AS peak_day, CAST(COALESCE(SUM(recent), 0) AS BIGINT) AS n_recent
FROM daily""")
def q_time_kpis(spark, d):
    return temporal.time_kpis(_e(spark, d), fx.TEST_AS_OF)


@register("by_weekday", S.with_(E, """
c AS (SELECT CAST(isodow(published_at) - 1 AS INTEGER) AS weekday, COUNT(*) AS n FROM eposts
      WHERE published_at IS NOT NULL GROUP BY 1)""", """
dim AS (SELECT CAST(range AS INTEGER) AS weekday FROM range(7))""") + f"""
SELECT dim.weekday, [{', '.join(S.q(x) for x in lexicon.WEEKDAY_FR)}][dim.weekday + 1] AS label,
       CAST(COALESCE(c.n, 0) AS BIGINT) AS n
FROM dim LEFT JOIN c ON dim.weekday = c.weekday""")
def q_by_weekday(spark, d):
    return temporal.by_weekday(_e(spark, d))


@register("by_hour", S.with_(E, """
c AS (SELECT CAST(hour(published_at) AS INTEGER) AS hour, COUNT(*) AS n FROM eposts WHERE published_at IS NOT NULL GROUP BY 1)""",
                             """
dim AS (SELECT CAST(range AS INTEGER) AS hour FROM range(24))""") + """
SELECT dim.hour, CAST(COALESCE(c.n, 0) AS BIGINT) AS n FROM dim LEFT JOIN c ON dim.hour = c.hour""")
def q_by_hour(spark, d):
    return temporal.by_hour(_e(spark, d))


@register("by_month", S.with_(P) + """
SELECT strftime(published_at, '%Y-%m') AS month, COUNT(*) AS n FROM postings WHERE published_at IS NOT NULL GROUP BY 1""")
def q_by_month(spark, d):
    return temporal.by_month(_p(spark, d))


_AGE_DAYS = f"((epoch_us({AS_OF_SQL}) - epoch_us(published_at)) / 86400000000)"


@register("freshness_buckets", S.with_(E, f"""
c AS (SELECT {S.age_bucket(_AGE_DAYS)} AS bucket, COUNT(*) AS n FROM eposts WHERE published_at IS NOT NULL GROUP BY 1)""",
                                       "dim(position, bucket) AS (VALUES " + ", ".join(
                                           f"({i}, {S.q(b)})" for i, b in enumerate(lexicon.AGE_BUCKET_LABELS)) + ")") + """
SELECT CAST(dim.position AS INTEGER) AS position, dim.bucket, CAST(COALESCE(c.n, 0) AS BIGINT) AS n
FROM dim LEFT JOIN c ON dim.bucket = c.bucket""")
def q_freshness_buckets(spark, d):
    return temporal.freshness_buckets(_e(spark, d), fx.TEST_AS_OF)


_DAILY = "daily AS (SELECT CAST(published_at AS DATE) AS date, COUNT(*) AS n FROM eposts WHERE published_at IS NOT NULL GROUP BY 1)"


@register("moving_average_3", S.with_(E, _DAILY) + """
SELECT date, n, AVG(n) OVER (ORDER BY date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS ma3 FROM daily""")
def q_moving_average_3(spark, d):
    return temporal.moving_average_3(_e(spark, d))


@register("cumulative_count", S.with_(E, _DAILY) + """
SELECT date, n, CAST(SUM(n) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative FROM daily""")
def q_cumulative_count(spark, d):
    return temporal.cumulative_count(_e(spark, d))


# ---------------------------------------------------------------- quality page

def _qkey_whole(key):
    """The key with whole titles."""
    return key.replace("substring(lower(trim(COALESCE(title, ''))), 1, 40)", "lower(trim(COALESCE(title, '')))")


_QKEY = ("concat_ws('|', lower(trim(COALESCE(company, ''))), substring(lower(trim(COALESCE(title, ''))), 1, 40), "
         "lower(trim(COALESCE(city_clean, ''))))")


@register("quality_kpis", S.with_(P) + f"""
SELECT COUNT(*) AS n_rows,
       ({' + '.join(S.pct(S.is_filled(c)) for c in lexicon.QUALITY_FIELDS)}) / {len(lexicon.QUALITY_FIELDS)} AS completeness_mean,
       COUNT(*) - COUNT(DISTINCT {_QKEY}) AS n_duplicates, COUNT(DISTINCT source) AS n_sources
FROM postings""")
def q_quality_kpis(spark, d):
    return quality.quality_kpis(_p(spark, d), title_chars=lexicon.QUALITY_TITLE_CHARS)


@register("quality_kpis_whole_title", _qkey_whole(SQL["quality_kpis"]))
def q_quality_kpis_whole_title(spark, d):
    return quality.quality_kpis(_p(spark, d))


_COMPLETENESS_UNION = " UNION ALL ".join(
    f"SELECT {S.q(label)} AS field, {S.q(col)} AS column_name, {S.pct(S.is_filled(col))} AS pct_filled FROM postings"
    for label, col in lexicon.COMPLETENESS_FIELDS.items())


@register("completeness_by_field", S.with_(P, f"f AS ({_COMPLETENESS_UNION})") + """
SELECT field, column_name, pct_filled,
       CASE WHEN pct_filled >= 80 THEN 'good' WHEN pct_filled >= 50 THEN 'fair' ELSE 'poor' END AS status FROM f""")
def q_completeness_by_field(spark, d):
    return quality.completeness_by_field(_p(spark, d))


@register("missing_by_field", S.with_(P) + " UNION ALL ".join(
    f"SELECT {S.q(c)} AS column_name, CAST(100.0 AS DOUBLE) - {S.pct(f'{c} IS NULL')} AS pct_filled, "
    f"{S.pct(f'{c} IS NULL')} AS pct_missing FROM postings" for c in lexicon.MISSING_FIELDS))
def q_missing_by_field(spark, d):
    return quality.missing_by_field(_p(spark, d))


@register("source_and_duplicates", S.with_(P) + f"""
SELECT 'source' AS kind, COALESCE(source, 'Inconnue') AS label, COUNT(*) AS n FROM postings GROUP BY 2
UNION ALL SELECT 'dedup', 'Uniques', COUNT(DISTINCT {_QKEY}) FROM postings
UNION ALL SELECT 'dedup', 'Doublons potentiels', COUNT(*) - COUNT(DISTINCT {_QKEY}) FROM postings""")
def q_source_and_duplicates(spark, d):
    return quality.source_and_duplicates(_p(spark, d), title_chars=lexicon.QUALITY_TITLE_CHARS)


@register("source_and_duplicates_whole_title", _qkey_whole(SQL["source_and_duplicates"]))
def q_source_and_duplicates_whole_title(spark, d):
    return quality.source_and_duplicates(_p(spark, d))


ORDERS_AS_OF_SQL = f"TIMESTAMP '{fx.ORDERS_AS_OF}'"


@register("source_freshness", S.with_(P) + f"""
SELECT source, COUNT(*) AS n, CAST(SUM(a) AS DOUBLE) / (COUNT(a) * 86400000000) AS mean_age_days,
       MIN(a) / 86400000000 AS min_age_days
FROM (SELECT source, epoch_us({ORDERS_AS_OF_SQL}) - epoch_us(published_at) AS a FROM postings WHERE published_at IS NOT NULL)
GROUP BY source""")
def q_source_freshness(spark, d):
    return quality.source_freshness(_p(spark, d), fx.ORDERS_AS_OF)


# ---------------------------------------------------------------- exploration tables


@register("salary_describe_by_title", S.with_(P, f"""
g AS (SELECT title, COUNT(*) AS n, {S.mean_money('salary_avg')} AS mean, {S.median_money('salary_avg')} AS median,
             ROUND(stddev_samp(salary_avg), 2) AS std, MIN(salary_avg) AS min, MAX(salary_avg) AS max
      FROM postings WHERE salary_avg IS NOT NULL AND title IS NOT NULL GROUP BY title)""") + """
SELECT * FROM g WHERE n >= CASE WHEN (SELECT COUNT_IF(n >= 5) FROM g) >= 5 THEN 5 ELSE 3 END""")
def q_salary_describe_by_title(spark, d):
    return explore.salary_describe_by_title(_p(spark, d))


@register("contract_distribution", S.with_(P) + """
SELECT contract_type, COUNT(*) AS n, COUNT(*) * 100 / (SELECT COUNT(*) FROM postings) AS pct
FROM postings WHERE contract_type IS NOT NULL GROUP BY 1""")
def q_contract_distribution(spark, d):
    return explore.contract_distribution(_p(spark, d))


@register("city_contract_crosstab", S.with_(P, """
k AS (SELECT city FROM postings WHERE city IS NOT NULL GROUP BY 1 ORDER BY COUNT(*) DESC, city LIMIT 10)""") + """
SELECT CASE WHEN GROUPING(city) = 1 THEN 'All' ELSE city END AS city,
       CASE WHEN GROUPING(contract_type) = 1 THEN 'All' ELSE contract_type END AS contract_type, COUNT(*) AS n
FROM postings WHERE city IN (SELECT city FROM k) AND contract_type IS NOT NULL
GROUP BY CUBE (city, contract_type)""")
def q_city_contract_crosstab(spark, d):
    return explore.city_contract_crosstab(_p(spark, d))


@register("impute_group_median", S.with_(P, f"""
m AS (SELECT title, {S.median_money('salary_avg')} AS med FROM postings WHERE title IS NOT NULL GROUP BY title)""") + """
SELECT p.posting_id, p.title, COALESCE(p.salary_avg, m.med) AS salary_avg FROM postings p LEFT JOIN m ON p.title = m.title""")
def q_impute_group_median(spark, d):
    return explore.impute_group_median(_p(spark, d)).select("posting_id", "title", "salary_avg")


@register("share_of_total", S.with_(P) + """
SELECT source, COUNT(*) AS n, COUNT(*) * 100 / SUM(COUNT(*)) OVER () AS pct FROM postings GROUP BY source""")
def q_share_of_total(spark, d):
    grouped = _p(spark, d).groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    return explore.share_of_total(grouped)


@register("top_n_per_group", S.with_(P) + """
SELECT city, company, n, rank FROM (
  SELECT city, company, n, CAST(ROW_NUMBER() OVER (PARTITION BY city ORDER BY n DESC, company) AS INTEGER) AS rank
  FROM (SELECT city, company, COUNT(*) AS n FROM postings GROUP BY 1, 2)) WHERE rank <= 3""")
def q_top_n_per_group(spark, d):
    grouped = _p(spark, d).groupBy("city", "company").agg(F.count(F.lit(1)).alias("n"))
    return explore.top_n_per_group(grouped, "city", [F.desc("n"), F.asc("company")], 3).select("city", "company", "n", "rank")


@register("extract_skills_array", S.with_(f"""
s AS (SELECT doc_id, {S.extract_skills_list('text', fx.TEST_SKILLS)} AS skills FROM documents)""") + """
SELECT doc_id, array_to_string(skills, '|') AS skills, CAST(len(skills) AS INTEGER) AS n_skills FROM s""")
def q_extract_skills_array(spark, d):
    docs = fx.load(spark, d, "documents").select("doc_id", "text")
    out = explore.skills_array(docs, "text", fx.TEST_SKILLS)
    return out.select("doc_id", F.array_join("skills", "|").alias("skills"), "n_skills")


@register("top_skills_share", S.with_(f"""
s AS (SELECT doc_id, {S.extract_skills_list('text', fx.TEST_SKILLS)} AS skills FROM documents)""") + """
SELECT skill, COUNT(*) AS n, COUNT(*) * 100 / (SELECT COUNT(*) FROM s) AS pct
FROM (SELECT unnest(skills) AS skill FROM s) GROUP BY skill ORDER BY n DESC, skill LIMIT 20""")
def q_top_skills_share(spark, d):
    docs = fx.load(spark, d, "documents").select("doc_id", "text")
    return explore.top_skills_share(explore.skills_array(docs, "text", fx.TEST_SKILLS))


@register("join_keywords", S.with_(DOCS, _kw_values({"Hard Skill": fx.TEST_HARD}), _kw_counts_sql({"Hard Skill": fx.TEST_HARD})) + """
SELECT family, keyword, position, n FROM counts""")
def q_join_keywords(spark, d):
    return skills.keyword_counts(_d(spark, d), {"Hard Skill": fx.TEST_HARD})


FALLBACK_TEST = ["The", "Und", "Que", "License", "Zzzz"]


@register("skill_premium_fallback", S.with_(DOCS, """
sal AS (SELECT * FROM docs WHERE salary_avg IS NOT NULL)""", f"""
g AS (SELECT {S.mean_money('salary_avg')} AS gm, COUNT(*) AS n_sal FROM sal)""", "fb(skill) AS (VALUES " + ", ".join(
    f"({S.q(x)})" for x in FALLBACK_TEST) + ")", f"""
per_skill AS (SELECT fb.skill, COUNT(*) AS n, {S.mean_money('salary_avg')} AS salary_mean
              FROM sal JOIN fb ON contains({DOC_BLOB}, lower(fb.skill)) GROUP BY fb.skill)""") + """
SELECT skill, n, salary_mean, (salary_mean - gm) / gm * 100 AS premium FROM per_skill, g WHERE n_sal >= 3
ORDER BY premium DESC, skill LIMIT 15""")
def q_skill_premium_fallback(spark, d):
    # no listed skill reaches the (very high) row minimum, so the blob search runs
    return salary.skill_premium(_d(spark, d), min_rows=10 ** 9, fallback=FALLBACK_TEST)


_MATRIX_LABELS = ["EN", "FR", "DE", "Autre"]


@register("skills_by_contract_matrix", S.with_(DOCS, f"""
b AS (SELECT {S.contract_label_substr('contract_type', fx.TEST_CONTRACT_RULES)} AS label, {DOC_BLOB} AS blob FROM docs)""", f"""
sc AS (SELECT skill, COUNT(*) AS n FROM (SELECT unnest({S.split_skills('tech_stack')}) AS skill FROM docs)
       GROUP BY skill ORDER BY n DESC, skill LIMIT 10)""") + "SELECT sc.skill, " + ", ".join(
    f"CAST(COUNT_IF(b.label = {S.q(lab)} AND contains(b.blob, lower(sc.skill))) AS BIGINT) AS {lab}" for lab in _MATRIX_LABELS)
    + " FROM sc, b GROUP BY sc.skill")
def q_skills_by_contract_matrix(spark, d):
    from jobsift.plans.skills import skills_by_contract
    long = skills_by_contract(_d(spark, d), 10, fx.TEST_CONTRACT_RULES)
    return long.groupBy("skill").pivot("label", _MATRIX_LABELS).agg(F.sum("n").cast("bigint")).fillna(0)


_CONTRACTS = ["CDI", "CDD", "Stage", "Alternance", "All"]


@register("city_contract_matrix", S.with_(P, """
k AS (SELECT city FROM postings WHERE city IS NOT NULL GROUP BY 1 ORDER BY COUNT(*) DESC, city LIMIT 10)""", """
c AS (SELECT CASE WHEN GROUPING(city) = 1 THEN 'All' ELSE city END AS city,
             CASE WHEN GROUPING(contract_type) = 1 THEN 'All' ELSE contract_type END AS contract_type, COUNT(*) AS n
      FROM postings WHERE city IN (SELECT city FROM k) AND contract_type IS NOT NULL GROUP BY CUBE (city, contract_type))""")
          + "SELECT city, " + ", ".join(f"CAST(COALESCE(SUM(CASE WHEN contract_type = {S.q(x)} THEN n END), 0) AS BIGINT) AS {x}"
                                        for x in _CONTRACTS) + " FROM c GROUP BY city")
def q_city_contract_matrix(spark, d):
    return explore.city_contract_matrix(_p(spark, d), contracts=_CONTRACTS)
