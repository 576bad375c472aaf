"""Queries that run the shipped word lists with default arguments.

Texts are made from customer keys so that every entry of every list occurs. What
must be found in a text is worked out here from the entry alone, by Python's
regular expressions, and given to the SQL as a table of answers.
"""
from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsift import functions as J
from jobsift import lexicon
from jobsift.operators import clean, profile
from jobsift.plans import explore, fixtures as fx, skills
from jobsift.plans import sqltext as S
from jobsift.plans.registry import register

# One phrase for each way of writing a work mode.
MODE_PHRASES = [
    ("Full Remote Job", "Full Remote"), ("FULLREMOTE", "Full Remote"), ("100 % remote", "Full Remote"), ("100remote", "Full Remote"),
    ("Télétravail  Complet", "Full Remote"), ("fully remote", "Full Remote"), ("mode HYBRIDE", "Hybride"), ("hybrid work", "Hybride"),
    ("télétravail partiel", "Hybride"), ("Remote Partiel", "Hybride"), ("3 jours / semaine", "Hybride"), ("2j semaine", "Hybride"), ("1 jour/semaine", "Hybride"),
    ("PRÉSENTIEL", "Présentiel"), ("Sur Site", "Présentiel"), ("on-site", "Présentiel"), ("ON SITE", "Présentiel"), ("onsite", "Présentiel"),
    ("pas de télétravail", "Présentiel"), ("No Remote", "Présentiel"), ("semaine de travail", lexicon.WORK_MODE_UNKNOWN), ("", lexicon.WORK_MODE_UNKNOWN)]
CONTRACT_PHRASES = [*((w, "Stage") for w in lexicon.STAGE_WORDS), *((w.upper(), "Alternance") for w in lexicon.ALTERNANCE_WORDS),
                    ("stage en alternance", "Alternance"), ("backstage", "CDI"), ("internal", "CDI")]
ALL_TERMS = sorted({*lexicon.TECH_SKILLS, *lexicon.EXPLORE_SKILLS, *lexicon.CLOUD_KEYWORDS, *lexicon.GENAI_KEYWORDS, *lexicon.TRADITIONAL_KEYWORDS,
                    *lexicon.SOFT_SKILLS, *lexicon.HARD_SKILLS, *(k for ks in lexicon.CLOUD_PROVIDERS.values() for k in ks)})


def _texts(spark, d, terms) -> DataFrame:
    """Customers with the term their key points at, in mixed case, between words that are in no list."""
    c = fx.load(spark, d, "customer").select("c_custkey")
    term = F.element_at(F.array(*[F.lit(t) for t in terms]), (F.col("c_custkey") % len(terms) + 1).cast("int"))
    term = F.when(F.col("c_custkey") % 2 == 0, F.upper(term)).otherwise(term)
    return c.select("c_custkey", F.concat(F.lit("zz ("), term, F.lit(") zz")).alias("description"))


def _answers(name: str, terms, columns: str, answer) -> str:
    rows = ", ".join(f"({i}, {', '.join(answer(t))})" for i, t in enumerate(terms))
    return f"{name}(i, {columns}) AS (VALUES {rows})"


def _words_in(term: str, words) -> list[str]:
    return [w for w in words if re.search(rf"(?<!\w){re.escape(w)}(?!\w)", term, re.I)]


def _skill_sql(terms) -> str:
    return "WITH " + _answers("a", terms, "found", lambda t: [S.q(", ".join(_words_in(t, terms)))])


@register("extract_skills_text_shipped", _skill_sql(lexicon.TECH_SKILLS) + f"""
SELECT c_custkey, found AS tech_stack FROM customer JOIN a ON i = c_custkey % {len(lexicon.TECH_SKILLS)}""")
def q_extract_skills_text_shipped(spark, d):
    return clean.enrich(_texts(spark, d, lexicon.TECH_SKILLS)).select("c_custkey", "tech_stack")


@register("extract_skills_array_shipped", _skill_sql(lexicon.EXPLORE_SKILLS) + f"""
SELECT c_custkey, found AS skills, CAST(len(string_split(found, ', ')) AS INTEGER) AS n_skills FROM customer JOIN a ON i = c_custkey % {len(lexicon.EXPLORE_SKILLS)}""")
def q_extract_skills_array_shipped(spark, d):
    return explore.skills_array(_texts(spark, d, lexicon.EXPLORE_SKILLS)).select("c_custkey", F.array_join("skills", ", ").alias("skills"), "n_skills")


@register("infer_contract_shipped", "WITH " + _answers("a", CONTRACT_PHRASES, "label", lambda t: [S.q(t[1])]) + f"""
SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'Freelance' ELSE label END AS contract_type FROM customer JOIN a ON i = c_custkey % {len(CONTRACT_PHRASES)}""")
def q_infer_contract_shipped(spark, d):
    rows = _texts(spark, d, [p for p, _ in CONTRACT_PHRASES])
    raw = F.when(F.col("c_custkey") % 5 == 0, F.lit("Freelance")).otherwise(F.lit("CDI"))
    return rows.select("c_custkey", J.infer_contract(raw, F.lit("zz"), "description").alias("contract_type"))


@register("detect_work_mode_shipped", "WITH " + _answers("a", MODE_PHRASES, "mode", lambda t: [S.q(t[1])]) + f"""
SELECT c_custkey, mode AS work_mode FROM customer JOIN a ON i = c_custkey % {len(MODE_PHRASES)}""")
def q_detect_work_mode_shipped(spark, d):
    return _texts(spark, d, [p for p, _ in MODE_PHRASES]).select("c_custkey", J.detect_work_mode(F.col("description")).alias("work_mode"))


def _in_sql(keywords) -> str:
    """Rows whose term holds one of the keywords as a substring."""
    return "i IN (" + ", ".join(str(i) for i, t in enumerate(ALL_TERMS) if any(k in t.lower() for k in keywords)) + ")"


def _word_sql(word: str) -> str:
    return "i IN (" + ", ".join(str(i) for i, t in enumerate(ALL_TERMS) if _words_in(t, [word])) + ")"


_T = f"WITH t AS (SELECT c_custkey % {len(ALL_TERMS)} AS i FROM customer) "


def _counts(families: dict) -> str:
    return " UNION ALL ".join(f"SELECT {S.q(f)} AS family, {S.q(k)} AS keyword, {p} AS position, CAST(COUNT_IF({_in_sql([k])}) AS BIGINT) AS n FROM t"
                              for f, ks in families.items() for p, k in enumerate(ks))


@register("keyword_family_counts_shipped", _T + "SELECT family, keyword, n FROM (" + _counts(
    {"IA Générative": lexicon.GENAI_KEYWORDS, "Traditionnel": lexicon.TRADITIONAL_KEYWORDS}) + ") WHERE n > 0")
def q_keyword_family_counts_shipped(spark, d):
    return skills.keyword_family_counts(_texts(spark, d, ALL_TERMS))


@register("hard_vs_soft_shipped", _T + """SELECT kind, keyword, n, rank FROM (SELECT family AS kind, keyword, n,
  CAST(ROW_NUMBER() OVER (PARTITION BY family ORDER BY n DESC, position) AS INTEGER) AS rank FROM (""" + _counts(
    {"Hard Skill": lexicon.HARD_SKILLS, "Soft Skill": lexicon.SOFT_SKILLS}) + ")) WHERE rank <= 100 AND n > 0")
def q_hard_vs_soft_shipped(spark, d):
    return skills.hard_vs_soft(_texts(spark, d, ALL_TERMS), top=100)


@register("cloud_providers_shipped", _T + " UNION ALL ".join(
    f"SELECT {S.q(p)} AS provider, CAST(COUNT_IF({_in_sql(ks)}) AS BIGINT) AS n FROM t" for p, ks in lexicon.CLOUD_PROVIDERS.items()))
def q_cloud_providers_shipped(spark, d):
    return skills.cloud_providers(_texts(spark, d, ALL_TERMS))


@register("power_trio_shipped", _T + f""", b AS (SELECT {_word_sql('python')} AS a, {_word_sql('sql')} AS s, {_in_sql(lexicon.CLOUD_KEYWORDS)} AS c FROM t)
SELECT combo, pct FROM (SELECT {S.pct('a AND s AND c')} AS trio, {S.pct('a AND s')} AS a_b, {S.pct('a AND c')} AS a_cloud, {S.pct('s AND c')} AS b_cloud FROM b)
UNPIVOT (pct FOR combo IN (trio, a_b, a_cloud, b_cloud))""")
def q_power_trio_shipped(spark, d):
    return skills.power_trio(_texts(spark, d, ALL_TERMS))


@register("skills_kpis_shipped", _T + f"""SELECT CAST((SELECT COUNT(DISTINCT i) FROM t) AS BIGINT) AS n_distinct_skills, {S.pct(_word_sql('python'))} AS pct_a,
  {S.pct(_word_sql('sql'))} AS pct_b, {S.pct(_in_sql(lexicon.CLOUD_KEYWORDS))} AS pct_cloud, {S.pct(_in_sql(lexicon.GENAI_KEYWORDS))} AS pct_genai FROM t""")
def q_skills_kpis_shipped(spark, d):
    rows = _texts(spark, d, ALL_TERMS)
    term = F.element_at(F.array(*[F.lit(t) for t in ALL_TERMS]), (F.col("c_custkey") % len(ALL_TERMS) + 1).cast("int"))
    return skills.skills_kpis(rows.withColumn("tech_stack", term))


DATE_SHAPES = [("yyyy-MM-dd", "%Y-%m-%d"), ("dd/MM/yyyy", "%d/%m/%Y"), ("yyyyMMdd", "%Y%m%d"), ("MMMM d, yyyy", None), ("EEE, dd MMM yyyy HH:mm:ss", None)]


@register("normalize_date_formats", "SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) AS published FROM orders")
def q_normalize_date_formats(spark, d):
    """Dates written in five shapes, read back with the shapes as argument."""
    o = fx.load(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp_ntz").alias("t"))
    shape = F.pmod(F.col("o_orderkey"), F.lit(len(DATE_SHAPES)))
    text = F.lit(None).cast("string")
    for i, (f, _) in enumerate(DATE_SHAPES):
        written = F.concat(F.element_at(F.array(*[F.lit(x) for x in J.WEEKDAY_EN]), F.weekday("t") + 1), F.date_format("t", ", dd MMM yyyy HH:mm:ss")) \
            if f.startswith("EEE") else F.date_format("t", f)
        text = F.when(shape == i, written).otherwise(text)
    return o.select("o_orderkey", J.normalize_date(text, formats=J.COMMON_DATE_FORMATS).alias("published"))


@register("exploration_job", f"""
WITH r AS (SELECT c_name AS t, c_mktsegment AS e, c_acctbal AS lo, c_acctbal + 1000 AS hi, c_custkey FROM customer),
d AS (SELECT DISTINCT 'Poste ' || c_custkey % 40 AS intitule_poste, e AS entreprise, 'Lyon' AS ville,
             CASE WHEN (lo + hi) / 2 >= 1000 AND (lo + hi) / 2 <= 200000 THEN (lo + hi) / 2 END AS salaire_moyen FROM r),
m AS (SELECT intitule_poste, quantile_cont(CAST(ROUND(salaire_moyen * 100) AS BIGINT), 0.5) / 100 AS med FROM d WHERE salaire_moyen IS NOT NULL GROUP BY 1),
f AS (SELECT d.intitule_poste, entreprise, COALESCE(salaire_moyen, med) AS salaire_moyen FROM d LEFT JOIN m USING (intitule_poste))
SELECT intitule_poste, entreprise, 'Lyon' AS ville, MIN(salaire_moyen) AS salaire_moyen FROM f GROUP BY 1, 2""")
def q_exploration_job(spark, d):
    """The exploration as one plan: load, rename, drop sparse columns, mean salary, impute by title, one row per posting, export."""
    c = fx.load(spark, d, "customer")
    raw = c.select(F.concat(F.lit("Poste "), (F.col("c_custkey") % 40).cast("string")).alias("title"), F.struct(F.col("c_mktsegment").alias("display_name")).alias("company"),
                   F.struct(F.lit("Lyon").alias("display_name")).alias("location"), F.col("c_acctbal").alias("salary_min"),
                   (F.col("c_acctbal") + 1000).alias("salary_max"), F.lit(None).cast("string").alias("category"))
    return profile.exploration_job(raw, source="api").select("intitule_poste", "entreprise", "ville", "salaire_moyen")
