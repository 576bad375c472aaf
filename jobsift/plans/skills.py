"""Skills page: KPIs, power trio, keyword families, hard vs soft, skills x contract, cloud providers.

Keyword counts are one aggregation with one ``count_if`` per keyword over a
text blob computed once, instead of one pass over the data per keyword.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobsift import lexicon
from jobsift.functions.contract import contract_label_substr
from jobsift.functions.text import has_any_keyword, has_word, split_skills, text_blob
from jobsift.operators.aggs import pct
from jobsift.plans.overview import skill_counts


def _blob(df: DataFrame) -> DataFrame:
    """Add ``_blob``: lower(description || ' ' || tech_stack), computed once per row."""
    desc = F.col("description") if "description" in df.columns else F.lit(None).cast("string")
    stack = F.col("tech_stack") if "tech_stack" in df.columns else F.lit(None).cast("string")
    return df.withColumn("_blob", text_blob(desc, stack))


def skills_kpis(df: DataFrame, word_a: str = "python", word_b: str = "sql",
                cloud: Sequence[str] = lexicon.CLOUD_KEYWORDS,
                genai: Sequence[str] = lexicon.GENAI_KEYWORDS) -> DataFrame:
    """Distinct skills; % of rows with word_a, word_b (whole word), cloud and gen-AI (substring)."""
    b = _blob(df)
    shares = b.agg(pct(has_word("_blob", word_a, assume_lower=True)).alias("pct_a"),
                   pct(has_word("_blob", word_b, assume_lower=True)).alias("pct_b"),
                   pct(has_any_keyword("_blob", cloud, assume_lower=True)).alias("pct_cloud"),
                   pct(has_any_keyword("_blob", genai, assume_lower=True)).alias("pct_genai"))
    distinct = (df.select(F.explode(split_skills("tech_stack")).alias("s")).distinct()
                  .agg(F.count(F.lit(1)).alias("n_distinct_skills")))
    return shares.select(distinct.scalar().alias("n_distinct_skills"), "*")


def power_trio(df: DataFrame, word_a: str = "python", word_b: str = "sql",
               cloud: Sequence[str] = lexicon.CLOUD_KEYWORDS) -> DataFrame:
    """% of rows with a & b & cloud, and each pair; one row per combination."""
    b = _blob(df)
    a, s, c = (has_word("_blob", word_a, True), has_word("_blob", word_b, True),
               has_any_keyword("_blob", cloud, assume_lower=True))
    wide = b.agg(pct(a & s & c).alias("trio"), pct(a & s).alias("a_b"),
                 pct(a & c).alias("a_cloud"), pct(s & c).alias("b_cloud"))
    return wide.unpivot([], ["trio", "a_b", "a_cloud", "b_cloud"], "combo", "pct")


def keyword_counts(df: DataFrame, families: Mapping[str, Sequence[str]], match: str = "substring") -> DataFrame:
    """(family, keyword, position, n): rows mentioning each keyword, one pass."""
    b = _blob(df)
    specs = [(fam, i, kw) for fam, kws in families.items() for i, kw in enumerate(kws)]
    wide = b.agg(*[F.count_if(has_any_keyword("_blob", [kw], match, assume_lower=True)).alias(f"k{j}")
                   for j, (_, _, kw) in enumerate(specs)])
    stack = ", ".join(f"'{fam.replace(chr(39), chr(39) * 2)}', '{kw.replace(chr(39), chr(39) * 2)}', {i}, k{j}"
                      for j, (fam, i, kw) in enumerate(specs))
    return wide.selectExpr(f"stack({len(specs)}, {stack}) as (family, keyword, position, n)")


def keyword_family_counts(df: DataFrame, genai: Sequence[str] = lexicon.GENAI_KEYWORDS,
                          traditional: Sequence[str] = lexicon.TRADITIONAL_KEYWORDS) -> DataFrame:
    """Rows mentioning each gen-AI / traditional keyword; keywords with no row dropped."""
    counts = keyword_counts(df, {"IA Générative": genai, "Traditionnel": traditional})
    return counts.filter(F.col("n") > 0).select("family", "keyword", "n")


def hard_vs_soft(df: DataFrame, hard: Sequence[str] = lexicon.HARD_SKILLS,
                 soft: Sequence[str] = lexicon.SOFT_SKILLS, top: int = 8) -> DataFrame:
    """Top ``top`` hard and soft skills by rows mentioning (ties keep list order); zeros dropped."""
    counts = keyword_counts(df, {"Hard Skill": hard, "Soft Skill": soft})
    w = Window.partitionBy("family").orderBy(F.desc("n"), F.asc("position"))  # <= len(list) rows per family
    return (counts.withColumn("rank", F.row_number().over(w))
                  .filter((F.col("rank") <= top) & (F.col("n") > 0))
                  .select(F.col("family").alias("kind"), "keyword", "n", "rank"))


def cloud_providers(df: DataFrame, providers: Mapping[str, Sequence[str]] = lexicon.CLOUD_PROVIDERS) -> DataFrame:
    """Rows mentioning any keyword of each provider."""
    b = _blob(df)
    names = list(providers)
    wide = b.agg(*[F.count_if(has_any_keyword("_blob", providers[p], assume_lower=True)).alias(f"p{i}")
                   for i, p in enumerate(names)])
    return wide.unpivot([], [F.col(f"p{i}").alias(p) for i, p in enumerate(names)], "provider", "n")


def skills_by_contract(df: DataFrame, top: int = 10,
                       rules: Sequence[tuple[str, Sequence[str]]] = lexicon.CONTRACT_SUBSTRING_RULES) -> DataFrame:
    """(skill, label, n) for the ``top`` most listed skills x every contract label present:
    rows of that label whose text blob contains the skill (lower-cased substring), 0 if none.

    The top list is a scalar subquery (an array of at most ``top`` names), and
    each row emits only the skills it mentions, so nothing grows as rows x skills.
    """
    b = _blob(df).withColumn("label", contract_label_substr("contract_type", rules))
    top_list = (skill_counts(df).orderBy(F.desc("n"), F.asc("skill")).limit(top)
                .agg(F.collect_list("skill").alias("top"))).scalar()
    hits = (b.withColumn("_top", top_list)
             .select("label", F.explode(F.filter("_top", lambda s: F.col("_blob").contains(F.lower(s)))).alias("skill"))
             .groupBy("skill", "label").agg(F.count(F.lit(1)).alias("n")))
    grid = b.select("label").distinct().select("label", F.explode(top_list).alias("skill"))
    return (grid.join(hits, ["skill", "label"], "left")
                .select("skill", "label", F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n")))


def skills_by_contract_matrix(df: DataFrame, top: int = 10,
                              labels: Sequence[str] = ("CDI", "CDD", "Freelance", "Stage", "Alternance", "Intérim", "Autre")) -> DataFrame:
    """The same counts as a matrix: one row per skill, one column per label."""
    long = skills_by_contract(df, top)
    return long.groupBy("skill").pivot("label", list(labels)).agg(F.sum("n")).fillna(0)
