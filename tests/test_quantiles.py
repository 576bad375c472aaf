"""Exact grouped quantiles: brute force with a hot group and many values; no percentile over raw rows in the plans."""
import io
from contextlib import redirect_stdout

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as ent
from jobsift.operators import aggs

SF = "/root/testdata/sf0.001"


def test_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [("hot", float(round(x, 2))) for x in rng.lognormal(10, 1, 4000)]
    rows += [(None, float(x)) for x in rng.integers(1, 4, 7)] + [("one", 5.25), ("two", 1.0), ("two", 2.01), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    qs = (0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0)
    got = {r.g: r for r in aggs.group_quantiles(df, ["g"], "v", qs).collect()}
    assert set(got) == {"hot", None, "one", "two"}
    for g in got:
        v = np.array([x for k, x in rows if k == g])
        assert got[g].n == len(v)
        np.testing.assert_allclose(got[g].q, np.quantile(v, qs), rtol=1e-9)
    whole = aggs.group_quantiles(df, [], "v").first()
    assert whole.n == 4010 and abs(whole.q[0] - np.median([x for _, x in rows if x is not None])) < 0.006
    assert df.limit(1).select(aggs.median_scalar(df.where("g = 'none'"), "v").alias("m")).first().m is None


@pytest.mark.parametrize("name", ["overview_kpis", "salary_kpis", "salary_by_source", "salary_box", "salary_box_by_title",
                                  "salary_describe_by_title", "impute_group_median", "salary_imputed_describe"])
def test_no_percentile_in_plans(spark, name):
    out = io.StringIO()
    with redirect_stdout(out):
        ent.queries()[name](spark, SF).explain("formatted")
    assert "percentile" not in out.getvalue()


def test_skill_premium_plans_without_an_action(spark):
    before = spark.sparkContext.statusTracker().getJobIdsForGroup()
    df = spark.createDataFrame([("a, b", 10.0), ("a", 20.0), ("b", 30.0)], "tech_stack string, salary_avg double")
    from jobsift.plans.salary import skill_premium
    out = skill_premium(df)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup() == before
    assert sorted((r.skill, r.n) for r in out.collect()) == [("A", 2), ("B", 2)]
    only = skill_premium(df.withColumn("tech_stack", F.lit(None).cast("string")).withColumn("description", F.lit("Python et SQL")), fallback=["Python"])
    assert [(r.skill, r.n) for r in only.collect()] == [("Python", 3)]
