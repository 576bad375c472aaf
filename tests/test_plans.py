"""Plan shape: filters reach the scan, projections are pruned, no cartesian products."""
import io
from contextlib import redirect_stdout

import __spark_entry__ as ent

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_filter_pushed_to_scan(spark):
    txt = plan_of(ent.queries()["filter_postings"](spark, SF))
    assert "EqualTo(n_name,NATION_3)" in txt
    assert "lineitem" not in txt          # the unused skill-list join is pruned away


def test_no_cartesian_products(spark):
    for name in ["skills_by_contract", "skill_premium", "salary_histogram", "city_share_other", "geo_kpis",
                 "salary_describe_by_title", "join_global_scalar", "city_contract_crosstab"]:
        txt = plan_of(ent.queries()[name](spark, SF))
        assert "CartesianProduct" not in txt and "BroadcastNestedLoopJoin" not in txt, name


def test_column_pruning(spark):
    txt = plan_of(ent.queries()["by_hour"](spark, SF))
    assert "ReadSchema: struct<ts:timestamp_ntz>" in txt


def test_dedup_is_partial_aggregate(spark):
    txt = plan_of(ent.queries()["dedup_keep_most_complete"](spark, SF))
    assert txt.count("SortAggregate") >= 2 or txt.count("HashAggregate") >= 2
