"""Driver contract: entry() runs, every query has a callable, SQL checks at sf0.001."""
import duckdb
import pytest

import __spark_entry__ as ent

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def test_entry_runs(spark):
    df = ent.entry(spark)
    assert df.count() >= 0
    assert set(df.columns) == {"city_clean", "salary_mean", "n"}


def test_oracle_keys_are_queries():
    assert set(ent.oracle_sql()) <= set(ent.queries())
    assert len(ent.queries()) >= 100


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _norm(v):
    """Sortable form: (kind, value) so None, numbers and text never compare directly."""
    if v is None:
        return (0, "")
    if isinstance(v, (int, float)) and not isinstance(v, bool):
        return (1, round(float(v), 9))
    return (2, str(v))


@pytest.mark.parametrize("name", ["overview_kpis", "salary_histogram", "contract_share", "skill_premium",
                                  "dedup_keep_most_complete", "build_clean", "parse_salary", "normalize_city",
                                  "counter_rate", "extract_page_fields", "hard_vs_soft", "city_contract_crosstab"])
def test_query_matches_sql(spark, duck, name):
    sdf = ent.queries()[name](spark, SF)
    cols = sorted(sdf.columns)
    got = sorted(tuple(_norm(r[c]) for c in cols) for r in sdf.collect())
    rel = duck.sql(ent.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    idx = [rel.columns.index(c) for c in cols]
    want = sorted(tuple(_norm(row[i]) for i in idx) for row in rel.fetchall())
    assert got == want
