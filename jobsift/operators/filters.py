"""Row filters. All are plain predicates, so Catalyst pushes them to the scan."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsift import lexicon
from jobsift.functions.place import is_junk_place


def filter_postings(df: DataFrame, city: str = "ALL", contract: str = "ALL",
                    salary_range_k: tuple[float, float] | None = None,
                    city_col: str = "city_clean") -> DataFrame:
    """City equality, contract equality ('ALL' disables each) and an inclusive
    salary range in thousands; rows without salary always pass."""
    out = df
    if city != "ALL" and city_col in df.columns:
        out = out.filter(F.col(city_col) == F.lit(city))
    if contract != "ALL" and "contract_type" in df.columns:
        out = out.filter(F.col("contract_type") == F.lit(contract))
    if salary_range_k is not None and "salary_avg" in df.columns:
        lo, hi = salary_range_k[0] * 1000, salary_range_k[1] * 1000
        out = out.filter(F.col("salary_avg").isNull() | F.col("salary_avg").between(lo, hi))
    return out


def filter_has_salary(df: DataFrame, col: str = "salary_avg") -> DataFrame:
    return df.na.drop(subset=[col])


def filter_has_date(df: DataFrame, col: str = "published_at") -> DataFrame:
    return df.na.drop(subset=[col])


def filter_has_geo(df: DataFrame) -> DataFrame:
    return df.na.drop(subset=["lat", "lon"])


def outlier_free_salary(col: Column | str, low: float = lexicon.SALARY_OUTLIER_LOW,
                        high: float = lexicon.SALARY_OUTLIER_HIGH) -> Column:
    """Value kept only when low < x < high (cleaning rule)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when((c > low) & (c < high), c)


def filter_outlier_salary(df: DataFrame, col: str = "salary_avg", low: float = lexicon.SALARY_OUTLIER_LOW,
                          high: float = lexicon.SALARY_OUTLIER_HIGH) -> DataFrame:
    """Salary set to null outside (low, high); rows kept."""
    return df.withColumn(col, outlier_free_salary(col, low, high))


def filter_min_count(grouped: DataFrame, n: int = 3, count_col: str = "count") -> DataFrame:
    """HAVING count >= n on an aggregated frame."""
    return grouped.filter(F.col(count_col) >= n)


def top_keys(df: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` most frequent non-null keys (ties by key). At most ``n`` rows."""
    return (df.filter(F.col(key).isNotNull()).groupBy(key).count()
              .orderBy(F.desc("count"), F.asc(key)).limit(n).select(key))


def filter_in_top(df: DataFrame, key: str, n: int) -> DataFrame:
    """Rows whose key is among the ``n`` most frequent keys (a semi-join; the
    top list has at most ``n`` rows, so it is broadcast)."""
    return df.join(F.broadcast(top_keys(df, key, n)), key, "left_semi")


def filter_junk_place(df: DataFrame, col: str = "city",
                      fragments: Sequence[str] = lexicon.PLACE_JUNK_FRAGMENTS) -> DataFrame:
    """Rows whose place value carries a JSON/HTML fragment."""
    return df.filter(is_junk_place(col, fragments))


def filter_options(df: DataFrame, col: str) -> DataFrame:
    """Sorted distinct non-null values (picker options)."""
    return df.select(col).dropna().distinct().orderBy(col)
