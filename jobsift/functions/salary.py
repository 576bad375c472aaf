"""Salary Column functions: free-text parsing, currency, row mean, outlier rules."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobsift import lexicon
from jobsift.functions._let import let

# FIXED VALUE: a number possibly written with spaces ("45 000"), an optional decimal part,
# then an optional K (thousands) after optional spaces.
_NUMBER = r"(?U)(\d[\d\s]*\.?\d*)\s*K?"


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def _salary_text(raw: Column) -> Column:
    return F.replace(F.replace(F.upper(raw), F.lit("\u00a0"), F.lit(" ")), F.lit(","), F.lit("."))


def detect_currency(raw: Column | str) -> Column:
    """USD for $ or USD, GBP for £ or GBP, CHF, else EUR (in that order)."""
    t = F.upper(_c(raw))
    return (F.when(t.contains("$") | t.contains("USD"), F.lit("USD"))
             .when(t.contains("£") | t.contains("GBP"), F.lit("GBP"))
             .when(t.contains("CHF"), F.lit("CHF"))
             .otherwise(F.lit("EUR")))


def salary_numbers(raw: Column | str) -> Column:
    """All numbers of a salary text, K-suffixed ones below 1000 multiplied by 1000."""
    t = _salary_text(_c(raw))
    full = F.regexp_extract_all(t, F.lit(_NUMBER), 0)
    digits = F.regexp_extract_all(t, F.lit(_NUMBER), 1)

    def value(m, i):
        v = F.replace(F.element_at(digits, i + 1), F.lit(" "), F.lit("")).try_cast("double")
        return F.when(m.contains("K") & (v < 1000), v * 1000).otherwise(v)

    return F.filter(F.transform(full, value), lambda v: v.isNotNull())


def parse_salary(raw: Column | str) -> Column:
    """struct<salary_min double, salary_max double, currency string>.

    The first two numbers ordered (one number gives min = max); no number or a
    null/blank text gives nulls. Blank or null text has currency EUR. The number
    list is extracted once per row (``let``).
    """
    c = _c(raw)
    blank = c.isNull() | (F.trim(c) == F.lit(""))
    cur = F.when(blank, F.lit("EUR")).otherwise(detect_currency(c))

    def build(nums):
        n = F.size(nums)
        a = F.try_element_at(nums, F.lit(1))
        b = F.when(n >= 2, F.try_element_at(nums, F.lit(2))).otherwise(a)
        ok = ~blank & (n >= 1)
        return F.struct(F.when(ok, F.least(a, b)).alias("salary_min"), F.when(ok, F.greatest(a, b)).alias("salary_max"),
                        cur.alias("currency"))

    return let(salary_numbers(c), build)


def row_mean(a: Column | str, b: Column | str) -> Column:
    """Null-skipping mean of two values (null only when both are null)."""
    a, b = _c(a), _c(b)
    return (F.coalesce(a, b) + F.coalesce(b, a)) / 2


def salary_avg(salary_min: Column | str = "salary_min", salary_max: Column | str = "salary_max",
               low: float = lexicon.SALARY_OUTLIER_LOW, high: float = lexicon.SALARY_OUTLIER_HIGH) -> Column:
    """Cleaning rule: row mean, kept only when low < mean < high."""
    m = row_mean(salary_min, salary_max)
    return F.when((m > low) & (m < high), m)


def salary_avg_explore(salary_min: Column | str, salary_max: Column | str,
                       low: float = lexicon.EXPLORE_SALARY_LOW, high: float = lexicon.EXPLORE_SALARY_HIGH) -> Column:
    """Exploration rule: (min+max)/2 (null if either is null), nulled if < low or > high."""
    m = (_c(salary_min) + _c(salary_max)) / 2
    return F.when((m >= low) & (m <= high), m)


def to_cents(col: Column | str, scale: int = 2) -> Column:
    """Money as whole cents (bigint; units of 10^-``scale``), so sums and quantiles are exact and order-free."""
    return F.round(_c(col) * 10 ** scale).cast("bigint")
