"""The interactive entry point: one filter selection -> every report of a page.

The served table is filtered lazily: each report scans the columns it needs of the
stored table. Each report stays a DataFrame: the caller collects only the small
result tables it draws. A caller that knows the selection to be small may cache it.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from jobsift.operators.filters import filter_postings
from jobsift.plans import geo, overview, quality, salary, skills, temporal

PAGES: dict[str, dict[str, Callable[..., DataFrame]]] = {
    "overview": {"kpis": overview.overview_kpis, "histogram": overview.salary_histogram,
                 "contracts": overview.contract_share, "map": overview.city_map, "skills": overview.top_skills,
                 "daily": temporal.moving_average_3, "table": overview.detail_table},
    "skills": {"kpis": skills.skills_kpis, "power_trio": skills.power_trio,
               "genai_vs_traditional": skills.keyword_family_counts, "hard_vs_soft": skills.hard_vs_soft,
               "by_contract": skills.skills_by_contract, "cloud": skills.cloud_providers},
    "salary": {"kpis": salary.salary_kpis, "premium": salary.skill_premium, "by_source": salary.salary_by_source,
               "by_city": salary.salary_by_city, "box": salary.salary_box},
    "geography": {"kpis": geo.geo_kpis, "work_mode": geo.work_mode_salary, "hubs": geo.hub_density,
                  "top_cities": geo.top_cities, "map": overview.city_map},
    "time": {"kpis": temporal.time_kpis, "weekday": temporal.by_weekday, "hour": temporal.by_hour,
             "cumulative": temporal.cumulative_count, "freshness": temporal.freshness_buckets},
    "quality": {"kpis": quality.quality_kpis, "completeness": quality.completeness_by_field,
                "sources": quality.source_and_duplicates, "missing": quality.missing_by_field,
                "freshness": quality.source_freshness},
}
NEEDS_AS_OF = {"time_kpis", "freshness_buckets", "source_freshness"}


def page_reports(served: DataFrame, page: str, city: str = "ALL", contract: str = "ALL",
                 salary_range_k: tuple[float, float] | None = None, as_of=None,
                 cache: bool = False) -> dict[str, DataFrame]:
    """All report frames of ``page`` for one filter selection (``served`` must carry
    ``city_clean``, see ``lookups.with_dashboard_columns``)."""
    view = filter_postings(served, city, contract, salary_range_k)
    if cache:
        view = view.cache()
    out = {}
    for name, fn in PAGES[page].items():
        if fn.__name__ in NEEDS_AS_OF:
            if as_of is None:
                raise ValueError(f"{page}.{name} needs as_of")
            out[name] = fn(view, as_of)
        else:
            out[name] = fn(view)
    return out
