"""Place Column functions: city normalisation and the dashboard's city key."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobsift import lexicon
from jobsift.functions._let import let
from jobsift.functions.text import quote_literal, title_case


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def is_junk_place(col: Column | str, fragments: Sequence[str] = lexicon.PLACE_JUNK_FRAGMENTS) -> Column:
    """True when the value carries a JSON/HTML fragment (case-sensitive)."""
    return _c(col).rlike("|".join(quote_literal(f) for f in fragments))


def normalize_city(col: Column | str, aliases: Mapping[str, str] = lexicon.CITY_ALIASES,
                   unknown: str = lexicon.PLACE_UNKNOWN) -> Column:
    """Trim + title case; junk -> unknown; aliases; Paris districts -> Paris;
    otherwise the text before the first comma. Null -> unknown.

    Each step's value is bound once (``let``), so the title case runs once per row.
    """
    c = _c(col)
    amap = F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv])

    def step1(t):
        return F.when(is_junk_place(t), F.lit(unknown)).otherwise(F.coalesce(F.try_element_at(amap, t), t))

    def step2(s):
        return F.when(s.rlike(lexicon.PARIS_DISTRICT_PATTERN), F.lit("Paris")).otherwise(s)

    def step3(s):
        return F.when(s.contains(","), F.trim(F.split_part(s, F.lit(","), F.lit(1)))).otherwise(s)

    out = let(title_case(F.trim(c)), lambda t: let(step1(t), lambda s1: let(step2(s1), step3)))
    return F.when(c.isNull(), F.lit(unknown)).otherwise(out)


def normalize_city_explore(col: Column | str, aliases: Mapping[str, str] = lexicon.EXPLORE_CITY_ALIASES) -> Column:
    """Exploration rule: trim + title case + three Paris aliases; null stays null."""
    t = title_case(F.trim(_c(col)))
    alias = F.try_element_at(F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv]), t)
    return F.coalesce(alias, t)


def city_clean(col: Column | str = "city", unknown: str = lexicon.CITY_CLEAN_UNKNOWN) -> Column:
    """Dashboard city key: null -> unknown, text before the first comma, trimmed."""
    return F.trim(F.split_part(F.coalesce(_c(col), F.lit(unknown)), F.lit(","), F.lit(1)))
