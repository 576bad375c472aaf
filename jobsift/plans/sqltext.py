"""SQL text for the DuckDB cross-check of each registered query.

The snippets restate the same rules as the Column functions in plain SQL
(RE2 patterns: no look-around, so word edges are written as groups).
"""
from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from jobsift import lexicon

NOT_WORD = r"[^\p{L}\p{N}_]"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def re_quote(term: str) -> str:
    return re.sub(r"([\\.^$|?*+()\[\]{}\-/#&~<>!=:,'\"% @])", r"\\\1", term)


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


def mean_money(x: str) -> str:
    return f"CAST(SUM(CAST(ROUND({x} * 100) AS BIGINT)) AS DOUBLE) / (COUNT({x}) * 100)"


def median_money(x: str) -> str:
    return f"quantile_cont(CAST(ROUND({x} * 100) AS BIGINT), 0.5) / 100"


def pct(cond: str) -> str:
    return f"COUNT_IF({cond}) * 100 / COUNT(*)"


def title_case(x: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all(lower({x}), '(\\p{{L}}+|[^\\p{{L}}]+)'), "
            f"lambda t: upper(t[1]) || t[2:]), '')")


def has_word(x: str, term: str) -> str:
    return f"regexp_matches({x}, {q('(?i)(^|' + NOT_WORD + ')' + re_quote(term) + '(' + NOT_WORD + '|$)')})"


def has_words(x: str, terms: Sequence[str]) -> str:
    alt = "|".join(re_quote(t) for t in terms)
    return f"regexp_matches({x}, {q('(?i)(^|' + NOT_WORD + ')(' + alt + ')(' + NOT_WORD + '|$)')})"


def has_any(x: str, keywords: Sequence[str]) -> str:
    alt = "|".join(re_quote(k) for k in keywords)
    return f"regexp_matches({x}, {q('(?i)(' + alt + ')')})"


def extract_skills_text(x: str, skills: Sequence[str]) -> str:
    parts = [f"CASE WHEN {has_word(f'COALESCE({x}, {q(str())})', s)} THEN {q(s)} END" for s in skills]
    return f"concat_ws(', ', {', '.join(parts)})"


def extract_skills_list(x: str, skills: Sequence[str]) -> str:
    parts = ", ".join(f"CASE WHEN {has_word(f'COALESCE({x}, {q(str())})', s)} THEN {q(s)} END" for s in skills)
    return f"list_filter([{parts}], lambda s: s IS NOT NULL)"


def split_skills(x: str, lower: bool = False) -> str:
    item = "lower(trim(s))" if lower else "trim(s)"
    return f"list_filter(list_transform(string_split(COALESCE({x}, ''), ','), lambda s: {item}), lambda s: s <> '')"


def blob(desc: str = "description", stack: str = "tech_stack") -> str:
    return f"lower(COALESCE({desc}, '') || ' ' || COALESCE({stack}, ''))"


def case_map(x: str, mapping: Mapping[str, str], default: str) -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in mapping.items())
    return f"CASE {x} {whens} ELSE {default} END"


def contract_label_exact(x: str, mapping: Mapping[str, str] = lexicon.CONTRACT_LABEL_MAP) -> str:
    raw = f"lower(trim(COALESCE({x}, 'Non précisé')))"
    chain = " ".join(f"WHEN contains({raw}, {q(k)}) THEN {q(v)}" for k, v in mapping.items())
    return f"COALESCE({case_map(raw, mapping, 'NULL')}, CASE {chain} ELSE 'Autre' END)"


def contract_label_substr(x: str, rules=lexicon.CONTRACT_SUBSTRING_RULES) -> str:
    v = f"lower(trim({x}))"
    chain = " ".join("WHEN " + " OR ".join(f"contains({v}, {q(f)})" for f in frags) + f" THEN {q(label)}"
                     for label, frags in rules)
    return f"CASE WHEN {x} IS NULL THEN 'Autre' {chain} ELSE 'Autre' END"


def normalize_contract(x: str, mapping: Mapping[str, str] = lexicon.CONTRACT_MAP) -> str:
    k = f"lower(trim({x}))"
    return f"COALESCE({case_map(k, mapping, 'NULL')}, {k})"


def normalize_city(x: str) -> str:
    t = title_case(f"trim({x})")
    junk = " OR ".join(f"contains({t}, {q(f)})" for f in lexicon.PLACE_JUNK_FRAGMENTS)
    step1 = f"(CASE WHEN {junk} THEN 'Non precise' ELSE {case_map(t, lexicon.CITY_ALIASES, t)} END)"
    step2 = f"(CASE WHEN regexp_matches({step1}, {q(lexicon.PARIS_DISTRICT_PATTERN)}) THEN 'Paris' ELSE {step1} END)"
    step3 = f"(CASE WHEN contains({step2}, ',') THEN trim(split_part({step2}, ',', 1)) ELSE {step2} END)"
    return f"CASE WHEN {x} IS NULL THEN 'Non precise' ELSE {step3} END"


def city_clean(x: str) -> str:
    return f"trim(split_part(COALESCE({x}, 'Non précisé'), ',', 1))"


def work_mode(text: str, patterns=lexicon.WORK_MODE_PATTERNS, unknown: str = lexicon.WORK_MODE_UNKNOWN) -> str:
    t = f"lower(COALESCE({text}, ''))"
    chain = " ".join(f"WHEN regexp_matches({t}, {q('(?i)' + p)}) THEN {q(label)}" for label, p in patterns)
    return f"CASE {chain} ELSE {q(unknown)} END"


def age_bucket(days: str) -> str:
    e, labs = lexicon.AGE_BUCKET_EDGES, lexicon.AGE_BUCKET_LABELS
    chain = " ".join(f"WHEN {days} > {lo} AND {days} <= {hi} THEN {q(lab)}" for lo, hi, lab in zip(e[:-1], e[1:], labs))
    return f"CASE {chain} END"


def is_filled(x: str) -> str:
    return f"({x} IS NOT NULL AND trim(CAST({x} AS VARCHAR)) <> '')"


def parse_salary_parts(raw: str) -> tuple[str, str, str]:
    """(min, max, currency) SQL expressions for the salary-text rule."""
    t = f"replace(replace(upper({raw}), chr(160), ' '), ',', '.')"
    pat = q(r"(\d[\d\s]*\.?\d*)\s*K?")
    full = f"regexp_extract_all({t}, {pat}, 0)"
    g1 = f"regexp_extract_all({t}, {pat}, 1)"
    val = (f"list_filter(list_transform({full}, lambda m, i: CASE WHEN contains(m, 'K') AND "
           f"TRY_CAST(replace({g1}[i], ' ', '') AS DOUBLE) < 1000 THEN TRY_CAST(replace({g1}[i], ' ', '') AS DOUBLE) * 1000 "
           f"ELSE TRY_CAST(replace({g1}[i], ' ', '') AS DOUBLE) END), lambda v: v IS NOT NULL)")
    blank = f"({raw} IS NULL OR trim({raw}) = '')"
    a = f"{val}[1]"
    b = f"(CASE WHEN len({val}) >= 2 THEN {val}[2] ELSE {val}[1] END)"
    lo = f"(CASE WHEN NOT {blank} AND len({val}) >= 1 THEN LEAST({a}, {b}) END)"
    hi = f"(CASE WHEN NOT {blank} AND len({val}) >= 1 THEN GREATEST({a}, {b}) END)"
    u = f"upper({raw})"
    cur = (f"(CASE WHEN {blank} THEN 'EUR' WHEN contains({u}, '$') OR contains({u}, 'USD') THEN 'USD' "
           f"WHEN contains({u}, '£') OR contains({u}, 'GBP') THEN 'GBP' WHEN contains({u}, 'CHF') THEN 'CHF' ELSE 'EUR' END)")
    return lo, hi, cur


def salary_avg(lo: str, hi: str) -> str:
    m = f"((COALESCE({lo}, {hi}) + COALESCE({hi}, {lo})) / 2)"
    return f"(CASE WHEN {m} > {lexicon.SALARY_OUTLIER_LOW} AND {m} < {lexicon.SALARY_OUTLIER_HIGH} THEN {m} END)"


# Entities that the test pages hold, decoded in the SQL restatement (&amp; last).
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"),
            ("&nbsp;", " "), ("&amp;", "&")]
