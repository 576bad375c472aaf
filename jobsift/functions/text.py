"""Text Column functions: title case, keys, keyword and skill search, work mode.

All of them are compositions of built-in expressions (regexp, string and
higher-order array functions): they run in the JVM inside whole-stage-codegen
stages (higher-order functions evaluate their lambdas on their interpreted path
within the generated code), with no Python worker.
"""
from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobsift import lexicon

# A word edge that knows accented letters: the character before/after is not a
# letter, digit or underscore. Used instead of \b so the meaning does not depend
# on the JVM's default for Unicode word boundaries.
_WORD_BEFORE = r"(?<![\p{L}\p{N}_])"
_WORD_AFTER = r"(?![\p{L}\p{N}_])"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def quote_literal(term: str) -> str:
    """Regex-quote a literal for a Java pattern."""
    return re.sub(r"([\\.^$|?*+()\[\]{}\-/#&~<>!=:,'\"% @])", r"\\\1", term)


def title_case(col: Column | str) -> Column:
    """Upper-case the first letter of every run of letters, lower-case the rest.

    Unlike ``initcap`` (which only splits on spaces) this treats every non-letter as
    a word break: ``ile-de-france`` -> ``Ile-De-France``, ``d'azur`` -> ``D'Azur``,
    ``1er`` -> ``1Er``.
    """
    tokens = F.regexp_extract_all(F.lower(_c(col)), F.lit(r"(\p{L}+|[^\p{L}]+)"), 0)
    return F.when(_c(col).isNull(), F.lit(None).cast("string")).otherwise(
        F.array_join(
            F.transform(tokens, lambda t: F.concat(F.upper(F.substring(t, 1, 1)), F.substring(t, 2, 1 << 30))),
            "",
        )
    )


def norm_key(col: Column | str) -> Column:
    """lower(trim(x)) with null as ''."""
    return F.lower(F.trim(F.coalesce(_c(col).cast("string"), F.lit(""))))


def dedup_key_part(col: Column | str) -> Column:
    """Cleaning-dedup key part: lower(trim(x)), null as the text 'nan'."""
    return F.coalesce(F.lower(F.trim(_c(col).cast("string"))), F.lit("nan"))


def is_filled(col: Column | str) -> Column:
    """Not null and not blank after trimming its text form."""
    c = _c(col)
    return c.isNotNull() & (F.trim(c.cast("string")) != F.lit(""))


def text_blob(description: Column | str = "description", tech_stack: Column | str = "tech_stack") -> Column:
    """lower(description || ' ' || tech_stack), nulls as ''."""
    return F.lower(F.concat(F.coalesce(_c(description), F.lit("")), F.lit(" "),
                            F.coalesce(_c(tech_stack), F.lit(""))))


def keyword_pattern(keywords: Sequence[str], match: str = "substring") -> str:
    """One alternation over lower-cased literal keywords (applied to lower-cased text)."""
    alt = "|".join(quote_literal(k.lower()) for k in keywords)
    if match == "word":
        return f"{_WORD_BEFORE}(?:{alt}){_WORD_AFTER}"
    return f"(?:{alt})"


def has_any_keyword(col: Column | str, keywords: Sequence[str], match: str = "substring",
                    assume_lower: bool = False) -> Column:
    """True when any keyword occurs, case-insensitively (substring by default, as the
    reports count). The text is lower-cased once (not at all with ``assume_lower``,
    e.g. for a text blob); substrings use a plain string search, whole words one
    regex without case folding (much cheaper than ``(?i)``)."""
    low = _c(col) if assume_lower else F.lower(_c(col))
    if match == "word":
        return F.coalesce(low.rlike(keyword_pattern(keywords, "word")), F.lit(False))
    cond = None
    for k in keywords:
        c = low.contains(k.lower())
        cond = c if cond is None else (cond | c)
    return F.coalesce(cond, F.lit(False))


def has_word(col: Column | str, term: str, assume_lower: bool = False) -> Column:
    """Whole-word, case-insensitive match of one term."""
    return has_any_keyword(col, [term], match="word", assume_lower=assume_lower)


def split_skills(col: Column | str, lower: bool = False) -> Column:
    """Split a ', '-joined list: trim items, drop empties; optionally lower-case."""
    items = F.transform(F.split(F.coalesce(_c(col), F.lit("")), ","), lambda s: F.trim(s))
    if lower:
        items = F.transform(items, lambda s: F.lower(s))
    return F.filter(items, lambda s: s != F.lit(""))


def _is_single_word(term: str) -> bool:
    return re.fullmatch(r"[^\W]+", term) is not None


def extract_skills(col: Column | str, skills: Sequence[str] = lexicon.TECH_SKILLS) -> Column:
    """Skills found as whole words (case-insensitive), distinct, in list order.

    The text is lower-cased once. Skills made only of word characters ("python",
    "r") are found by splitting the text into words once and intersecting with the
    skill set (a hash lookup per word; whole-word match and word equality are the
    same thing). Skills with other characters ("power bi", "ci/cd") are first looked
    for as plain substrings, and only where present checked with their word-bounded
    pattern. A match is mapped back to its list position by a literal map; the
    result is ordered by that position. No regex pass per skill over every text.
    """
    skills = list(skills)
    low_skills = [x.lower() for x in skills]
    pos = F.create_map(*[x for i, s in enumerate(low_skills) for x in (F.lit(s), F.lit(i))])
    canon = F.array(*[F.lit(s) for s in skills])
    text = F.lower(F.coalesce(_c(col), F.lit("")))
    single = sorted({s for s in low_skills if _is_single_word(s)})
    multi = [s for s in dict.fromkeys(low_skills) if not _is_single_word(s)]
    parts = []
    if single:
        words = F.split(text, r"[^\p{L}\p{N}_]+")
        parts.append(F.array_intersect(words, F.array(*[F.lit(s) for s in single])))
    if multi:
        hits = [F.when(text.contains(s) & text.rlike(f"{_WORD_BEFORE}{quote_literal(s)}{_WORD_AFTER}"), F.lit(s))
                for s in multi]
        parts.append(F.filter(F.array(*hits), lambda x: x.isNotNull()))
    found = parts[0] if len(parts) == 1 else F.concat(*parts)
    idx = F.array_sort(F.array_distinct(F.transform(found, lambda m: F.try_element_at(pos, m))))
    return F.transform(idx, lambda i: F.element_at(canon, i + 1))


def extract_skills_text(col: Column | str, skills: Sequence[str] = lexicon.TECH_SKILLS) -> Column:
    """``extract_skills`` joined with ', '; '' when none or when the text is null/empty."""
    return F.array_join(extract_skills(col, skills), ", ")


def detect_work_mode(text: Column,
                     patterns: Sequence[tuple[str, str]] = lexicon.WORK_MODE_PATTERNS,
                     unknown: str = lexicon.WORK_MODE_UNKNOWN) -> Column:
    """First label whose pattern matches (without regard to case), else ``unknown``.
    The text is bound once (``let``); the pattern itself is never changed."""
    from jobsift.functions._let import let

    def chain(t):
        out = None
        for label, pat in patterns:
            cond = t.rlike(f"(?iU){pat}")
            out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
        return out.otherwise(F.lit(unknown))

    return let(F.coalesce(text, F.lit("")), chain)


def work_mode_text(description: Column | str = "description", title: Column | str = "title") -> Column:
    """description || ' ' || title, nulls as the text 'None' is avoided: nulls as ''."""
    return F.concat(F.coalesce(_c(description), F.lit("")), F.lit(" "), F.coalesce(_c(title), F.lit("")))


def truncate_text(col: Column | str, n: int) -> Column:
    """First ``n`` characters."""
    return F.substring(_c(col), 1, n)
