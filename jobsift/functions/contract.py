"""Contract Column functions: normalisation map, inference from text, report labels."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobsift import lexicon
from jobsift.functions.text import _WORD_AFTER, _WORD_BEFORE, quote_literal


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def _literal_map(mapping: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])


def normalize_contract(col: Column | str, mapping: Mapping[str, str] = lexicon.CONTRACT_MAP) -> Column:
    """lower(trim(x)) mapped to a label; unmapped values kept (lower/trimmed); null stays null."""
    k = F.lower(F.trim(_c(col)))
    return F.coalesce(F.try_element_at(_literal_map(mapping), k), k)


def _words_pattern(words: Sequence[str]) -> str:
    """Whole-word alternation of lower-cased words, applied to lower-cased text."""
    return f"{_WORD_BEFORE}(?:{'|'.join(quote_literal(w.lower()) for w in words)}){_WORD_AFTER}"


def infer_contract(contract: Column | str = "contract_type", title: Column | str = "title",
                   description: Column | str = "description",
                   stage_words: Sequence[str] = lexicon.STAGE_WORDS,
                   alternance_words: Sequence[str] = lexicon.ALTERNANCE_WORDS) -> Column:
    """Missing, CDI or CDD contracts become Alternance (priority) or Stage when the
    title+description mention them as whole words; others are kept."""
    text = F.lower(F.concat(F.coalesce(_c(title), F.lit("")), F.lit(" "), F.coalesce(_c(description), F.lit(""))))
    is_alt = text.rlike(_words_pattern(alternance_words))
    is_stage = text.rlike(_words_pattern(stage_words))
    c = _c(contract)
    return F.when(c.isNull() | c.isin("CDI", "CDD"),
                  F.when(is_alt, F.lit("Alternance")).when(is_stage, F.lit("Stage")).otherwise(c)
                  ).otherwise(c)


def contract_label_exact(col: Column | str, mapping: Mapping[str, str] = lexicon.CONTRACT_LABEL_MAP,
                         missing: str = "Non précisé", other: str = lexicon.CONTRACT_OTHER) -> Column:
    """Exact key first, then the first key (map order) contained in the value.

    Null counts as ``missing``. With the default map the '' key is contained in
    everything, so every unmatched value becomes 'Non précisé'.
    """
    raw = F.lower(F.trim(F.coalesce(_c(col), F.lit(missing))))
    chain = None
    for k, label in mapping.items():
        cond = raw.contains(k)
        chain = F.when(cond, F.lit(label)) if chain is None else chain.when(cond, F.lit(label))
    return F.coalesce(F.try_element_at(_literal_map(mapping), raw), chain.otherwise(F.lit(other)))


def contract_label_substr(col: Column | str,
                          rules: Sequence[tuple[str, Sequence[str]]] = lexicon.CONTRACT_SUBSTRING_RULES,
                          other: str = lexicon.CONTRACT_OTHER) -> Column:
    """First rule whose fragment is contained in lower(trim(x)); null/unmatched -> 'Autre'."""
    v = F.lower(F.trim(_c(col)))
    chain = None
    for label, frags in rules:
        cond = None
        for f in frags:
            cond = v.contains(f) if cond is None else (cond | v.contains(f))
        chain = F.when(cond, F.lit(label)) if chain is None else chain.when(cond, F.lit(label))
    return F.when(v.isNull(), F.lit(other)).otherwise(chain.otherwise(F.lit(other)))
