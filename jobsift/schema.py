"""Explicit read schemas for the raw feeds and the cleaned table (no inference pass)."""
from __future__ import annotations

from pyspark.sql import types as T

_S, _D, _I = T.StringType(), T.DoubleType(), T.IntegerType()


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(k, v, True) for k, v in fields.items()])


# one API posting (nested objects as the API returns them)
API_POSTING = _struct(
    id=_S, title=_S, description=_S, created=_S, redirect_url=_S,
    company=_struct(display_name=_S),
    location=_struct(display_name=_S, area=T.ArrayType(_S)),
    category=_struct(label=_S, tag=_S),
    contract_type=_S, contract_time=_S, salary_min=_D, salary_max=_D,
    latitude=_D, longitude=_D,
)

# one scraped posting: eight strings
SCRAPED_POSTING = _struct(title=_S, company=_S, location=_S, remote=_S, contract_type=_S, salary=_S, url=_S,
                          description=_S)

# third-source posting: every synonym the cleaning maps, as text (CSV has no types)
THIRD_POSTING = _struct(**{name: _S for name in [
    "title", "job_title", "titre_poste", "company_name", "entreprise", "location", "ville", "contract_type",
    "type_contrat", "salary", "salaire", "description", "published_at", "date_publication", "url", "link"]})


def envelope(record: T.StructType) -> T.StructType:
    """{source, country, search_query, page, fetched_at, data: record}, plus the record's
    own fields at top level for lines written without an envelope."""
    fields = [T.StructField("source", _S), T.StructField("country", _S), T.StructField("search_query", _S),
              T.StructField("page", _I), T.StructField("fetched_at", _S), T.StructField("data", record)]
    names = {f.name for f in fields}
    return T.StructType(fields + [f for f in record.fields if f.name not in names])


RAW_API = envelope(API_POSTING)
RAW_SCRAPED = envelope(SCRAPED_POSTING)
RAW_THIRD = THIRD_POSTING

CLEAN = T.StructType([
    T.StructField("title", _S), T.StructField("company", _S), T.StructField("city", _S),
    T.StructField("contract_type", _S), T.StructField("salary_min", _D), T.StructField("salary_max", _D),
    T.StructField("salary_avg", _D), T.StructField("currency", _S), T.StructField("description", _S),
    T.StructField("category", _S), T.StructField("published_at", T.TimestampNTZType()), T.StructField("url", _S),
    T.StructField("source", _S), T.StructField("tech_stack", _S), T.StructField("collected_at", T.TimestampNTZType()),
])
