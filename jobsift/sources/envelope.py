"""The ingest envelope: {source, country, search_query, page, fetched_at, data:{record}}."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsift.functions.time import as_of_literal, utc_wallclock
from jobsift.operators.clean import flatten_struct, unwrap_envelope  # noqa: F401  (re-exported)

FETCHED_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def wrap_envelope(df: DataFrame, source: str, country: str = "fr", search_query: str = "data scientist",
                  page=1, fetched_at=None) -> DataFrame:
    """Nest each record under ``data`` with the envelope fields. ``fetched_at`` is the
    fetch instant (UTC); pass it explicitly for reproducible output."""
    ts = as_of_literal(fetched_at) if fetched_at is not None else utc_wallclock(F.current_timestamp())
    page_col = page if not isinstance(page, int) else F.lit(page)
    return df.select(F.lit(source).alias("source"), F.lit(country).alias("country"),
                     F.lit(search_query).alias("search_query"), page_col.cast("int").alias("page"),
                     F.date_format(ts, FETCHED_FORMAT).alias("fetched_at"),
                     F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("data"))


def to_json_lines(df: DataFrame) -> DataFrame:
    """One JSON text per row (column ``value``), ready for a text, Kafka or file sink."""
    return df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("value"))
