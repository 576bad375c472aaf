"""Time Column functions. ``as_of`` is always an argument: no clock reads inside."""
from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobsift import lexicon

MICROS_PER_DAY = 86_400_000_000


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def as_of_literal(as_of: str | _dt.datetime | Column) -> Column:
    """A wall-clock instant without zone (UTC by convention)."""
    if isinstance(as_of, Column):
        return as_of.cast("timestamp_ntz")
    if isinstance(as_of, _dt.datetime):
        as_of = as_of.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(as_of).cast("timestamp_ntz")


EPOCH = "1970-01-01 00:00:00"
_ZONED = r"\d{2}:\d{2}(:\d{2}(\.\d+)?)?\s*(?i:z|[+-]\d{2}(:?\d{2})?)$"


def utc_wallclock(col: Column | str) -> Column:
    """UTC wall clock (timestamp_ntz) of an instant (timestamp), whatever the session zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_c(col)), F.lit(EPOCH).cast("timestamp_ntz"))


#: Shapes beyond ISO 8601 that feeds write: day first, basic ISO, RFC 2822 (its weekday is skipped) and month names.
COMMON_DATE_FORMATS = ("dd/MM/yyyy[ HH:mm[:ss]]", "yyyyMMdd", "d MMM yyyy HH:mm[:ss][ XX]", "MMMM d, yyyy", "MMM d, yyyy", "d MMMM yyyy")
WEEKDAY_EN = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")
_WEEKDAY = r"^(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun)[a-z]*,\s*"


def normalize_date(col: Column | str, formats: Sequence[str] = ()) -> Column:
    """Parse text to a UTC wall-clock timestamp (timestamp_ntz); unparseable -> null.
    ``formats`` (datetime patterns, tried in order, e.g. COMMON_DATE_FORMATS) read what is not ISO 8601.

    Text with an explicit zone (Z, +02:00) is read as that instant; text without a
    zone is taken as UTC. The result does not depend on the session time zone.
    """
    s = _c(col).cast("string")
    basic = s.rlike(r"^\d{8}$")                    # eight digits: a year to the engine, a date to people
    iso = F.when(s.rlike(_ZONED), utc_wallclock(F.try_to_timestamp(s))).when(~basic if formats else F.lit(True), s.try_cast("timestamp_ntz"))
    plain = F.regexp_replace(s, _WEEKDAY, "")

    def read(f: str) -> Column:
        if "X" in f:                               # a zone, if there is one, else UTC
            zoned, bare = f.replace("[ XX]", " XX"), f.replace("[ XX]", "")
            return F.coalesce(utc_wallclock(F.try_to_timestamp(F.regexp_replace(plain, r"GMT$", "+0000"), F.lit(zoned))),
                              F.to_timestamp_ntz(F.when(F.try_to_timestamp(plain, F.lit(bare)).isNotNull(), plain), F.lit(bare)))
        return F.to_timestamp_ntz(F.when(F.try_to_timestamp(plain, F.lit(f)).isNotNull(), plain), F.lit(f))

    return F.coalesce(iso, *[read(f) for f in formats])


def publication_date(col: Column | str) -> Column:
    return F.to_date(_c(col))


def publication_hour(col: Column | str) -> Column:
    return F.hour(_c(col))


def publication_weekday(col: Column | str) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(_c(col))


def publication_month(col: Column | str) -> Column:
    """'yyyy-MM'."""
    return F.date_format(_c(col), "yyyy-MM")


def weekday_label_fr(weekday: Column | str, labels: Sequence[str] = lexicon.WEEKDAY_FR) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in labels]), _c(weekday) + 1)


def age_micros(col: Column | str, as_of) -> Column:
    """Whole microseconds from ``col`` to ``as_of`` (exact, bigint)."""
    return F.timestamp_diff("MICROSECOND", _c(col).cast("timestamp_ntz"), as_of_literal(as_of))


def age_days(col: Column | str, as_of) -> Column:
    """Fractional days from ``col`` to ``as_of``."""
    return age_micros(col, as_of) / F.lit(MICROS_PER_DAY)


def age_whole_days(col: Column | str, as_of) -> Column:
    """Whole days (floor), as the exploration's day count."""
    return F.floor(age_micros(col, as_of) / F.lit(MICROS_PER_DAY)).cast("bigint")


def age_bucket(age: Column | str, edges: Sequence[float] = lexicon.AGE_BUCKET_EDGES,
               labels: Sequence[str] = lexicon.AGE_BUCKET_LABELS) -> Column:
    """Right-closed bins (e0, e1], (e1, e2], ...; outside -> null."""
    a = _c(age)
    out = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (a > lo) & (a <= hi)
        out = F.when(cond, F.lit(lab)) if out is None else out.when(cond, F.lit(lab))
    return out
