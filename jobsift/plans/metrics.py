"""Metric queries over a table of samples (series, ts, value): counter rate,
ratio of two gauges, sustained thresholds, two-sample CPU %, usage %.

Per-series order matters for all of them. Rows are sorted once over the cluster
and cut into ranges by number (``operators.scan``), so neither a series that holds
a third of all samples nor a minute that does is one task. Samples of a series at
the same time are ordered by a tie column and then by value.

All money-like values are whole cents, so sums are exact and order-free.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsift.functions.salary import to_cents
from jobsift.operators.scan import prefix_scan

MICROS = 1_000_000
EPOCH = "1970-01-01 00:00:00"


def _micros(ts: str) -> Column:
    """Microseconds since the epoch of a wall-clock time (no zone involved)."""
    return F.timestamp_diff("MICROSECOND", F.lit(EPOCH).cast("timestamp_ntz"), F.col(ts).cast("timestamp_ntz"))


def with_previous(samples: DataFrame, series: str, ts: str, cols: list[str], tie: tuple[str, ...] = (), ranges: int | None = None) -> DataFrame:
    """Add ``_us``, ``_pos`` and ``_prev_<c>`` (and ``_prev_us``): the series' previous sample by (ts, tie, cols)."""
    df = samples.withColumn("_us", _micros(ts))
    out = prefix_scan(df, series, ["_us", *dict.fromkeys((*tie, *cols))], lags=("_us", *cols), ranges=ranges)
    return out.withColumnRenamed("_prev__us", "_prev_us")


def counter_rate(samples: DataFrame, series: str = "user_id", ts: str = "ts", value: str = "value",
                 window_seconds: int = 300, id_col: str = "event_id", carry: tuple[str, ...] = (), scale: int = 6,
                 ranges: int | None = None) -> DataFrame:
    """Per-second increase of a counter over the trailing window (ts - window, ts],
    counting only increases between samples that are both inside the window; a drop
    is a reset (the new value is the increase). No extrapolation to window edges.
    Samples of one time are ordered by id, then value; all of them are inside the window of each.

    Returns (id, series, carry.., rate_cents, rate): the summed increase in units of
    10^-scale (millionths by default; scale 2 is cents)
    and rate = increase / window. ``carry`` columns come along.

    An increase counts from its later sample's time on, until its earlier sample
    leaves the window. So a rate is one running sum over the times at which
    increases come and go, read where the samples are: no row looks back over its window.
    """
    base = samples.select(*dict.fromkeys((id_col, series, ts, *carry)), to_cents(value, scale).alias("cents"))
    prev = with_previous(base, series, ts, ["cents"], (id_col,), ranges)
    inc = F.when(F.col("cents") >= F.col("_prev_cents"), F.col("cents") - F.col("_prev_cents")).otherwise(F.col("cents"))
    rows = prev.select(id_col, series, *carry, "_us", F.col("_pos").alias("_row"),
                       F.when(F.col("_prev_cents").isNotNull(), F.struct(inc.alias("inc"), F.col("_prev_us").alias("us"))).alias("_step"))
    win = window_seconds * MICROS
    # What happens when: an increase comes (0) or goes (0); a sample asks for the sum (1), after all that happens at its time.
    gone = [F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in (id_col, *carry)]
    change = rows.where("_step IS NOT NULL").select(*gone, series, F.inline(F.array(
        F.struct(F.col("_us").alias("_at"), F.col("_step.inc").alias("_change")),
        F.struct((F.col("_step.us") + win).alias("_at"), (-F.col("_step.inc")).alias("_change")))))
    change = change.select(id_col, series, *carry, "_at", "_change", F.lit(0).alias("_kind"), F.lit(None).cast("long").alias("_row"))
    ask = rows.select(id_col, series, *carry, F.col("_us").alias("_at"), F.lit(0).cast("long").alias("_change"), F.lit(1).alias("_kind"), "_row")
    told = prefix_scan(change.unionByName(ask), series, ["_at", "_kind", "_row"], sums=("_change",), ranges=ranges).where("_kind = 1")
    num = F.col("_sum__change")
    return told.select(id_col, series, *carry, num.alias("rate_cents"), (num / (window_seconds * 10 ** scale)).alias("rate"))


def rate_by_label(rates: DataFrame, label: str, window_seconds: int = 300, scale: int = 6) -> DataFrame:
    """Mean rate per label (``avg by (label)``) over all samples, exact. The label is carried by ``counter_rate``."""
    return rates.groupBy(label).agg((F.sum(F.col("rate_cents").cast("decimal(38,0)")).cast("double")
                                     / (F.count(F.lit(1)) * window_seconds * 10 ** scale)).alias("mean_rate"))


def rate_by_label_over_time(rates: DataFrame, label: str, ts: str = "ts", step: str = "hour", window_seconds: int = 300,
                            scale: int = 6) -> DataFrame:
    """(label, step_start, mean_rate): ``avg by (label)`` as a series of steps; label and ``ts`` are carried by ``counter_rate``."""
    return (rates.groupBy(label, step_start(ts, step).alias("step_start"))
            .agg((F.sum(F.col("rate_cents").cast("decimal(38,0)")).cast("double")
                  / (F.count(F.lit(1)) * window_seconds * 10 ** scale)).alias("mean_rate")))


STEP_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def step_start(ts: str, step: str) -> Column:
    """Start of the fixed-length step containing ``ts`` (zone-free wall clock)."""
    size = STEP_SECONDS[step] * MICROS
    return F.timestamp_add("MICROSECOND", F.floor(_micros(ts) / size) * size, F.lit(EPOCH).cast("timestamp_ntz"))


def usage_ratio(samples: DataFrame, available: str, total: str, series: str = "user_id", ts: str = "ts",
                name: str = "event_type", value: str = "value", step: str = "minute") -> DataFrame:
    """(1 - available / total) * 100 from two gauges sampled in the same step."""
    t = step_start(ts, step)
    g = samples.groupBy(series, t.alias("step_start")).agg(
        F.max(F.when(F.col(name) == available, F.col(value))).alias("available"),
        F.max(F.when(F.col(name) == total, F.col(value))).alias("total"))
    return (g.filter(F.col("available").isNotNull() & (F.col("total") > 0))
             .select(series, "step_start", ((F.lit(1) - F.col("available") / F.col("total")) * 100).alias("usage_pct")))


def _gap(max_gap_seconds: float | None) -> Column:
    if max_gap_seconds is None:
        return F.lit(False)
    return F.coalesce(F.col("_us") - F.col("_prev_us") > int(max_gap_seconds * MICROS), F.lit(False))


def sustained_threshold(samples: DataFrame, threshold: float, for_seconds: int, severity: str,
                        series: str = "user_id", ts: str = "ts", value: str = "value",
                        max_gap_seconds: float | None = None, ranges: int | None = None) -> DataFrame:
    """Runs of consecutive samples above ``threshold`` lasting at least ``for_seconds``
    (first to last sample of the run): (series, start, end, n, severity).

    Two samples more than ``max_gap_seconds`` apart (the source's staleness) are of
    different runs. Of samples at one time, those not above the threshold come first. A run is named by the
    last row that broke one: the value that a scan carries along.
    """
    ok = F.col(value) <= threshold
    base = samples.select(series, ts, value)
    if max_gap_seconds is None:
        rows = base.withColumn("_us", _micros(ts))
    else:
        rows = with_previous(base, series, ts, [value], ranges=ranges).drop("_pos")
    # The row's place among all rows is not known before the sort, so the name is its time and, among equal times, its value.
    name = F.when(ok | _gap(max_gap_seconds), F.struct(F.col("_us").alias("us"), F.col(value).alias("v")))
    marked = prefix_scan(rows.withColumn("_break", name), series, ["_us", value], lasts=("_break",), ranges=ranges).where(~ok)
    g = marked.groupBy(series, "_last__break").agg(F.min(ts).alias("start"), F.max(ts).alias("end"),
                                                   F.count(F.lit(1)).alias("n"), (F.max("_us") - F.min("_us")).alias("_dur"))
    return (g.filter(F.col("_dur") >= for_seconds * MICROS)
             .select(series, "start", "end", "n", F.lit(severity).alias("severity")))


def threshold_runs(rows: DataFrame, for_seconds: float, max_gap_seconds: float | None = None, ranges: int | None = None) -> DataFrame:
    """Runs of rows (series, us, above, start_us, n, fired): one row (series, start_us, last_us, n, fired, fired_us, is_open) each.

    fired_us is the time of the first sample at which the run has lasted
    ``for_seconds``, null if it has not; is_open tells that no sample of the series
    follows. A row may stand for an earlier part of a run, which began at its start_us. Of rows at one time,
    those not above come first.
    """
    first = prefix_scan(rows.withColumn("_us", F.col("us")), "series", ["_us", "above", "start_us"], lags=("_us", "above"), ranges=ranges)
    first = first.withColumnRenamed("_prev__us", "_prev_us")
    begins = F.col("above") & (~F.coalesce("_prev_above", F.lit(False)) | _gap(max_gap_seconds))
    marked = first.withColumn("_run", F.when(begins, F.struct("_pos", "start_us"))).drop("_prev_us", "_prev_above").where("above")
    named = prefix_scan(marked.withColumnRenamed("_pos", "_row"), "series", ["_row"], lasts=("_run",), ranges=ranges)
    lasted = F.col("us") - F.col("_last__run.start_us") >= int(for_seconds * MICROS)
    runs = named.groupBy("series", "_last__run").agg(
        F.min("start_us").alias("start_us"), F.max("us").alias("last_us"), F.sum("n").alias("n"), F.max("fired").alias("fired"),
        F.min(F.when(lasted, F.col("us"))).alias("fired_us"))
    newest = first.groupBy("series").agg(F.max("us").alias("_newest"))      # from the stored scan: ``rows`` may be dear to make
    return (runs.join(newest, "series")
            .select("series", "start_us", "last_us", "n", "fired", "fired_us", (F.col("last_us") == F.col("_newest")).alias("is_open")))


def fired_alerts(samples: DataFrame, threshold: float, for_seconds: float, severity: str, series: str = "user_id", ts: str = "ts",
                 value: str = "value", max_gap_seconds: float | None = None, ranges: int | None = None) -> DataFrame:
    """(series, start, fired_at, severity): when the rule fires, over a table of samples. Series are text."""
    rows = samples.select(F.col(series).cast("string").alias("series"), _micros(ts).alias("us"), F.col(value).cast("double").alias("v")).dropna()
    rows = rows.select("series", "us", (F.col("v") > threshold).alias("above"), F.col("us").alias("start_us"), F.lit(1).cast("long").alias("n"), F.lit(False).alias("fired"))
    epoch = F.lit(EPOCH).cast("timestamp_ntz")
    return (threshold_runs(rows, for_seconds, max_gap_seconds, ranges).where("fired_us is not null")
            .select("series", F.timestamp_add("MICROSECOND", F.col("start_us"), epoch).alias("start"),
                    F.timestamp_add("MICROSECOND", F.col("fired_us"), epoch).alias("fired_at"), F.lit(severity).alias("severity")))


def busy_percent(rates: DataFrame, rate: str = "rate") -> DataFrame:
    """``100 - rate * 100`` of an idle counter, as column ``busy_pct``."""
    return rates.withColumn("busy_pct", F.lit(100.0) - F.col(rate) * 100)


def delta_percent(samples: DataFrame, series: str = "user_id", ts: str = "ts", value: str = "value",
                  cpus: Column | None = None, id_col: str = "event_id", scale: int = 6, ranges: int | None = None) -> DataFrame:
    """Two-sample CPU %: delta(value) / delta(seconds) * cpus * 100 when both deltas
    allow it (time advanced, value did not drop), else 0. Samples of one time are ordered by id, then value."""
    base = samples.select(id_col, series, ts, to_cents(value, scale).alias("cents"),
                          (cpus if cpus is not None else F.lit(1)).cast("bigint").alias("_cpus"))
    prev = with_previous(base, series, ts, ["cents"], (id_col,), ranges)
    dc = F.col("cents") - F.col("_prev_cents")
    dt = F.col("_us") - F.col("_prev_us")
    pct = F.when(F.col("_prev_us").isNotNull() & (dt > 0) & (dc >= 0),
                 (dc * MICROS * F.col("_cpus")) / dt / 10 ** (scale - 2)).otherwise(F.lit(0.0))
    return prev.select(id_col, series, pct.alias("cpu_pct"))


def usage_percent(samples: DataFrame, used: str = "value", limit: Column | None = None,
                  interfaces: Column | None = None, id_col: str = "event_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, carry.., mem_pct, net_total): used / limit * 100 (0 without a limit), and the sum over interface counters."""
    lim = limit if limit is not None else F.lit(None).cast("bigint")
    pct = F.when(lim > 0, to_cents(used) / lim).otherwise(F.lit(0.0))
    total = (F.aggregate(interfaces, F.lit(0).cast("bigint"), lambda a, x: a + x)
             if interfaces is not None else F.lit(None).cast("bigint"))
    return samples.select(id_col, *carry, pct.alias("mem_pct"), total.alias("net_total"))
