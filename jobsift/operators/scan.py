"""Prefix scans along ordered series: previous value, running sum, last known value.

``Window.partitionBy(series)`` puts a series into one task, and cutting it by time
puts a busy minute into one. Here rows are cut by number: they are sorted by
(series, order) over the whole cluster, so a range of the sort holds about as
many rows as any other, whatever the series and times in it. Each task scans its
range as it is written. Only the first series of a range can have begun earlier,
so what a range needs to know is one row of carried state; these rows, as many as
ranges, are folded in range order and joined back to the ranges by number.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsift.session import materialize


class _Series:
    """Scan state of one range between Arrow batches: the open series and its last values."""

    def __init__(self):
        self.started = False
        self.head = True                # still in the first series of the range
        self.series = None
        self.lags: dict[str, pa.Array] = {}
        self.sums: dict[str, int] = {}
        self.lasts: dict[str, pa.Array] = {}


def _changes(column: pa.Array) -> np.ndarray:
    """True where a value differs from the one before it (nulls are equal); the first entry is False."""
    codes = pd.factorize(column.to_pandas(), use_na_sentinel=False)[0]
    out = np.zeros(len(codes), bool)
    out[1:] = codes[1:] != codes[:-1]
    return out


def _plain(column) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _scan_batch(b: pa.RecordBatch, state: _Series, series: str, lags: list[str], sums: list[str], lasts: list[str]) -> list[pa.Array]:
    """The scans of one batch, in the order lags, sums, lasts, then flags (edge, head); ``state`` moves on."""
    n, keys = b.num_rows, _plain(b.column(series))
    new = _changes(keys)
    edge = np.zeros(n, bool)
    if not state.started:
        edge[0] = True
    else:
        before, now = state.series, keys[0].as_py()
        new[0] = not (before == now or before is None and now is None)
    continues = state.started and not new[0]
    head = np.logical_and.accumulate(~new) & state.head
    run = np.cumsum(new)                                   # which series of the batch a row is in; 0 goes on from before
    begin = np.flatnonzero(new)
    start = np.zeros(n, np.int64)
    start[begin] = begin
    start = np.maximum.accumulate(start)                   # first row of the row's series in this batch
    out = []
    for c in lags:
        col = _plain(b.column(c))
        at = np.arange(n) - 1
        none = new | (at < 0)
        shifted = col.take(pa.array(np.where(none, 0, at), mask=none))
        if continues:
            shifted = pa.concat_arrays([state.lags[c].cast(col.type), shifted[1:]])
        state.lags[c] = col[n - 1:n]
        out.append(shifted)
    for c in sums:
        values = _plain(b.column(c)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        total = np.cumsum(values)
        base = np.where(start > 0, total[start - 1], 0)
        total = total - base
        if continues:
            total[run == 0] += state.sums[c]
        state.sums[c] = int(total[-1])
        out.append(pa.array(total))
    for c in lasts:
        col = _plain(b.column(c))
        known = np.where(col.is_valid().to_numpy(zero_copy_only=False), np.arange(n), -1)
        known = np.maximum.accumulate(known)
        none = known < start
        filled = col.take(pa.array(np.where(none, 0, known), mask=none))
        if continues and state.lasts[c][0].is_valid:
            early = int((none & (run == 0)).sum())          # rows of the open series before its first value here
            filled = pa.concat_arrays([pa.concat_arrays([state.lasts[c].cast(col.type)] * early), filled[early:]]) if early else filled
        state.lasts[c] = filled[n - 1:n]
        out.append(filled)
    state.head = bool(head[-1])
    state.started, state.series = True, keys[n - 1].as_py()
    return [*out, pa.array(edge), pa.array(head)]


def prefix_scan(df: DataFrame, series: str, order: list[str], lags: tuple[str, ...] = (), sums: tuple[str, ...] = (),
                lasts: tuple[str, ...] = (), ranges: int | None = None) -> DataFrame:
    """``df`` with ``_prev_<c>`` for each of ``lags``, ``_sum_<c>`` for ``sums`` and ``_last_<c>`` for ``lasts``.

    * ``_prev_<c>``: c of the row before in the series (null for the first).
    * ``_sum_<c>``: the sum of c, a long, up to and with the row; null counts as zero.
    * ``_last_<c>``: the last c that is not null, up to and with the row.

    Rows of a series are ordered by ``order``, which should name the row as well: rows equal in series and all of
    ``order`` come in any order. A null series is a series. ``_pos`` numbers the rows in that order over all series.
    ``ranges``: how many ranges the sort makes (default: the session's shuffle partitions, merged where small).
    The sorted rows are stored once, under the shared folder.
    """
    spark = df.sparkSession
    keys = [series, *order, "_salt"]
    salted = df.withColumn("_salt", F.monotonically_increasing_id())
    ordered = salted.repartitionByRange(ranges, *keys) if ranges else salted.repartitionByRange(*keys)
    ordered = ordered.sortWithinPartitions(*keys).drop("_salt").withColumn("_pos", F.monotonically_increasing_id())
    added = [*(f"_prev_{c}" for c in lags), *(f"_sum_{c}" for c in sums), *(f"_last_{c}" for c in lasts)]
    types = [*(df.schema[c].dataType for c in lags), *("bigint" for _ in sums), *(df.schema[c].dataType for c in lasts)]

    def run(batches):
        state = _Series()
        for b in batches:
            if b.num_rows:
                scanned = _scan_batch(b, state, series, list(lags), list(sums), list(lasts))
                yield pa.RecordBatch.from_arrays([*b.columns, *scanned], names=[*b.schema.names, *added, "_edge", "_head"])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ordered.schema.fields)
    ddl += "".join(f", `{n}` {t if isinstance(t, str) else t.simpleString()}" for n, t in zip(added, types)) + ", _edge boolean, _head boolean"
    rows = materialize(ordered.mapInArrow(run, ddl), "scan").withColumn("_part", F.shiftright("_pos", 33))
    carry = _carry(rows, series, lags, sums, lasts, types)
    if carry is None:
        return rows.drop("_edge", "_head", "_part")
    rows = rows.join(F.broadcast(carry), F.col("_part") == F.col("_to"), "left")          # one row a range
    for c in lags:
        rows = rows.withColumn(f"_prev_{c}", F.when(F.col("_edge"), F.col(f"_c.{_name('prev', c)}")).otherwise(F.col(f"_prev_{c}")))
    for c in sums:
        rows = rows.withColumn(f"_sum_{c}", F.col(f"_sum_{c}") + F.when(F.col("_head"), F.coalesce(f"_c.{_name('sum', c)}", F.lit(0))).otherwise(0))
    for c in lasts:
        late = F.col("_head") & F.col(f"_last_{c}").isNull()
        rows = rows.withColumn(f"_last_{c}", F.when(late, F.col(f"_c.{_name('last', c)}")).otherwise(F.col(f"_last_{c}")))
    return rows.drop("_edge", "_head", "_part", "_to", "_c")


def _name(kind: str, c: str) -> str:
    return f"{kind}_{c}".replace(".", "_")


def _carry(rows: DataFrame, series: str, lags, sums, lasts, types) -> DataFrame | None:
    """(_to, _c): the state with which each range that goes on with an earlier series begins; None if there is none."""
    last = F.struct(F.col(series).alias("series"), "_head", *[F.col(c).alias(_name("prev", c)) for c in lags],
                    *[F.col(f"_sum_{c}").alias(_name("sum", c)) for c in sums], *[F.col(f"_last_{c}").alias(_name("last", c)) for c in lasts])
    edges = (rows.groupBy("_part").agg(F.min_by(F.struct(F.col(series).alias("series")), "_pos").alias("first"), F.max_by(last, "_pos").alias("last"))
             .orderBy("_part").collect())                                  # one row a range
    names = [*(_name("prev", c) for c in lags), *(_name("sum", c) for c in sums), *(_name("last", c) for c in lasts)]
    out, state, before = [], None, None
    for e in edges:
        goes_on = before is not None and before == e["first"]
        if goes_on:
            out.append((e["_part"], tuple(state[n] for n in names)))
        end = e["last"].asDict()
        if goes_on and end["_head"]:                                       # one series through the whole range
            for c in sums:
                end[_name("sum", c)] += state[_name("sum", c)]
            for c in lasts:
                if end[_name("last", c)] is None:
                    end[_name("last", c)] = state[_name("last", c)]
        state, before = end, (e["last"]["series"],)
    if not out:
        return None
    fields = ", ".join(f"`{n}`: {t if isinstance(t, str) else t.simpleString()}" for n, t in zip(names, types))
    return rows.sparkSession.createDataFrame(out, f"_to bigint, _c struct<{fields}>")
