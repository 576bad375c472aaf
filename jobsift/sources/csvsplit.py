"""Quoted CSV read in parallel inside a file.

Spark cuts text at byte ranges and line ends, but a line end may stand inside
quotes, and whether it does depends on all that comes before. A line is therefore
taken as a function on two states, outside and inside quotes, and so is a range of
lines. One pass finds each range's function and each file's header; the
functions of a file's ranges are composed in order, which gives the state in which every
range begins. With that, a second pass puts each range's lines together to
records. Only records that cross the end of a range are brought together across tasks.
"""
from __future__ import annotations

import csv
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobsift.session import materialize

_NO_TEXT = "\ufdd0"   # a non-character: with it as the null mark, only an unquoted empty cell reads as null
_CELL_OPTIONS = {"nullValue": _NO_TEXT, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true", "maxCharsPerColumn": "-1",
                 "maxColumns": "200000", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}

# A cell is quoted, its quotes doubled, or plain; a quote inside a plain cell or behind a closing quote is text.
_QUOTED = r'"(?:[^"]++|"")*+'
_CELLS = rf'(?:(?:{_QUOTED}"[^,]*+|[^",][^,]*+|),)*+'
_OPENS = rf"^{_CELLS}{_QUOTED}\z"
_STAYS_OPEN = rf'^(?:[^"]++|"")*+(?:\z|"[^,]*+,{_CELLS}{_QUOTED}\z)'


def _lines(spark: SparkSession, path: str | Sequence[str], glob: str | None, skip_unreadable: bool) -> DataFrame:
    """(value, _file, _start, _length, _out, _in): lines with their range, and whether they end inside quotes if they begin
    outside (_out) or inside (_in)."""
    r = (spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n").option("ignoreCorruptFiles", str(skip_unreadable).lower()))
    if glob:
        r = r.option("pathGlobFilter", glob)
    quotes = F.contains("value", F.lit('"'))
    return (r.text(path if isinstance(path, str) else list(path))
            .select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"),
                    F.col("_metadata.file_block_length").alias("_length"),
                    (quotes & F.col("value").rlike(_OPENS)).alias("_out"), (~quotes | F.col("value").rlike(_STAYS_OPEN)).alias("_in")))


def states(out: np.ndarray, inside: np.ndarray, first: bool) -> np.ndarray:
    """Whether each line begins inside quotes (one entry more: the end), if the first does as ``first`` tells.

    A line either leads to one state whatever it began in, or keeps the state, or swaps it. So a state is that of
    the last line of the first kind, swapped as often as lines of the third kind follow.
    """
    n = len(out)
    at = np.maximum.accumulate(np.concatenate([[0], np.where(out == inside, np.arange(1, n + 1), 0)]))
    swaps = np.concatenate([[0], np.cumsum(out & ~inside)])
    base = np.where(at > 0, out[at - 1] if n else False, first)
    return base ^ ((swaps - swaps[at]) % 2 == 1)


def _runs(b: pa.RecordBatch, keys: int):
    """(first row, end row) of stretches of a batch that belong to one range; the first ``keys`` columns name it."""
    if not b.num_rows:
        return
    new = np.zeros(b.num_rows, bool)
    for i in range(keys):
        c = b.column(i).to_numpy(zero_copy_only=False)
        new[1:] |= c[1:] != c[:-1]
    cuts = [0, *np.flatnonzero(new).tolist(), b.num_rows]
    yield from zip(cuts, cuts[1:])


def _summarise(batches):
    """A row a range: its function and, of a file's first range, the first line that is not blank."""
    names = ["_file", "_start", "_length", "out", "inside", "head"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string()]
    key, ends, head = None, (False, True), None

    def row():
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((*key, *ends, head), types)], names=names)

    for b in batches:
        flags = [b.column(i).to_numpy(zero_copy_only=False).astype(bool) for i in (3, 4)]
        for lo, hi in _runs(b, 3):
            here = tuple(b.column(i)[lo].as_py() for i in range(3))
            if here != key:
                if key is not None:
                    yield row()
                key, ends, head = here, (False, True), None
            out, inside = (f[lo:hi] for f in flags)
            ends = tuple(bool(states(out, inside, e)[-1]) for e in ends)
            if head is None and here[1] == 0:
                head = next((v for v in b.column(5)[lo:hi].to_pylist() if v and v.strip()), None)
    if key is not None:
        yield row()


def _ranges(lines: DataFrame) -> DataFrame:
    """(_file, _start, _length, begins_inside, head) of every range: the functions of a file's ranges composed in order.

    One row a range, stored; a file's ranges (its size over the split size) meet in one row.
    """
    whole = lines.select("_file", "_start", "_length", "_out", "_in", F.when(F.col("_start") == 0, F.col("value")))
    each = whole.mapInArrow(_summarise, "_file string, _start long, _length long, out boolean, inside boolean, head string")
    per_file = each.groupBy("_file").agg(F.sort_array(F.collect_list(F.struct("_start", "_length", "out", "inside"))).alias("r"), F.max("head").alias("head"))
    begin = F.struct(F.lit(False).alias("state"), F.array().cast("array<struct<_start:bigint,_length:bigint,begins_inside:boolean>>").alias("done"))

    def step(acc: Column, r: Column) -> Column:
        told = F.array(F.struct(r["_start"].alias("_start"), r["_length"].alias("_length"), acc["state"].alias("begins_inside")))
        return F.struct(F.when(acc["state"], r["inside"]).otherwise(r["out"]).alias("state"), F.concat(acc["done"], told).alias("done"))

    done = per_file.select("_file", F.regexp_replace(F.regexp_replace("head", "^\ufeff", ""), "\r$", "").alias("head"),
                           F.aggregate("r", begin, step)["done"].alias("r"))
    return materialize(done.select("_file", "head", F.inline("r")), "csv-ranges")


def _assemble(batches):
    """Records of each range: (kind, file, _start, opens null, text); and the pieces of records that cross its ends, with
    opens telling whether the record begins in this range."""
    names, types = ["kind", "file", "_start", "opens", "text"], [pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]
    key, kind, held, state, header = None, 0, [], False, False
    opens = True                                              # the held lines begin in this range

    def ended(text: str) -> str:
        return text[:-1] if text.endswith("\r") else text

    out: list[tuple] = []

    def flush():
        rows, out[:] = list(out), []
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names=names) if rows else None

    def leave():
        if held:
            out.append((kind, key[0], key[1], opens, "\n".join(held)))

    for b in batches:
        flags = [b.column(i).to_numpy(zero_copy_only=False).astype(bool) for i in (5, 6)]
        values = b.column(7).to_pylist()
        for lo, hi in _runs(b, 3):
            here = tuple(b.column(i)[lo].as_py() for i in range(3))
            if here != key:
                if key is not None:
                    leave()
                key, held, kind = here, [], b.column(4)[lo].as_py()
                state = bool(b.column(3)[lo].as_py())
                header, opens = here[1] == 0, not state
            begins = states(flags[0][lo:hi], flags[1][lo:hi], state)
            state = bool(begins[-1])
            for value, inside, after in zip(values[lo:hi], begins[:-1].tolist(), begins[1:].tolist()):
                if after:                                     # the record goes on behind this line
                    held.append(value)
                    continue
                if not inside:
                    if not value.strip():
                        continue
                    if header:
                        header = False
                        continue
                    out.append((kind, key[0], key[1], None, ended(value)))
                    continue
                text = "\n".join([*held, ended(value)])
                out.append((kind, key[0], key[1], None if opens else False, text))
                held, opens = [], True
        done = flush()
        if done is not None:
            yield done
    if key is not None:
        leave()
        done = flush()
        if done is not None:
            yield done


def records(spark: SparkSession, path: str | Sequence[str], glob: str | None = None, skip_unreadable: bool = False) -> tuple[DataFrame, list[list[str]]]:
    """((kind, text) of every record, the column names of each kind): files whose headers agree are of one kind.

    Only the different headers come to the driver. The states are joined by range, one small row a range of which the driver holds an entry anyway;
    a range that is not among them (another number of cores can cut a small input differently) is an error, not
    a wrong record.
    """
    lines = _lines(spark, path, glob, skip_unreadable)
    ranges = _ranges(lines)
    heads = [r["head"] for r in ranges.select("head").where("head IS NOT NULL").distinct().orderBy("head").collect()]
    if not heads:
        return spark.createDataFrame([], "kind int, text string"), []
    kinds = spark.createDataFrame(list(enumerate(heads)), "kind int, head string")
    known = (ranges.join(F.broadcast(kinds), "head", "left").select(F.xxhash64("_file").alias("file"), F.col("_start").alias("s"), F.col("_length").alias("l"),
                                                             "begins_inside", "kind"))
    at = (F.xxhash64("_file") == F.col("file")) & (F.col("_start") == F.col("s")) & (F.col("_length") == F.col("l"))
    told = lines.join(F.broadcast(known), at, "left")
    sure = F.coalesce("file", F.raise_error(F.lit("the files were cut differently in two reads: read again")).cast("long"))
    pieces = told.select(sure.alias("file"), "_start", "_length", "begins_inside", "kind", "_out", "_in", "value").mapInArrow(
        _assemble, "kind int, file long, _start long, opens boolean, text string")
    whole = pieces.where("opens IS NULL").select("kind", "text")
    # At most two pieces a range: the end of a record begun earlier, and the beginning of one that goes on.
    crossing = pieces.where("opens IS NOT NULL").withColumn(
        "begun", F.expr("max(IF(opens, _start, NULL)) OVER (PARTITION BY file ORDER BY _start, opens ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"))
    parts = F.transform(F.sort_array(F.collect_list(F.struct("_start", "text"))), lambda p: p["text"])
    joined = crossing.groupBy("file", "begun").agg(F.first("kind").alias("kind"), F.array_join(parts, "\n").alias("text")).select("kind", "text")
    return whole.unionByName(joined), [_names(h) for h in heads]


def _names(head: str) -> list[str]:
    names: list[str] = []
    for i, n in enumerate(next(csv.reader([head]))):
        names.append(n if n and n not in names else f"_c{i}")
    return names


def read(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | None, glob: str | None, skip_unreadable: bool) -> DataFrame:
    """Columns by the names of each file's own header, for all headers in one scan; see ``files.scan_csv``."""
    rows, kinds = records(spark, path, glob, skip_unreadable)
    if not kinds:
        return spark.createDataFrame([], schema or T.StructType([]))
    width = max(map(len, kinds))
    cells = F.from_csv("text", ", ".join(f"c{i} string" for i in range(width)), _CELL_OPTIONS)
    parsed = rows.select("kind", cells.alias("cells"))

    def cell(name: str) -> Column:
        places = {k: names.index(name) for k, names in enumerate(kinds) if name in names}
        if len(set(places.values())) == 1 and len(places) == len(kinds):
            return F.col(f"cells.c{places[0]}")
        out = F.lit(None).cast("string")
        for place in sorted(set(places.values())):
            here = [k for k, p in places.items() if p == place]
            out = F.when(F.col("kind").isin(here), F.col(f"cells.c{place}")).otherwise(out)
        return out

    if schema is None:
        return parsed.select(*[cell(n).alias(n) for n in dict.fromkeys(n for names in kinds for n in names)])
    return parsed.select(*[(cell(f.name) if isinstance(f.dataType, T.StringType) else cell(f.name).try_cast(f.dataType)).alias(f.name) for f in schema.fields])
