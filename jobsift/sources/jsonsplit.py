"""Large JSON documents, arrays of objects, read in parallel inside a file.

A document need not hold a line end, so it is cut at closing braces: Spark reads
"lines" that end with ``}``, from byte ranges. Whether a brace is text or
structure, and how deep, depends on all that comes before; a range is therefore taken
as a function of the state it begins in: whether it ends inside a string, and how
much deeper, for either beginning. One pass finds these functions, which are composed along each file. With the
state in which every range begins, a second pass cuts it behind each entry of the array. Only entries that cross
the end of a range are brought together across tasks.
"""
from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsift.session import materialize
from jobsift.sources.csvsplit import _runs

#: What is kept of a document that is no JSON, as its reject.
REJECT_CHARS = 1000
_KEY = "_file string, _start long, _length long"


def _fragments(spark: SparkSession, path: str | Sequence[str], glob: str | None, skip_unreadable: bool, least_bytes: int) -> DataFrame:
    """(value, _file, _start, _length, _size, _odd, _deeper_out, _deeper_in) of files over ``least_bytes``: texts between closing braces,
    whether they hold an odd number of quotes, and how many brackets they open, less those they close, begun outside or inside a string."""
    r = (spark.read.option("recursiveFileLookup", "true").option("lineSep", "}").option("ignoreCorruptFiles", str(skip_unreadable).lower()))
    if glob:
        r = r.option("pathGlobFilter", glob)
    text = (r.text(path if isinstance(path, str) else list(path)).where(F.col("_metadata.file_size") > least_bytes)
            .select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"),
                    F.col("_metadata.file_block_length").alias("_length"), F.col("_metadata.file_size").alias("_size"),
                    F.regexp_replace("value", r"(?s)\\.", "").alias("plain")))

    def deeper(plain: Column) -> Column:
        outside = F.regexp_replace(plain, r'"[^"]*+(?:"|\z)', "")
        return F.length(F.regexp_replace(outside, r"[^{\[]", "")) - F.length(F.regexp_replace(outside, r"[^\]]", ""))

    return text.select("value", "_file", "_start", "_length", "_size",
                       ((F.length("plain") - F.length(F.replace("plain", F.lit('"'), F.lit("")))) % 2 == 1).alias("_odd"),
                       deeper(F.col("plain")).alias("_deeper_out"), deeper(F.regexp_replace("plain", r'\A[^"]*+(?:"|\z)', "")).alias("_deeper_in"))


def walk(odd: np.ndarray, deeper_out: np.ndarray, deeper_in: np.ndarray, inside: bool, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(inside a string at the end of each fragment, depth behind the brace that follows it), begun as told."""
    ends = np.logical_xor.accumulate(np.concatenate([[inside], odd]))
    steps = np.where(ends[:-1], deeper_in, deeper_out) - ~ends[1:]
    return ends[1:], depth + np.cumsum(steps)


def _numbers(b: pa.RecordBatch, at: int):
    return [b.column(at).to_numpy(zero_copy_only=False).astype(bool), *(b.column(at + i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (1, 2))]


def _summarise(batches):
    """A row a range: end state and added depth for both beginnings, its bytes with a brace behind each fragment, and a file's beginning."""
    names = ["_file", "_start", "_length", "size", "odd", "out", "inside", "bytes", "head"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    key, size, state, octets, head = None, 0, (False, 0, 0), 0, None

    def row():
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((*key, size, *state, octets, head), types)], names=names)

    for b in batches:
        odd, out, inside = _numbers(b, 4)
        sizes = b.column(7).to_numpy(zero_copy_only=False)
        for lo, hi in _runs(b, 3):
            here = tuple(b.column(i)[lo].as_py() for i in range(3))
            if here != key:
                if key is not None:
                    yield row()
                key, size, state, octets, head = here, b.column(3)[lo].as_py(), (False, 0, 0), 0, b.column(8)[lo].as_py()
            ends = [walk(odd[lo:hi], out[lo:hi], inside[lo:hi], state[0] ^ begun, state[1 + begun]) for begun in (False, True)]
            state = (bool(ends[0][0][-1]), int(ends[0][1][-1]), int(ends[1][1][-1]))
            octets += int(sizes[lo:hi].sum()) + hi - lo
    if key is not None:
        yield row()


def _ranges(fragments: DataFrame) -> DataFrame:
    """(_file, head, closed, _start, _length, begins_inside, depth, last) of every range, stored; closed: a brace ends the file."""
    begin = F.when(F.col("_start") == 0, F.substring("value", 1, REJECT_CHARS))
    each = fragments.select("_file", "_start", "_length", "_size", "_odd", "_deeper_out", "_deeper_in", F.octet_length("value"), begin).mapInArrow(
        _summarise, f"{_KEY}, size long, odd boolean, out long, inside long, bytes long, head string")
    per_file = each.groupBy("_file").agg(F.sort_array(F.collect_list(F.struct("_start", "_length", "odd", "out", "inside"))).alias("r"),
                                         F.max("head").alias("head"), (F.sum("bytes") == F.max("size")).alias("closed"), F.max("_start").alias("end"))
    done = "array<struct<_start:bigint,_length:bigint,begins_inside:boolean,depth:bigint>>"
    zero = F.struct(F.lit(False).alias("state"), F.lit(0).cast("long").alias("depth"), F.array().cast(done).alias("done"))

    def step(acc: Column, r: Column) -> Column:
        told = F.struct(r["_start"].alias("_start"), r["_length"].alias("_length"), acc["state"].alias("begins_inside"), acc["depth"].alias("depth"))
        return F.struct((acc["state"] != r["odd"]).alias("state"), (acc["depth"] + F.when(acc["state"], r["inside"]).otherwise(r["out"])).alias("depth"),
                        F.concat(acc["done"], F.array(told)).alias("done"))

    rows = per_file.select("_file", F.regexp_replace("head", "^\ufeff", "").alias("head"), "closed", "end", F.aggregate("r", zero, step)["done"].alias("r"))
    return materialize(rows.select("_file", "head", "closed", "end", F.inline("r")).withColumn("last", F.col("_start") == F.col("end")).drop("end"), "json-ranges")


def _cut(batches):
    """(file, _start, part, opens, ends, text): entries of a range (opens and ends true) and parts of entries that cross its ends.

    An entry's text is all that stands behind the entry before it, up to and with the brace that brings the depth back to
    that of the array; what follows the last entry of a file ends with ``ends`` null.
    """
    names, types = ["file", "_start", "part", "opens", "ends", "text"], [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string()]
    key, inside, depth, base, held, opens, part, final, closed = None, False, 0, 0, [], True, 0, False, True
    out: list[tuple] = []
    late: list[tuple] = []                  # the last fragment so far of a file that no brace ends

    def take(value: str, cut: bool):
        nonlocal opens, part
        held.append(value)
        if cut:
            out.append((key[0], key[1], part, opens, True, "}".join(held) + "}"))
            held.clear()
            opens, part = True, part + 1

    def leave():
        held.extend(v for v, _ in late)
        late.clear()
        if not held and not (final and opens):
            return
        text = "}".join(held) + ("}" if held and (closed or not final) else "")
        out.append((key[0], key[1], part, opens, None if final else False, text))

    def flush():
        rows, out[:] = list(out), []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names=names)

    for b in batches:
        odd, deeper_out, deeper_in = _numbers(b, 8)
        values = b.column(11).to_pylist()
        for lo, hi in _runs(b, 3):
            here = tuple(b.column(i)[lo].as_py() for i in range(3))
            if here != key:
                if key is not None:
                    leave()
                key, part = here, 0
                held.clear()
                inside, depth, base, final, closed = (b.column(i)[lo].as_py() for i in range(3, 8))
                opens = here[1] == 0 or (not inside and depth == base)
            ends, depths = walk(odd[lo:hi], deeper_out[lo:hi], deeper_in[lo:hi], inside, depth)
            inside, depth = bool(ends[-1]), int(depths[-1])
            cuts = (~ends & (depths == base)).tolist()
            for value, cut in zip(values[lo:hi], cuts):
                if final and not closed:
                    if late:
                        take(*late.pop())
                    late.append((value, cut))
                else:
                    take(value, cut)
        yield from flush()
    if key is not None:
        leave()
        yield from flush()


_SPACE = " \t\r\n"


def content(array: bool, first: bool, last: bool, text: str) -> tuple[bool, str | None]:
    """(fits, body): whether a piece of a document stands as it must, and the entries in it, None for none.

    In an array the first piece begins with a bracket, others with a comma, and the last one ends with a bracket.
    """
    if first:
        text = text.removeprefix("\ufeff")
    text = text.strip(_SPACE)
    if not array:
        return bool(text) or not first, text or None
    if first:
        if not text.startswith("["):
            return False, None
        text = text[1:].strip(_SPACE)
    if last:
        if not text.endswith("]"):
            return False, None
        text = text[:-1].strip(_SPACE)
        if not text:
            return True, None
    if first:
        return bool(text), text
    return text.startswith(",") and bool(text[1:].strip(_SPACE)), text[1:]


def _contents(batches):
    for b in batches:
        base, first, last, text = (b.column(i).to_pylist() for i in range(2, 6))
        told = [content(*x) for x in zip([x == 1 for x in base], first, last, text)]
        yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array([t[0] for t in told], pa.bool_()), pa.array([t[1] for t in told], pa.string())],
                                         names=[*b.schema.names[:5], "fits", "body"])


def entries(spark: SparkSession, path: str | Sequence[str], glob: str | None, skip_unreadable: bool, least_bytes: int) -> DataFrame:
    """(_file, __bad, __v): the entries of every document over ``least_bytes`` as variants, as a read of the whole file gives them.

    A document that is no JSON gives one row, whose ``__bad`` is its beginning. Whether it is one is known only after all of it has been
    read, so its entries are checked once before any is given out.
    """
    fragments = _fragments(spark, path, glob, skip_unreadable, least_bytes)
    ranges = _ranges(fragments)
    base = F.when(F.ltrim("head", F.lit(" \t\r\n")).startswith("["), 1).otherwise(0).cast("long")
    known = ranges.select(F.xxhash64("_file").alias("file"), F.col("_start").alias("s"), F.col("_length").alias("l"), "begins_inside", "depth", base.alias("base"), "last", "closed")
    at = (F.xxhash64("_file") == F.col("file")) & (F.col("_start") == F.col("s")) & (F.col("_length") == F.col("l"))
    sure = F.coalesce("file", F.raise_error(F.lit("the files were cut differently in two reads: read again")).cast("long"))
    told = fragments.join(F.broadcast(known), at, "left")                # one small row a range
    cut = told.select(sure.alias("file"), "_start", "_length", "begins_inside", "depth", "base", "last", "closed", "_odd", "_deeper_out", "_deeper_in", "value").mapInArrow(
        _cut, "file long, _start long, part long, opens boolean, ends boolean, text string")
    whole = cut.where("opens AND ends").select("file", F.lit(False).alias("last"), ((F.col("_start") == 0) & (F.col("part") == 0)).alias("first"), "text")
    # At most three parts a range: the end of an entry, the beginning of one, and a file's end.
    crossing = cut.where("NOT (opens AND coalesce(ends, false))").withColumn(
        "begun", F.expr("max(IF(opens, struct(_start, part), NULL)) OVER (PARTITION BY file ORDER BY _start, part ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"))
    parts = F.transform(F.sort_array(F.collect_list(F.struct("_start", "part", "text"))), lambda p: p["text"])
    joined = crossing.groupBy("file", "begun").agg(F.array_join(parts, "").alias("text"), F.bool_or(F.col("ends").isNull()).alias("last")).select(
        "file", "last", (F.col("begun") == F.struct(F.lit(0).cast("long"), F.lit(0).cast("long"))).alias("first"), "text")
    kinds = ranges.where("_start = 0").select(F.xxhash64("_file").alias("file"), "_file", "head", base.alias("base"))
    pieces = whole.unionByName(joined).join(F.broadcast(kinds), "file")                                    # one row a file over the size
    bodies = pieces.select("_file", "head", "base", "first", "last", "text").mapInArrow(
        _contents, "_file string, head string, base long, first boolean, last boolean, fits boolean, body string")
    many = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), "body", F.lit("]"))), "$", "array<variant>")
    read = bodies.select("_file", "head", "base", "first", "last", F.when(F.col("fits"), F.when(F.col("body").isNull(), F.array().cast("array<variant>")).otherwise(many)).alias("found"))
    single = (F.col("base") == 0) & (F.size("found") != F.when(F.col("first"), 1).otherwise(0))      # one object, and nothing behind it
    wrong = F.col("found").isNull() | single
    broken = materialize(read.where(wrong).groupBy("_file").agg(F.first("head").alias("head")), "json-rejects")
    good = read.join(broken.select("_file"), "_file", "left_anti").select("_file", F.lit(None).cast("string").alias("__bad"), F.explode("found").alias("__v"))
    return good.unionByName(broken.select("_file", F.col("head").alias("__bad"), F.lit(None).cast("variant").alias("__v")))
