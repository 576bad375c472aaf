"""Typed columns from JSON text without losing a valid record.

A line is parsed once to a variant. Every field of the wanted schema is then
taken by path and coerced by itself, so a field of another JSON type costs at
most that field, never the record.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobsift.functions._let import let

_DIRECT = (T.StringType, T.DoubleType, T.FloatType, T.LongType, T.IntegerType, T.ShortType, T.BooleanType)


def _step(name: str) -> str:
    escaped = name.replace("\\", "\\\\").replace("'", "\\'")
    return f"['{escaped}']"


def _get(variant: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(variant, path, kind)


def is_object(variant: Column, path: str = "$") -> Column:
    return _get(variant, path, "struct<>").isNotNull()


def field(variant: Column, dtype: T.DataType, path: str = "$") -> Column:
    """The value at ``path`` as ``dtype``: text of any value, numbers from text, one value as a list of one; null if it cannot be."""
    if isinstance(dtype, T.StructType):
        inner = F.struct(*[field(variant, f.dataType, path + _step(f.name)).alias(f.name) for f in dtype.fields])
        return F.when(is_object(variant, path), inner)
    if isinstance(dtype, T.ArrayType):
        many = _get(variant, path, "array<variant>")
        one = F.when(_get(variant, path, "string").isNotNull(), F.array(field(variant, dtype.elementType, path)))
        return F.coalesce(F.transform(many, lambda v: field(v, dtype.elementType)), one)
    if isinstance(dtype, T.MapType):
        return _get(variant, path, dtype.simpleString())
    if isinstance(dtype, _DIRECT):
        return _get(variant, path, dtype.simpleString())
    return _get(variant, path, "string").try_cast(dtype)


def whole_value(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with the JSON value of a text as variant ``name``; null if it is none, or if anything but space stands behind it.

    The parser stops behind a value. So the text is put into an object between two keys: whatever follows the value
    breaks the object, ends it early or adds a key.

    The value comes out of a generator of one row: a filter on it stays above, where Spark would otherwise move it
    to the scan with a copy of the parser for each time it looks at the value.
    """
    whole = F.try_parse_json(F.concat(F.lit('{"v":'), F.regexp_replace(text, "^\ufeff", ""), F.lit(',"end":1}')))
    value = let(_get(whole, "$", "map<string,variant>"),
                lambda m: F.when(F.map_keys(m) == F.array(F.lit("end"), F.lit("v")), F.element_at(m, F.lit("v"))))
    return df.withColumn(name, F.explode(F.array(value)))


def records(lines: DataFrame, schema: T.StructType, value: str = "value", corrupt: str = "_corrupt") -> DataFrame:
    """``lines`` with the schema's columns in place of ``value`` and ``corrupt``: the text that is not a JSON object, else null."""
    parsed = whole_value(lines, value, "__v")
    bad = ~is_object(F.col("__v")) | F.col("__v").isNull()
    wanted = [f for f in schema.fields if f.name != corrupt]
    rest = [c for c in lines.columns if c != value]
    return parsed.select(*[field(F.col("__v"), f.dataType, "$" + _step(f.name)).alias(f.name) for f in wanted],
                         F.when(bad, F.col(value)).alias(corrupt), *rest)
