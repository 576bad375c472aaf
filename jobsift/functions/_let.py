"""Bind an intermediate Column value once.

Spark's subexpression elimination does not reach values used inside several
CASE branches, so a costly intermediate (a regex extraction, a title-cased
string) referenced in many branches would be evaluated many times. Passing it
through a one-element ``transform`` evaluates it once and names it.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)
