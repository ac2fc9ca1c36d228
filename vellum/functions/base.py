"""Column helpers that the other functions share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space, as \\s has it.
BLANK = " \t\n\x0b\f\r"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once: the optimizer would otherwise repeat it at each use."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """Words between white space."""
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def n_words(text: Column) -> Column:
    """How many `words` there are: white space at the ends gone, none of the parts is empty."""
    return let(strip(text), lambda t: F.when(t == "", 0).otherwise(F.size(F.split(t, r"\s+"))))


def occurrences(text: Column, part: str) -> Column:
    """Non-overlapping occurrences of a literal; a text without one is searched once and no more."""
    n = ((F.length(text) - F.length(F.replace(text, F.lit(part)))) / F.lit(len(part))).cast("int")
    return F.when(~F.contains(text, F.lit(part)), 0).otherwise(n)


def strip(text: Column) -> Column:
    return F.trim(text, F.lit(BLANK))


def first(values: Column) -> Column:
    """First element of an array, null if there is none."""
    return F.get(values, F.lit(0))


def lines(text: Column) -> Column:
    return F.split(text, "\n", -1)
