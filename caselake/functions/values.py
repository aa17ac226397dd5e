"""Numbers, flags and shares from text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip, text


def flag(c: Column | str) -> Column:
    """True for exactly ``t``; never null."""
    return text(c) == "t"


def whole_number(c: Column | str) -> Column:
    """A number, or null where there is none."""
    return strip(text(c)).try_cast("bigint")


def grouped_number(c: Column | str) -> Column:
    """A number with thousands separators."""
    return F.replace(strip(text(c)), F.lit(","), F.lit("")).try_cast("bigint")


def percent(part: Column, whole: Column) -> Column:
    """Hundredths to one place; 0 of nothing is 0."""
    return F.when(whole > 0, F.round(F.lit(100.0) * part / whole, 1)).otherwise(0.0)


def byte_size(c: Column | str) -> Column:
    """Bytes of a size such as 132.67 KB; else null."""
    number = F.regexp_extract(text(c), r"(?i)^\s*([0-9.]+)\s*([KMG]?)B", 1).try_cast("double")
    unit = F.upper(F.regexp_extract(text(c), r"(?i)^\s*([0-9.]+)\s*([KMG]?)B", 2))
    return F.round(number * F.when(unit == "K", 1024).when(unit == "M", 1024**2).when(unit == "G", 1024**3).otherwise(1)).cast("bigint")


def page_counts(c: Column | str) -> Column:
    """first, last and total of ``1 - 4 of 1,204 Records Found``, as a struct; fields null if it is not there."""
    part = lambda k: grouped_number(F.regexp_extract(text(c), r"(?i)(\d+) - (\d+) of ([0-9,]+) Records Found", k))
    return F.struct(part(1).alias("first"), part(2).alias("last"), part(3).alias("total"))


def result_count(c: Column | str) -> Column:
    """The number in ``of 1,234 results``; 0 if it is not there."""
    return F.coalesce(grouped_number(F.regexp_extract(text(c), r"(?i)of\s+([0-9,]+)\s+results", 1)), F.lit(0).cast("bigint"))
