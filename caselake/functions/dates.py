"""Dates in the many shapes that listings use."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip, text

# Formats of a written date, in the order in which they are tried.
LONG_FORMATS = ("MMM d, yyyy", "MMMM d, yyyy", "M/d/yyyy")


def long_date(c: Column | str) -> Column:
    """A date from any of the long forms, full stops ignored and Sept read as Sep; else null."""
    plain = F.regexp_replace(F.replace(strip(text(c)), F.lit("."), F.lit("")), r"\bSept\b", "Sep")
    return F.coalesce(*[F.try_to_timestamp(plain, F.lit(f)).cast("date") for f in LONG_FORMATS])


def year_and_month(c: Column | str, otherwise: Column) -> tuple[Column, Column]:
    """Year (yyyy) and month (MM) of a long date, of ``otherwise`` where it can't be read."""
    day = F.coalesce(long_date(c), otherwise.cast("date"))
    return F.date_format(day, "yyyy"), F.date_format(day, "MM")


def leading_year(c: Column | str) -> Column:
    """The first four characters as a number; else null."""
    return F.substring(text(c), 1, 4).try_cast("int")


def docket_year(number: Column | str, *dates: Column | str) -> Column:
    """The year of the first date of four characters or more; else the year a docket number begins with.

    Two digits before the hyphen mean 20xx below 30 and 19xx from there on.
    """
    from_dates = [F.when(F.length(text(d)) >= 4, F.substring(text(d), 1, 4)) for d in dates]
    four, two = F.regexp_extract(text(number), r"^(\d{4})-", 1), F.regexp_extract(text(number), r"^(\d{2})-", 1)
    pivot = F.when(two != "", F.concat(F.when(two.try_cast("int") < 30, "20").otherwise("19"), two))
    return F.coalesce(*from_dates, F.nullif(four, F.lit("")), pivot)


def term_year(page_text: Column | str, url: Column | str) -> Column:
    """The year a page names as its term; else 2000 and the two digits the url ends in."""
    named = F.nullif(F.regexp_extract(text(page_text), r"(?i)Term Year:\s*(\d{4})", 1), F.lit("")).try_cast("int")
    return F.coalesce(named, F.lit(2000) + F.nullif(F.regexp_extract(text(url), r"/(\d{2})/?$", 1), F.lit("")).try_cast("int"))


def is_short_date(c: Column | str) -> Column:
    """True for digits in the shape M/D/YY; whether there is such a day is not asked."""
    return text(c).rlike(r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{2}$")


def short_date(c: Column | str) -> Column:
    """M/D/YY as a date of this century; null if there is no such day."""
    part = lambda k: F.regexp_extract(text(c), r"^([0-9]{1,2})/([0-9]{1,2})/([0-9]{2})$", k)
    iso = F.concat_ws("-", F.concat(F.lit("20"), part(3)), F.lpad(part(1), 2, "0"), F.lpad(part(2), 2, "0"))
    return F.when(is_short_date(c), iso.try_cast("date"))
