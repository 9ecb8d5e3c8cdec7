"""Dates of ancient records: years without a year zero, open bounds, intervals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO = r"^(-?[0-9]{4,})(?:-([0-9]{2}))?(?:-([0-9]{2}))?$"


def month_length(year: Column, month: Column) -> Column:
    """Days of a Gregorian month; years before the common era count one up for leap years."""
    y = F.when(year < 0, year + 1).otherwise(year)
    leap = ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)
    return F.when(month == 2, F.when(leap, 29).otherwise(28)).when(month.isin(4, 6, 9, 11), 30).otherwise(31)


def parse_date(value: Column, gregorian: bool = False) -> Column:
    """struct(year, month, day, granularity, status) of a date in the forms Y, Y-M and Y-M-D.

    Status is, in this order: invalid_lexical, year_zero, invalid_month, invalid_day,
    invalid_gregorian_day (only if asked for), valid. Null for null.
    """
    part = lambda i: F.regexp_extract(value, ISO, i).try_cast("int")
    year, month, day = part(1), part(2), part(3)
    status = F.when(~value.rlike(ISO), "invalid_lexical").when(year == 0, "year_zero").when(~month.between(1, 12), "invalid_month").when(~day.between(1, 31), "invalid_day")
    if gregorian:
        status = status.when(day > month_length(year, month), "invalid_gregorian_day")
    granularity = F.when(day.isNotNull(), "day").when(month.isNotNull(), "month").when(year.isNotNull(), "year")
    return F.when(value.isNotNull(), F.struct(year.alias("year"), month.alias("month"), day.alias("day"), granularity.alias("granularity"), status.otherwise("valid").alias("status")))


def strict_parts(value: Column) -> Column:
    """struct(year, month, day); a value of another form fails the query."""
    checked = F.when(value.rlike(ISO), value).when(value.isNotNull(), F.raise_error(F.concat(F.lit("not a date: "), value)).cast("string"))
    part = lambda i: F.regexp_extract(checked, ISO, i).try_cast("int")
    return F.struct(part(1).alias("year"), part(2).alias("month"), part(3).alias("day"))


def date_shape(when: Column, custom: Column, not_before: Column, not_after: Column) -> Column:
    """Which attributes a date has."""
    w, c, b, a = when.isNotNull(), custom.isNotNull(), not_before.isNotNull(), not_after.isNotNull()
    # The names of the shapes.
    return (
        F.when(w & ~c & ~b & ~a, "exact/when").when(~w & ~c & b & a, "closed range").when(~w & ~c & b & ~a, "open upper bound (notBefore only)").when(~w & ~c & ~b & a, "open lower bound (notAfter only)")
        .when(~w & c & ~b & ~a, "custom exact date").when(~w & ~c & ~b & ~a, "text only").otherwise("mixed")
    )


def year_width(start: Column, end: Column) -> Column:
    """Years from start to end, both counted, without a year zero."""
    return end - start + 1 - F.when((start < 0) & (end > 0), 1).otherwise(0)


def width_bucket(start: Column, end: Column) -> Column:
    w = year_width(start, end)
    return (
        F.when(start.isNull() & end.isNull(), "text_only").when(start.isNull() | end.isNull(), "open").when(w <= 1, "1").when(w <= 10, "2-10").when(w <= 50, "11-50")
        .when(w <= 100, "51-100").when(w <= 200, "101-200").otherwise(">200")
    )


def overlaps(start: Column, end: Column, query_start: int, query_end: int) -> Column:
    """Whether an interval meets the query; an open bound reaches without end, no bound at all never meets."""
    some = start.isNotNull() | end.isNotNull()
    return some & F.coalesce(start <= query_end, F.lit(True)) & F.coalesce(end >= query_start, F.lit(True))


def contained(start: Column, end: Column, query_start: int, query_end: int) -> Column:
    """Whether a closed interval lies in the query."""
    return F.coalesce((start >= query_start) & (end <= query_end), F.lit(False))


def year_ordinal(year: Column) -> Column:
    """Years in a row: -1 is followed by 0 for the year 1."""
    return F.when(year < 0, year).otherwise(year - 1)
