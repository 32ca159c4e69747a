"""Dates as Column functions: parsing, repair, fiscal years, calendars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def parse_dmy(c: Column) -> Column:
    """First date like 12-Jul-2026 in a text; null if there is none or it is impossible."""
    return F.try_to_date(F.regexp_extract(c, r"\d{1,2}-[A-Za-z]{3}-\d{4}", 0), "d-MMM-yyyy")


def publication_year(c: Column) -> Column:
    """Year of ``parse_dmy`` as text, 'unknown' without one."""
    return F.coalesce(F.year(parse_dmy(c)).cast("string"), F.lit("unknown"))


def split_period(c: Column) -> Column:
    """STRUCT<start, end, note> of '12-Jul-2026 to 11-Jul-2027 (note)'."""
    one = r"\d{1,2}-[A-Za-z]{3}-\d{4}"
    part = lambda p, g: F.nullif(F.regexp_extract(c, p, g), F.lit(""))
    return F.struct(
        parse_dmy(c).alias("start"),
        F.try_to_date(part(rf"to\s+({one})", 1), "d-MMM-yyyy").alias("end"),
        F.trim(part(r"\(([^)]*)\)", 1)).alias("note"),
    )


def month_label(c: Column, first_year: int = 2000) -> Column:
    """'Jul-26' -> '2026-07'; two-digit years lie in the hundred years from ``first_year`` on."""
    d = F.try_to_date(c, "MMM-yy")
    year = F.lit(first_year) + F.pmod(F.year(d) - first_year, F.lit(100))
    return F.concat(F.format_string("%04d-", year), F.date_format(d, "MM"))


def make_date_or_null(year: Column, month: Column, day: Column) -> Column:
    return F.try_to_date(F.format_string("%04d-%02d-%02d", year, month, day), "yyyy-MM-dd")


def repair_year(report: Column, listing: Column, most: int = 5) -> Column:
    """Report date if it is 0 to ``most`` days before its listing, else with the listing's year if that is, else null."""
    fits = lambda d: F.datediff(listing, d).between(0, most)
    moved = make_date_or_null(F.year(listing), F.month(report), F.dayofmonth(report))
    return F.when(fits(report), report).when(fits(moved), moved)


def actual_date(day: Column, month: Column, report: Column) -> Column:
    """Date of the day and month told: the report's year, or the year before when the month is later; else the day before the report."""
    year = F.year(report) - F.when(month > F.month(report), 1).otherwise(0)
    return F.coalesce(make_date_or_null(year, month, day), F.date_sub(report, 1))


def fiscal_year(year: Column, month: Column, first: int = 7) -> Column:
    """'FY2025-26' for July 2025 to June 2026."""
    start = F.when(month >= first, year).otherwise(year - 1)
    return F.format_string("FY%d-%02d", start, F.pmod(start + 1, F.lit(100)))


def fiscal_month_year(start: Column, month: Column, first: int = 7) -> Column:
    """Calendar year of a month in the fiscal year that begins in ``start``."""
    return F.when(month >= first, start).otherwise(start + 1)


def day_of_365(d: Column) -> Column:
    """Day of the year with 29 February counted as the 28th and later days moved up."""
    leap = F.dayofmonth(F.last_day(F.make_date(F.year(d), F.lit(2), F.lit(1)))) == 29
    return F.dayofyear(d) - F.when(leap & (F.dayofyear(d) > 59), 1).otherwise(0)


def days(spark: SparkSession, first: str, last: str) -> DataFrame:
    """(date): every day from ``first`` to ``last``."""
    return spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("date"))


def months(spark: SparkSession, first: str, last: str) -> DataFrame:
    """(month_start, start, end): calendar months, the outer ones clipped to the bounds."""
    a, b = F.lit(first).cast("date"), F.lit(last).cast("date")
    m = spark.range(1).select(F.explode(F.sequence(F.trunc(a, "month"), b, F.expr("interval 1 month"))).alias("month_start"))
    return m.select("month_start", F.greatest("month_start", a).alias("start"), F.least(F.last_day("month_start"), b).alias("end"))


def weeks(spark: SparkSession, first: str, last: str) -> DataFrame:
    """(month_start, start, end): spans of 7 days inside each clipped month, the last one shorter."""
    m = months(spark, first, last)
    w = m.withColumn("start", F.explode(F.sequence("start", "end", F.expr("interval 7 days"))))
    return w.select("month_start", "start", F.least(F.date_add("start", 6), F.col("end")).alias("end"))
