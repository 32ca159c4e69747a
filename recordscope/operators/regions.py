"""Crime rates and tenures, migration cubes and corridors, per-head measures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rate_per_100k(cases: Column, population: Column, months: Column) -> Column:
    """Cases a year for 100,000 people; null without people or months."""
    return F.when((population > 0) & (months > 0), cases / population * 100000 * 12 / months)


def category_totals(df: DataFrame, merge: Mapping[str, str], first: str, last: str) -> DataFrame:
    """(unit, category, n) over a window of months, with some categories counted as one."""
    table = F.create_map(*[F.lit(x) for kv in merge.items() for x in kv])
    rows = df.filter(F.col("month").between(first, last)).withColumn("category", F.coalesce(F.element_at(table, F.col("category")), F.col("category")))
    return rows.groupBy("unit", "category").agg(F.sum("n").alias("n"))


def tenure_shares(months: DataFrame, tenures: DataFrame, splits: DataFrame) -> DataFrame:
    """(tenure, no, month, share): months inside a tenure (tenure, no, first, last) belong to it, months of ``splits`` (month, tenure, share) as listed there."""
    whole = months.select("month").distinct().join(splits.select("month").distinct(), "month", "left_anti").join(F.broadcast(tenures), F.col("month").between(F.col("first"), F.col("last")))
    told = splits.join(tenures.select("tenure", "no"), "tenure")
    return whole.select("tenure", "no", "month", F.lit(1.0).alias("share")).unionByName(told.select("tenure", "no", "month", "share"))


def tenure_rate(monthly: DataFrame, tenures: DataFrame, by: Sequence[str] = (), exceptions: DataFrame | None = None) -> DataFrame:
    """Mean per month in each tenure, months split by their share, and its change from the tenure before.

    ``tenures`` is (tenure, no, month, share), ``monthly`` (month, by, n); with ``by`` there is a rate for each offence. ``exceptions`` is
    (by, month, tenure, share): cases that count elsewhere than their month does, while the number of months stays as it is. Change is
    null unless the earlier mean is over 0.5.
    """
    names = tenures.select("tenure", "no").distinct()
    cases = monthly.join(tenures, "month").select("tenure", "no", "month", *by, F.col("n") * F.col("share"))
    cases = cases.toDF("tenure", "no", "month", *by, "s")
    if exceptions is not None:
        moved = monthly.join(exceptions, [*by, "month"]).join(names, "tenure").select("tenure", "no", "month", *by, (F.col("n") * F.col("share")).alias("s"))
        cases = cases.join(exceptions.select(*by, "month").distinct(), [*by, "month"], "left_anti").select(moved.columns).unionByName(moved)
    length = tenures.groupBy("tenure", "no").agg(F.sum("share").alias("w"))
    per = length.crossJoin(monthly.select(*by).distinct()) if by else length
    per = per.join(cases.groupBy("tenure", "no", *by).agg(F.sum("s").alias("s")), ["tenure", "no", *by], "left")
    per = per.withColumn("mean", F.try_divide(F.coalesce("s", F.lit(0.0)), "w"))
    before = F.lag("mean").over(Window.partitionBy(*by).orderBy("no"))
    return per.select("tenure", "no", *by, F.round("w", 4).alias("months"), F.round("mean", 4).alias("mean"), F.when(before > 0.5, F.round((F.col("mean") / before - 1) * 100, 4)).alias("change_pct"))


def month_index(month: Column) -> Column:
    """Months since year 0 of a 'yyyy-MM' text."""
    return F.substring(month, 1, 4).cast("int") * 12 + F.substring(month, 6, 2).cast("int") - 1


def against_previous(df: DataFrame, by: Sequence[str], first: str, last: str) -> DataFrame:
    """Per group: the window's total and mean against the equally long window before it; the change compares means."""
    i = month_index(F.col("month"))
    a, b = month_index(F.lit(first)), month_index(F.lit(last))
    now, then = i.between(a, b), i.between(a - (b - a) - 1, a - 1)
    out = df.groupBy(*by).agg(F.sum(F.when(now, F.col("n"))).alias("now"), F.avg(F.when(now, F.col("n"))).alias("x"), F.sum(F.when(then, F.col("n"))).alias("before"), F.avg(F.when(then, F.col("n"))).alias("y"))
    return out.select(*by, "now", "before", F.round(F.try_divide(F.col("x") - F.col("y"), "y") * 100, 4).alias("change_pct"))


def year_matrix(df: DataFrame, value: str) -> DataFrame:
    """One row a year, one column a month (m1 to m12)."""
    rows = df.withColumn("year", F.year("date")).withColumn("m", F.concat(F.lit("m"), F.month("date").cast("string")))
    return rows.groupBy("year").pivot("m", [f"m{k}" for k in range(1, 13)]).agg(F.round(F.sum(value), 2))


def remaining_population(units: DataFrame) -> DataFrame:
    """Population of a division's range without the cities (kind 'metro') that police themselves."""
    cities = units.filter("kind = 'metro'").groupBy("division").agg(F.sum("population").alias("_cities"))
    left = F.when(F.col("kind") == "range", F.col("population") - F.coalesce("_cities", F.lit(0))).otherwise(F.col("population"))
    return units.join(cities, "division", "left").withColumn("remaining", left).drop("_cities")


def sum_up(df: DataFrame, parts: DataFrame, key: str, group: str, value: str) -> DataFrame:
    """Sum of a value over the parts of each group: zones from districts."""
    return parts.join(df, key).groupBy(group).agg(F.sum(value).alias(value))


def cube(daily: DataFrame, merge: DataFrame, skip: Sequence[str] = ()) -> DataFrame:
    """(month, district, country, gender, n) from daily facts: merged countries, unknown districts and flagged days left out."""
    rows = daily.filter("district is not null")
    rows = rows.filter(~F.col("date").isin(*[F.lit(s).cast("date") for s in skip])) if skip else rows
    rows = rows.join(merge.select(F.col("alias").alias("country"), F.col("canonical").alias("_c")), "country", "left").withColumn("country", F.coalesce("_c", "country"))
    return rows.groupBy(F.date_format("date", "yyyy-MM").alias("month"), "district", "country", "gender").agg(F.sum("n").alias("n"))


def corridor(cube: DataFrame, district: str | None, country: str | None, first: str, last: str) -> DataFrame:
    """(grain, name, n): districts under the country filter, countries under the district filter and months under both, in one pass.

    The entity's months run over all months, the other two grains over the window.
    """
    within = F.col("month").between(first, last)
    d = F.lit(True) if district is None else F.col("district") == district
    c = F.lit(True) if country is None else F.col("country") == country
    grains = F.array(
        F.when(within & c, F.struct(F.lit("district").alias("grain"), F.col("district").alias("name"))),
        F.when(within & d, F.struct(F.lit("country").alias("grain"), F.col("country").alias("name"))),
        F.when(d & c, F.struct(F.lit("month").alias("grain"), F.col("month").alias("name"))),
    )
    return cube.select("n", F.explode(F.array_compact(grains)).alias("g")).groupBy("g.grain", "g.name").agg(F.sum("n").alias("n"))


def per_capita(totals: DataFrame, population: DataFrame, key: str, value: str, scale: float, top: int | None = None, least: int = 0) -> DataFrame:
    """Totals per ``scale`` people where there are at least ``least``; the ``top`` of them."""
    out = totals.join(population, key).filter((F.col("population") > 0) & (F.col("population") >= least)).select(key, F.round(F.col(value) / F.col("population") * scale, 4).alias("rate"))
    return out.orderBy(F.col("rate").desc(), key).limit(top) if top else out


def annual_from_months(months: DataFrame, annual: DataFrame, key: Sequence[str]) -> DataFrame:
    """Stated years, and sums of twelve complete months for keys without one: (key, total, source)."""
    sums = months.groupBy(*key).agg(F.sum("value").alias("total"), F.count_distinct("month").alias("m")).filter("m = 12").drop("m")
    return annual.withColumn("source", F.lit("stated")).unionByName(sums.join(annual, list(key), "left_anti").withColumn("source", F.lit("months")))


def country_rollup(spans: DataFrame, countries: DataFrame) -> DataFrame:
    """(country, total, has_data) over month spans, for every country."""
    sums = spans.groupBy("country").agg(F.sum("total").alias("total"))
    return countries.join(sums, "country", "left").select("country", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce(F.col("total") > 0, F.lit(False)).alias("has_data"))


def working_age(df: DataFrame, bands: Sequence[str]) -> DataFrame:
    return df.withColumn("working_age", sum((F.coalesce(F.col(b), F.lit(0)) for b in bands), F.lit(0)))


def completeness_by_slice(slices: DataFrame, control: DataFrame, key: str, value: str) -> DataFrame:
    """(key, have, want, share): each slice against its own control total."""
    a = slices.groupBy(key).agg(F.sum(value).alias("have"))
    b = control.groupBy(key).agg(F.sum(value).alias("want"))
    return b.join(a, key, "left").select(key, F.coalesce("have", F.lit(0)).alias("have"), "want", F.round(F.try_divide(F.coalesce("have", F.lit(0)), "want"), 6).alias("share"))


def screening_plan(live: DataFrame, weeks_live: DataFrame, dense: int, done: DataFrame, dead: DataFrame) -> DataFrame:
    """(country, date) still to ask for: all days of dense live months, days of live weeks of sparse ones, without done and dead days.

    ``live`` is (country, month_start, n), ``weeks_live`` (country, start, end).
    """
    busy = live.filter(F.col("n") >= dense).select("country", F.explode(F.sequence("month_start", F.last_day("month_start"))).alias("date"))
    thin = live.filter(F.col("n") < dense).select("country", F.col("month_start").alias("_m"))
    rest = weeks_live.join(thin, "country").filter(F.trunc("start", "month") == F.col("_m")).select("country", F.explode(F.sequence("start", "end")).alias("date"))
    return busy.unionByName(rest).distinct().join(done, ["country", "date"], "left_anti").join(dead, "date", "left_anti")


def exports(facts: DataFrame, top: int = 10) -> DataFrame:
    """(grain, month, division, district, country, n): the monthly rollup and the ``top`` countries and districts by total."""
    none = lambda name: F.lit(None).cast("string").alias(name)
    rows = facts.groupBy(F.date_format("date", "yyyy-MM").alias("month"), F.col("division").cast("string").alias("division"), "district", "country").agg(F.sum("n").alias("n"))
    best = lambda key: rows.groupBy(key).agg(F.sum("n").alias("n")).orderBy(F.col("n").desc(), key).limit(top)
    countries = best("country").select(F.lit("top_country").alias("grain"), none("month"), none("division"), none("district"), "country", "n")
    districts = best("district").select(F.lit("top_district").alias("grain"), none("month"), none("division"), "district", none("country"), "n")
    return rows.select(F.lit("month").alias("grain"), "month", "division", "district", "country", "n").unionByName(countries).unionByName(districts)
