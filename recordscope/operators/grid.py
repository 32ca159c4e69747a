"""Grid series: daily and monthly rollups, comparisons, profiles, identities, costs, equity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordscope.functions.dates import day_of_365
from recordscope.operators.stats import quantile, rounded, small_quantile


def quarantine(df: DataFrame, limits: Mapping[str, float], key: str) -> tuple[DataFrame, DataFrame]:
    """Values above their ceiling become null; the second result lists them as (key, column, value)."""
    clean = df.withColumns({c: F.when(F.col(c) <= limit, F.col(c)) for c, limit in limits.items()})
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value"), F.lit(limit).alias("limit")) for c, limit in limits.items()]))
    ledger = df.select(key, cells.alias("x")).select(key, "x.*").filter("value > limit").drop("limit")
    return clean, ledger


def daily(hourly: DataFrame, evening: int = 19) -> DataFrame:
    """Per date: readings, whether anything was published, peaks, shed load, hours with shed, the evening reading."""
    shed = F.col("loadshed")
    published = (F.count("demand") > 0) | (F.count("supply") > 0) | (F.coalesce(F.max("loadshed"), F.lit(0.0)) > 0)
    return hourly.groupBy("date").agg(
        F.count("*").alias("n"), published.alias("reported"), F.max("demand").alias("peak_demand"), F.max("supply").alias("peak_supply"), F.max("loadshed").alias("max_loadshed"),
        F.round(F.avg("loadshed"), 2).alias("mean_loadshed"), F.round(F.sum("loadshed"), 2).alias("energy_shed"), F.count_if(shed > 0).alias("hours_shed"), F.max(F.when(F.col("hour") == evening, shed)).alias("evening_loadshed"),
    )


def monthly(day: DataFrame) -> DataFrame:
    """Per month: days, reported days, peaks (zeros left out), 95th percentile and mean of shed load, energy, hours over all days."""
    m = day.withColumn("month", F.date_format("date", "yyyy-MM"))
    peak = F.when(F.col("peak_demand") != 0, F.col("peak_demand"))
    return m.groupBy("month").agg(
        F.count("*").alias("days"), F.count("energy_shed").alias("reported_days"), F.max(peak).alias("peak_demand"), rounded(F.avg(peak), 2).alias("mean_peak_demand"), F.max("max_loadshed").alias("max_loadshed"),
        rounded(F.sum("energy_shed"), 2).alias("energy_shed"), rounded(F.sum("hours_shed") / F.count("*"), 4).alias("mean_hours_shed"),
        small_quantile(F.col("max_loadshed"), 0.95, "floor").alias("p95_loadshed"), small_quantile(F.col("energy_shed"), 0.5, "floor").alias("median_energy_shed"),
    )


def settled(day: DataFrame) -> DataFrame:
    """All days but the newest, which may still fill."""
    newest = day.agg(F.max("date").alias("_newest"))
    return day.join(F.broadcast(newest), F.col("date") < F.col("_newest")).drop("_newest")


def suspect_days(zone: DataFrame, least: int = 5) -> DataFrame:
    """(date, suspect): days with under ``least`` values or the same value in all zones."""
    return zone.groupBy("date").agg(((F.count("demand") < least) | (F.count_distinct("demand") == 1)).alias("suspect"))


def zones_wide(zone: DataFrame, zones: Sequence[str], value: str) -> DataFrame:
    """One column a zone and the total, days that are suspect left out."""
    good = zone.join(suspect_days(zone).filter("not suspect").select("date"), "date", "left_semi")
    wide = good.groupBy("date").pivot("zone", list(zones)).agg(F.round(F.sum(value), 4))
    total = sum((F.coalesce(F.col(f"`{z}`"), F.lit(0.0)) for z in zones), F.lit(0.0))
    return wide.withColumn("total", F.round(total, 4))


def scale_units(df: DataFrame, energy: str, scaled: Sequence[str], nested: str | None = None, over: float = 5000.0) -> DataFrame:
    """Rows whose energy is over the limit were given in a smaller unit: their energy fields, and a map of maps, go down by 1000."""
    slip = F.coalesce(F.col(energy) > over, F.lit(False))
    out = {c: F.when(slip, F.col(c) / 1000).otherwise(F.col(c)) for c in scaled}
    if nested:
        out[nested] = F.when(slip, F.transform_values(nested, lambda _, m: F.transform_values(m, lambda _, v: v / 1000))).otherwise(F.col(nested))
    return df.withColumns({**out, "unit_slip": slip})


def drop_implausible(df: DataFrame, items: str, field: str, most: float) -> tuple[DataFrame, DataFrame]:
    """Array elements over the ceiling go; the second result lists them beside the other columns."""
    over = lambda x: F.coalesce(x[field], F.lit(0.0)) > most
    gone = df.select(*[c for c in df.columns if c != items], F.explode(F.filter(items, over)).alias("item"))
    return df.withColumn(items, F.filter(items, lambda x: ~over(x))), gone


def fuel_mix(report: DataFrame, nested: str = "zone_fuel") -> DataFrame:
    """(date, fuel, energy, share) from a map of zones to maps of fuels; days without a positive total go."""
    flat = report.select("date", F.explode(nested).alias("zone", "fuels")).select("date", F.explode("fuels").alias("fuel", "energy"))
    per = flat.groupBy("date", "fuel").agg(F.sum("energy").alias("energy"))
    total = F.sum("energy").over(Window.partitionBy("date"))
    return per.withColumn("_t", total).filter("_t > 0").select("date", "fuel", F.round("energy", 4).alias("energy"), F.round(F.col("energy") / F.col("_t"), 6).alias("share"))


def fuel_monthly(mix: DataFrame, groups: Mapping[str, str], costs: DataFrame | None = None) -> DataFrame:
    """Fuel groups per month as a daily average over the days with a mix; with ``costs`` (date, unit_cost) also the mean over priced days."""
    named = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in groups.items() for x in kv]), F.col("fuel")), F.lit("other"))
    m = mix.withColumn("month", F.date_format("date", "yyyy-MM"))
    days = m.groupBy("month").agg(F.count_distinct("date").alias("days"))
    out = m.groupBy("month", named.alias("group")).agg(F.sum("energy").alias("e")).join(days, "month").select("month", "group", "days", F.round(F.col("e") / F.col("days"), 4).alias("daily"))
    if costs is None:
        return out
    priced = costs.filter("unit_cost > 0").join(mix.select("date").distinct(), "date", "left_semi").groupBy(F.date_format("date", "yyyy-MM").alias("month"))
    return out.join(priced.agg(rounded(F.avg("unit_cost"), 3).alias("unit_cost"), F.count("*").alias("priced_days")), "month", "left").withColumn("priced_days", F.coalesce("priced_days", F.lit(0)))


def shortfall_causes(day: DataFrame, causes: Sequence[str]) -> DataFrame:
    """(date, causes, total): stated shortfalls by cause, nulls as 0, of the days that state any."""
    said = F.size(F.array_compact(F.array(*causes))) > 0
    some = day.filter(said).select("date", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in causes])
    return some.withColumn("total", sum((F.col(c) for c in causes), F.lit(0.0)))


def same_month_change(day: DataFrame, value: str, by: Sequence[str] = (), least: int = 1) -> DataFrame:
    """Mean of the newest month and of its month a year before, over the same days of the month, and the change in percent."""
    newest = day.filter(F.col(value).isNotNull()).agg(F.max("date").alias("_d"))
    rows = day.join(F.broadcast(newest)).filter(F.dayofmonth("date") <= F.dayofmonth("_d"))
    now = F.trunc("date", "month") == F.trunc("_d", "month")
    then = F.trunc("date", "month") == F.trunc(F.add_months("_d", -12), "month")
    out = rows.groupBy(*by).agg(F.avg(F.when(now, F.col(value))).alias("a"), F.avg(F.when(then, F.col(value))).alias("b"), F.count(F.when(now, F.col(value))).alias("n"), F.count(F.when(then, F.col(value))).alias("m"))
    change = F.when((F.col("n") >= least) & (F.col("m") >= least), F.round(F.try_divide(F.col("a") - F.col("b"), "b") * 100, 4))
    return out.select(*by, F.round("a", 4).alias("now"), F.round("b", 4).alias("then"), "n", "m", change.alias("change_pct"))


def latest_with(df: DataFrame, items: str, date: str = "date") -> DataFrame:
    """All rows of the newest date on which ``items`` is not empty."""
    full = df.filter(F.size(F.coalesce(items, F.array().cast(dict(df.dtypes)[items]))) > 0)
    return full.join(F.broadcast(full.agg(F.max(date).alias(date))), date, "left_semi")


def idle_by_reason(plants: DataFrame, reason: Column) -> DataFrame:
    """(date, reason, n, idle): capacity of plants that stood still, by stated reason."""
    still = plants.filter((F.col("capacity") > 0) & (F.coalesce("peak", F.lit(0.0)) <= 0))
    return still.groupBy("date", reason.alias("reason")).agg(F.count("*").alias("n"), F.round(F.sum("capacity"), 2).alias("idle"))


def idle_and_use(capacity: Column, peak: Column) -> tuple[Column, Column]:
    """Idle capacity, not below 0, and use as a share of capacity (null without capacity)."""
    return F.greatest(capacity - F.coalesce(peak, F.lit(0.0)), F.lit(0.0)), F.when(capacity > 0, F.try_divide(peak, capacity))


def fill_by_priority(frames: Sequence[DataFrame], key: str, fields: Sequence[str]) -> DataFrame:
    """Full join of sources on a key; each field comes from the first source that has it."""
    tagged = None
    for k, df in enumerate(frames):
        part = df.select(key, F.lit(k).alias("_k"), *[F.col(f) if f in df.columns else F.lit(None).cast("double").alias(f) for f in fields])
        tagged = part if tagged is None else tagged.unionByName(part)
    best = [F.min_by(F.col(f), F.when(F.col(f).isNotNull(), F.col("_k"))).alias(f) for f in fields]
    return tagged.groupBy(key).agg(*best)


def forecast_score(forecast: DataFrame, actual: DataFrame) -> DataFrame:
    """Per year, and overall (null year): scored days, zero forecasts, missed days, mean shed on missed days, worst day."""
    day = forecast.join(actual, "date").withColumn("year", F.year("date"))
    missed = (F.col("forecast") <= 0) & (F.col("actual") > 0)
    return day.rollup("year").agg(
        F.count("*").alias("days"), F.count_if(F.col("forecast") <= 0).alias("zero_forecasts"), F.count_if(missed).alias("missed"), F.round(F.avg(F.when(missed, F.col("actual"))), 4).alias("mean_missed"),
        F.max_by("date", F.struct(F.when(missed, F.col("actual")).alias("a"), F.when(missed, -F.unix_date("date")))).alias("worst"),
    )


def identity_rate(df: DataFrame, left: Column, right: Column, tolerance: float) -> DataFrame:
    """One row: complete rows, rows where both sides agree within the tolerance, and their share."""
    both = df.filter(left.isNotNull() & right.isNotNull())
    ok = F.count_if(F.abs(left - right) <= tolerance)
    return both.agg(F.count("*").alias("n"), ok.alias("agree"), F.round(F.try_divide(ok, F.count("*")), 6).alias("rate"))


def identity_factor(df: DataFrame, within: float = 0.002, least: int = 24) -> DataFrame:
    """(demand - supply) / shed where load was shed: per month with ``least`` hours and overall, its median and how often it is near that."""
    rows = df.filter("loadshed > 0 and demand is not null and supply is not null").select(F.date_format("datetime", "yyyy-MM").alias("month"), ((F.col("demand") - F.col("supply")) / F.col("loadshed")).alias("factor"))
    mid = quantile(rows, [], "factor", 0.5, "interpolated", "m")
    near = F.round(F.count_if(F.abs(F.col("factor") - F.col("m")) <= within) / F.count("*"), 6).alias("near")
    counts = rows.crossJoin(F.broadcast(mid)).rollup("month").agg(F.count("*").alias("n"), near)
    per = quantile(rows, ["month"], "factor", 0.5, "interpolated", "_q")
    out = counts.join(per, "month", "left").crossJoin(F.broadcast(mid)).withColumn("median", F.round(F.coalesce("_q", "m"), 6))
    return out.filter(F.col("month").isNull() | (F.col("n") >= least)).select("month", "n", "median", "near")


def zero_against(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row: how often one source says 0 while the other is above 0, and the sum so hidden."""
    hid = (F.col(a) == 0) & (F.col(b) > 0)
    return df.agg(F.count("*").alias("n"), F.count_if(hid).alias("hidden"), F.round(F.coalesce(F.sum(F.when(hid, F.col(b))), F.lit(0.0)), 2).alias("hidden_sum"))


def completeness(df: DataFrame, columns: Sequence[str], date: str = "date") -> DataFrame:
    """Per year: rows, and for each column its non-null and non-zero counts."""
    aggs = [f for c in columns for f in (F.count(c).alias(f"{c}_present"), F.count_if(F.col(c) != 0).alias(f"{c}_nonzero"))]
    return df.groupBy(F.year(date).alias("year")).agg(F.count("*").alias("n"), *aggs)


def annual_growth(day: DataFrame, value: str, least: int = 200) -> DataFrame:
    """Per year with enough positive days: days, upper median, 95th percentile, minimum, and growth since the first such year."""
    rows = day.filter(F.col(value) > 0).withColumn("year", F.year("date"))
    cuts = [small_quantile(F.col(value), 0.5, "upper").alias("median"), small_quantile(F.col(value), 0.95, "floor").alias("p95")]
    out = rows.groupBy("year").agg(F.count("*").alias("days"), F.min(value).alias("least"), *cuts).filter(F.col("days") >= least)
    w = Window.orderBy("year").rowsBetween(Window.unboundedPreceding, 0)
    first, start = F.first("median").over(w), F.first("year").over(w)
    span = F.col("year") - start
    return out.select("year", "days", "median", "p95", "least", F.round((F.col("median") / first - 1) * 100, 4).alias("growth_pct"), F.when(span > 0, F.round((F.power(F.col("median") / first, 1 / span) - 1) * 100, 4)).alias("cagr_pct"))


def demand_split(day: DataFrame, served: str, shed: str, months: tuple[int, int] = (4, 9)) -> DataFrame:
    """Per year: mean served and shed over the months, for all years only up to the newest year's last day, and the share of the rise that is shed."""
    rows = day.filter(F.month("date").between(*months))
    newest = rows.agg(F.max("date").alias("_d"))
    same = F.date_format("date", "MMdd") <= F.date_format("_d", "MMdd")
    per = rows.join(F.broadcast(newest)).filter(same).groupBy(F.year("date").alias("year")).agg(F.count("*").alias("days"), F.avg(served).alias("s"), F.avg(shed).alias("h"))
    w = Window.orderBy("year")
    ds, dh = F.col("s") - F.lag("s").over(w), F.col("h") - F.lag("h").over(w)
    return per.select("year", "days", F.round("s", 4).alias("served"), F.round("h", 4).alias("shed"), F.round(F.try_divide(dh, ds + dh), 6).alias("shed_share_of_rise"))


def mix_price(parts: DataFrame, now: str, then: str) -> DataFrame:
    """One row: change of unit cost between two months split into change of shares at old prices and of prices at new shares.

    ``parts`` has (month, group, share, price) a day; groups count if both months have them. The two parts sum to the change.
    """
    mean = parts.filter(F.col("month").isin(now, then)).groupBy("month", "group").agg(F.avg("share").alias("share"), F.avg("price").alias("price"))
    a, b = (mean.filter(F.col("month") == m).select("group", F.col("share").alias(f"s{k}"), F.col("price").alias(f"p{k}")) for k, m in (("1", now), ("0", then)))
    both = a.join(b, "group")
    total = lambda c: F.round(F.sum(c), 6)
    return both.agg(F.count("*").alias("groups"), total((F.col("s1") - F.col("s0")) * F.col("p0")).alias("mix"), total(F.col("s1") * (F.col("p1") - F.col("p0"))).alias("price"), total(F.col("s1") * F.col("p1") - F.col("s0") * F.col("p0")).alias("change"))


def unit_costs(fuel: DataFrame, within: float = 0.15, least: float = 1.0) -> DataFrame:
    """Cost per unit of energy by (date, fuel): energies a thousandfold too large are rescaled, days whose fuels do not add up to the stated total within the tolerance are left out."""
    total = F.sum("energy").over(Window.partitionBy("date"))
    rows = fuel.withColumn("_sum", total).withColumn("_k", F.when(F.col("_sum") > 500 * F.col("stated"), 1000.0).otherwise(1.0))
    ok = rows.filter((F.abs(F.col("_sum") / F.col("_k") - F.col("stated")) <= within * F.col("stated")) & (F.col("energy") / F.col("_k") >= least))
    return ok.select("date", "fuel", F.round(F.col("cost") / (F.col("energy") / F.col("_k")), 6).alias("unit_cost"))


def equity(zone: DataFrame, windows: Sequence[int | None]) -> DataFrame:
    """Per window of the newest report days and zone: shed rate, demand per head, share of shed over share of demand."""
    latest = zone.select("date").distinct().withColumn("age", F.dense_rank().over(Window.orderBy(F.col("date").desc())))
    spans = F.explode(F.array(*[F.lit(w or 0) for w in windows]))
    rows = zone.join(latest, "date").withColumn("window", spans).filter((F.col("window") == 0) | (F.col("age") <= F.col("window")))
    per = rows.groupBy("window", "zone").agg(F.sum("demand").alias("d"), F.sum("shed").alias("s"), F.first("population").alias("population"), F.count_distinct("date").alias("days"))
    w = Window.partitionBy("window")
    fair = F.try_divide(F.try_divide(F.col("s"), F.sum("s").over(w)), F.try_divide(F.col("d"), F.sum("d").over(w)))
    return per.select("window", "zone", "days", F.round(F.try_divide("s", "d"), 6).alias("shed_rate"), F.round(F.try_divide(F.col("d") / F.col("days"), "population"), 6).alias("per_head"), F.round(fair, 6).alias("shed_over_demand"), F.round(F.try_divide(F.sum("s").over(w), F.sum("d").over(w)), 6).alias("national_rate"))


def slot_profile(half: DataFrame, values: Sequence[str], window: int = 30, least: int = 40) -> DataFrame:
    """Mean of each value by time slot over the newest ``window`` days with ``least`` slots or more."""
    days = half.groupBy("date").agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    days = days.withColumn("k", F.row_number().over(Window.orderBy(F.col("date").desc()))).filter(F.col("k") <= window)
    return half.join(days.select("date"), "date", "left_semi").groupBy("slot").agg(F.count("*").alias("n"), *[F.round(F.avg(v), 4).alias(v) for v in values])


def profile_features(profile: DataFrame, values: Sequence[str]) -> DataFrame:
    """(value, swing, peak_slot, trough_slot, share): each value's daily swing and its share of all swings."""
    at = lambda f, v, s: f("slot", F.struct(F.col(v), s * F.col("slot"))).alias("x")
    out = None
    for v in values:
        one = profile.agg(F.round(F.max(v) - F.min(v), 4).alias("swing"), at(F.max_by, v, -1).alias("peak_slot"), at(F.min_by, v, 1).alias("trough_slot")).withColumn("value", F.lit(v))
        out = one if out is None else out.unionByName(one)
    return out.select("value", "swing", "peak_slot", "trough_slot", F.round(F.try_divide("swing", F.sum("swing").over(Window.partitionBy())), 6).alias("share"))


def shape_features(half: DataFrame, fuels: Sequence[str], oils: Sequence[str], shortage: str) -> DataFrame:
    """One row from half-hour readings (slot, fuels, shortage): when the day peaks and dips, the oils' peak and share of the swing, and
    the slot of worst shortage by median and by mean; earlier slots win ties.

    Slots are summarised first (means of the fuels, median and mean of the shortage), so the last step sees one row a slot.
    """
    mean = half.groupBy("slot").agg(*[rounded(F.avg(f), 2).alias(f) for f in fuels], rounded(F.avg(shortage), 2).alias("_mean"))
    slots = mean.join(quantile(half, ["slot"], shortage, 0.5, "interpolated", "_median"), "slot").withColumn("_median", rounded(F.col("_median"), 2))
    add = lambda names: sum((F.coalesce(n, F.lit(0.0)) for n in names), F.lit(0.0))
    slots = slots.withColumn("_all", add(fuels)).withColumn("_oil", add(oils))
    most = lambda what, by: F.max_by(what, F.when(F.col(by).isNotNull(), F.struct(F.col(by), -F.col("slot"))))
    swing = lambda c: F.max(c) - F.min(c)
    return slots.agg(
        most("slot", "_all").alias("peak_slot"), F.min_by("slot", F.struct("_all", "slot")).alias("trough_slot"), most("slot", "_oil").alias("oil_peak_slot"), rounded(F.max("_oil"), 1).alias("oil_peak"),
        rounded(F.max("_oil") - F.min_by("_oil", F.struct("_all", "slot")), 1).alias("oil_swing"), rounded(100 * F.try_divide(rounded(swing("_oil"), 1), rounded(swing("_all"), 1)), 1).alias("oil_share_of_swing"),
        most("slot", "_median").alias("shortage_slot"), F.max("_median").alias("shortage"), most("slot", "_mean").alias("shortage_mean_slot"), F.max("_mean").alias("shortage_mean"),
    )


def like_for_like(day: DataFrame, value: str, span: int = 30, back: Sequence[int] = (0, 1, 2, 3, 4), unit: int = 12, least: int = 1) -> DataFrame:
    """Mean over the last ``span`` days and the same days in earlier periods of ``unit`` months: (back, days, mean)."""
    newest = day.filter(F.col(value).isNotNull()).agg(F.max("date").alias("_d"))
    bounds = newest.select(F.explode(F.array(*[F.lit(b) for b in back])).alias("back"), "_d").select("back", F.add_months("_d", -unit * F.col("back")).alias("to"))
    bounds = bounds.withColumn("from", F.date_sub("to", span - 1))
    # few windows: each day is expanded to the windows that hold it, an equality on the day
    spans = bounds.select("back", F.explode(F.sequence("from", "to")).alias("date"))
    out = day.join(F.broadcast(spans), "date").groupBy("back").agg(F.count(value).alias("days"), F.round(F.avg(value), 4).alias("mean"))
    return out.filter(F.col("days") >= least)


def holiday_dips(day: DataFrame, holidays: DataFrame, value: str, least: int = 8, drop: float = 0.05) -> DataFrame:
    """Per holiday: lowest value of day -1 to +3 against the upper median of days -28 to -8; dips under ``drop`` are left out."""
    near = holidays.select("holiday", F.explode(F.sequence(F.date_sub("holiday", 28), F.date_add("holiday", 3))).alias("date"))
    rows = day.join(near, "date").withColumn("gap", F.datediff("date", "holiday")).filter(F.col(value).isNotNull())
    low = rows.filter(F.col("gap").between(-1, 3)).groupBy("holiday").agg(F.min(value).alias("low"), F.min_by("date", F.struct(value, "date")).alias("low_date"))
    before = rows.filter(F.col("gap").between(-28, -8))
    base = before.groupBy("holiday").agg(F.count("*").alias("n"), small_quantile(F.col(value), 0.5, "upper").alias("base")).filter(F.col("n") >= least)
    out = low.join(base, "holiday").withColumn("dip", 1 - F.col("low") / F.col("base"))
    return out.filter(F.col("dip") >= drop).select("holiday", "low_date", "low", "base", F.round("dip", 6).alias("dip"))


def seasonal_curve(day: DataFrame, value: str, half: int = 3) -> DataFrame:
    """(year, doy, value, mean): each year on a dense axis of 365 days with a centred mean, cut after its last value."""
    rows = day.select(F.year("date").alias("year"), day_of_365(F.col("date")).alias("doy"), F.col(value).alias("value")).groupBy("year", "doy").agg(F.max("value").alias("value"))
    last = rows.filter("value is not null").groupBy("year").agg(F.max("doy").alias("last"))
    spine = last.select("year", F.explode(F.sequence(F.lit(1), F.col("last"))).alias("doy"))
    w = Window.partitionBy("year").orderBy("doy").rowsBetween(-half, half)
    return spine.join(rows, ["year", "doy"], "left").withColumn("mean", F.round(F.avg("value").over(w), 4))


def same_hour_context(hourly: DataFrame, value: str, last: int = 90) -> DataFrame:
    """Per hour of day: the newest reading against quartiles of the last ``last`` readings of that hour."""
    w = Window.partitionBy("hour").orderBy(F.col("datetime").desc())
    rows = hourly.filter(F.col(value).isNotNull()).withColumn("k", F.row_number().over(w)).filter(F.col("k") <= last)
    cuts = [small_quantile(F.col(value), q, "floor").alias(name) for name, q in (("q1", 0.25), ("q2", 0.5), ("q3", 0.75))]
    return rows.groupBy("hour").agg(F.count("*").alias("n"), F.max(F.when(F.col("k") == 1, F.col(value))).alias("latest"), *cuts)


def people_equivalent(hourly: DataFrame, shed: str = "loadshed", kwh_a_day: float = 560 / 365) -> DataFrame:
    """(date, shed, people): the people whose daily use equals a day's shed energy; hours without a value count 0."""
    day = hourly.groupBy("date").agg(F.sum(F.coalesce(shed, F.lit(0.0))).alias("shed"))
    return day.select("date", rounded(F.col("shed"), 2).alias("shed"), F.floor(F.col("shed") * 1000 / F.lit(kwh_a_day) + 1e-6).alias("people"))


def cost_monthly(costs: DataFrame) -> DataFrame:
    """(month, days, cost, unit_cost, first, last): daily averages of total cost and unit cost of days with cost and energy.

    ``costs`` is (date, cost, energy, stated); a day without a stated unit cost takes cost over energy.
    """
    day = costs.filter("cost > 0 and energy > 0").withColumn("u", F.coalesce(F.when(F.col("stated") > 0, F.col("stated")), rounded(F.col("cost") / F.col("energy"), 3)))
    out = day.groupBy(F.date_format("date", "yyyy-MM").alias("month")).agg(F.count("*").alias("days"), rounded(F.avg("cost"), 1).alias("cost"), rounded(F.avg("u"), 3).alias("unit_cost"), F.min("date").alias("first"), F.max("date").alias("last"))
    return out


def cost_coverage(costs: DataFrame) -> DataFrame:
    """One row: days with cost and energy, the first and last of them, and the last one's cost and blended unit cost."""
    day = costs.filter("cost > 0 and energy > 0")
    newest = F.max(F.struct("date", "cost", "energy"))
    return day.agg(F.count("*").alias("days"), F.min("date").alias("first"), F.max("date").alias("last"), rounded(newest["cost"], 1).alias("cost"), rounded(newest["cost"] / newest["energy"], 3).alias("unit_cost"))


def recent_mean(df: DataFrame, by: str, value: str, last: int = 30, date: str = "date") -> DataFrame:
    """Mean of the last ``last`` rows with a value, per group."""
    w = Window.partitionBy(by).orderBy(F.col(date).desc())
    rows = df.filter(F.col(value).isNotNull()).withColumn("k", F.row_number().over(w)).filter(F.col("k") <= last)
    return rows.groupBy(by).agg(F.count("*").alias("n"), F.round(F.avg(value), 4).alias("mean"))


def metric_disagreement(month: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """One row: the worst month by each metric (the earlier on a tie) and whether they differ."""
    worst = [F.max_by("month", F.struct(F.col(m), -F.regexp_replace("month", "-", "").cast("int"))).alias(m) for m in metrics]
    return month.agg(*worst).withColumn("differ", F.size(F.array_distinct(F.array(*[F.col(m) for m in metrics]))) > 1)


def latest_block(hourly: DataFrame, zone: DataFrame) -> DataFrame:
    """One row: last reading, its day's and the day before's highest shed load, and the zone with most shed on its newest day."""
    last = hourly.agg(F.max("datetime").alias("datetime"), F.max_by("demand", "datetime").alias("demand"), F.max_by("loadshed", "datetime").alias("loadshed"))
    rows = hourly.crossJoin(F.broadcast(last.select(F.to_date("datetime").alias("_d"))))
    two = rows.agg(F.max(F.when(F.col("date") == F.col("_d"), F.col("loadshed"))).alias("today"), F.max(F.when(F.col("date") == F.date_sub("_d", 1), F.col("loadshed"))).alias("yesterday"))
    newest = zone.join(F.broadcast(zone.agg(F.max("date").alias("date"))), "date", "left_semi")
    worst = newest.agg(F.max_by("zone", F.struct(F.col("shed"), F.col("zone"))).alias("worst_zone"))
    return last.crossJoin(two).crossJoin(worst)


def freshness(sources: Mapping[str, DataFrame], date: str = "date") -> DataFrame:
    """(source, first, last, days) of each source."""
    out = None
    for name, df in sources.items():
        one = df.agg(F.lit(name).alias("source"), F.min(date).alias("first"), F.max(date).alias("last"), F.count_distinct(date).alias("days"))
        out = one if out is None else out.unionByName(one)
    return out


def blended_fuel_cost(fuel: DataFrame, within: float = 0.05, least: int = 60) -> DataFrame:
    """Per fuel with ``least`` good days: shares of cost and energy; a day is good if its blended cost reproduces the stated one."""
    w = Window.partitionBy("date")
    rows = fuel.withColumn("_b", F.try_divide(F.sum("cost").over(w), F.sum("energy").over(w)))
    good = rows.filter(F.abs(F.col("_b") - F.col("stated")) <= within * F.col("stated"))
    per = good.groupBy("fuel").agg(F.count_distinct("date").alias("days"), F.sum("cost").alias("c"), F.sum("energy").alias("e")).filter(F.col("days") >= least)
    every = Window.partitionBy()
    return per.select("fuel", "days", F.round(F.col("c") / F.sum("c").over(every), 6).alias("cost_share"), F.round(F.col("e") / F.sum("e").over(every), 6).alias("energy_share"))


def reported(df: DataFrame, value: str, cutoff: str, date: str = "date") -> DataFrame:
    """Adds ``reported``: before the cutoff a 0 means that nothing was published, after it any value counts."""
    told = F.when(F.col(date) < F.lit(cutoff).cast("date"), F.coalesce(F.col(value) > 0, F.lit(False))).otherwise(F.col(value).isNotNull())
    return df.withColumn("reported", told)
