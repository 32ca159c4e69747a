"""Grid queries: hourly readings from events, daily and zone readings from line items, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordscope.functions.text import cause
from recordscope.operators import grid as g
from recordscope.operators import sets
from recordscope.operators import stats as st
from recordscope.plans.base import DAYS, FUELS, HOURLY, ZONES, fuel_days, hourly, line_days, query, table, zone_days

REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
DAILY = HOURLY + """, daily AS (SELECT date, count(*) AS n, count(demand) > 0 OR count(supply) > 0 OR coalesce(max(loadshed), 0) > 0 AS reported, max(demand) AS peak_demand, max(supply) AS peak_supply, max(loadshed) AS max_loadshed,
  round(avg(loadshed), 2) AS mean_loadshed, round(sum(loadshed), 2) AS energy_shed, count(*) FILTER (loadshed > 0) AS hours_shed, max(loadshed) FILTER (hour = 19) AS evening_loadshed FROM hourly GROUP BY date)"""


@query("SELECT event_id, CASE WHEN value <= 100 THEN value END AS value FROM events")
def c13_quarantined(spark, d):
    return g.quarantine(table(spark, d, "events").select("event_id", "value"), {"value": 100.0}, "event_id")[0]


@query("SELECT event_id, 'value' AS \"column\", value FROM events WHERE value > 100")
def c13_ledger(spark, d):
    return g.quarantine(table(spark, d, "events").select("event_id", "value"), {"value": 100.0}, "event_id")[1]


@query(f"WITH {DAILY} SELECT * FROM daily")
def a28_daily(spark, d):
    return g.daily(hourly(spark, d))


@query(f"""WITH {DAYS}, m AS (SELECT date, demand, shed, strftime(date, '%Y-%m') AS month FROM days), r AS (SELECT month, shed, row_number() OVER (PARTITION BY month ORDER BY shed) - 1 AS k, count(*) OVER (PARTITION BY month) AS n FROM m)
SELECT month, count(*) AS days, count(shed) AS reported_days, max(demand) AS peak_demand, round(avg(demand)::DECIMAL(38,6), 2)::DOUBLE AS mean_peak_demand, max(shed) AS max_loadshed, round(sum(shed)::DECIMAL(38,6), 2)::DOUBLE AS energy_shed, round((sum(day(date) % 5)::DOUBLE / count(*))::DECIMAL(38,6), 4)::DOUBLE AS mean_hours_shed,
  (SELECT max(shed) FROM r WHERE r.month = m.month AND k = floor(0.95::DOUBLE * (n - 1))) AS p95_loadshed, (SELECT max(shed) FROM r WHERE r.month = m.month AND k = floor(0.5::DOUBLE * (n - 1))) AS median_energy_shed FROM m GROUP BY month""")
def a29_monthly(spark, d):
    day = line_days(spark, d).select("date", F.col("demand").alias("peak_demand"), F.col("shed").alias("max_loadshed"), F.col("shed").alias("energy_shed"), (F.dayofmonth("date") % 5).alias("hours_shed"))
    return g.monthly(day)


@query(f"WITH {DAILY} SELECT date, n FROM daily WHERE date < (SELECT max(date) FROM daily)")
def t3_settled_days(spark, d):
    return g.settled(g.daily(hourly(spark, d))).select("date", "n")


@query(f"WITH {ZONES} SELECT date, count(demand) < 5 OR count(DISTINCT demand) = 1 AS suspect FROM zones GROUP BY 1")
def c26_suspect_days(spark, d):
    return g.suspect_days(zone_days(spark, d))


@query(f"""WITH {ZONES}, ok AS (SELECT * FROM zones WHERE date IN (SELECT date FROM zones GROUP BY 1 HAVING count(demand) >= 5 AND count(DISTINCT demand) > 1))
SELECT date, round(sum(shed) FILTER (zone = 'AFRICA'), 4) AS "AFRICA", round(sum(shed) FILTER (zone = 'AMERICA'), 4) AS "AMERICA", round(sum(shed) FILTER (zone = 'ASIA'), 4) AS "ASIA", round(sum(shed) FILTER (zone = 'EUROPE'), 4) AS "EUROPE",
  round(sum(shed) FILTER (zone = 'MIDDLE EAST'), 4) AS "MIDDLE EAST", round(sum(shed), 4) AS total FROM ok GROUP BY 1""")
def a35_zones_wide(spark, d):
    return g.zones_wide(zone_days(spark, d), REGIONS, "shed")


def zone_maps(spark, d):
    """Daily reports with a map of zones to maps of fuels."""
    f = fuel_days(spark, d).groupBy("date").agg(F.map_from_entries(F.collect_list(F.struct("fuel", "energy"))).alias("m"), F.max("stated_energy").alias("total"))
    return f.select("date", F.col("total").alias("energy"), F.create_map(F.lit("north"), F.col("m"), F.lit("south"), F.col("m")).alias("zone_fuel"))


@query(f"WITH {FUELS} SELECT date, fuel, round(2 * energy, 4) AS energy, round(energy / stated_energy, 6) AS share FROM fuels")
def a30_fuel_mix(spark, d):
    return g.fuel_mix(zone_maps(spark, d))


@query(f"""WITH {FUELS}, m AS (SELECT strftime(date, '%Y-%m') AS month, CASE WHEN fuel IN ('A', 'R') THEN 'oil' ELSE 'other' END AS grp, 2 * energy AS energy, date FROM fuels)
SELECT month, grp AS "group", days, round(e / days, 4) AS daily FROM (SELECT month, grp, sum(round(energy, 4)) AS e FROM m GROUP BY 1, 2) JOIN (SELECT month, count(DISTINCT date) AS days FROM m GROUP BY 1) USING (month)""")
def a31_fuel_monthly(spark, d):
    return g.fuel_monthly(g.fuel_mix(zone_maps(spark, d)), {"A": "oil", "R": "oil"})


@query(f"""WITH {FUELS}, m AS (SELECT strftime(date, '%Y-%m') AS month, CASE WHEN fuel IN ('A', 'R') THEN 'oil' ELSE 'other' END AS grp, round(2 * energy, 4) AS energy, date FROM fuels), d AS (SELECT month, count(DISTINCT date) AS days FROM m GROUP BY 1),
c AS (SELECT strftime(date, '%Y-%m') AS month, round(avg(stated)::DECIMAL(38,6), 3)::DOUBLE AS unit_cost, count(*) AS priced FROM (SELECT date, max(stated) AS stated FROM fuels GROUP BY 1) WHERE day(date) % 4 <> 0 GROUP BY 1)
SELECT month, grp AS "group", days, round(e / days, 4) AS daily, unit_cost, coalesce(priced, 0) AS priced_days FROM (SELECT month, grp, sum(energy) AS e FROM m GROUP BY 1, 2) JOIN d USING (month) LEFT JOIN c USING (month)""")
def a31_fuel_costs(spark, d):
    costs = fuel_days(spark, d).groupBy("date").agg(F.max("stated").alias("stated")).select("date", F.when(F.dayofmonth("date") % 4 != 0, F.col("stated")).alias("unit_cost"))
    return g.fuel_monthly(g.fuel_mix(zone_maps(spark, d)), {"A": "oil", "R": "oil"}, costs)


@query("""WITH c AS (SELECT l_shipdate::DATE AS date, round(sum(l_quantity) FILTER (l_returnflag = 'A'), 2) AS gas, round(sum(l_quantity) FILTER (l_returnflag = 'R'), 2) AS coal, round(sum(l_quantity) FILTER (l_linenumber = 7), 2) AS maintenance FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1)
SELECT date, coalesce(gas, 0) AS gas, coalesce(coal, 0) AS coal, coalesce(maintenance, 0) AS maintenance, coalesce(gas, 0) + coalesce(coal, 0) + coalesce(maintenance, 0) AS total FROM c""")
def a36_causes(spark, d):
    l, q = table(spark, d, "lineitem"), F.col("l_quantity")  # noqa: E741
    some = lambda ok: F.round(F.sum(F.when(ok & (F.col("l_returnflag") != "N"), q)), 2)
    day = l.groupBy(F.to_date("l_shipdate").alias("date")).agg(some(F.col("l_returnflag") == "A").alias("gas"), some(F.col("l_returnflag") == "R").alias("coal"), some(F.col("l_linenumber") == 7).alias("maintenance"))
    return g.shortfall_causes(day, ["gas", "coal", "maintenance"])


@query(f"WITH {FUELS} SELECT date, stated_energy / CASE WHEN stated_energy > 1200 THEN 1000 ELSE 1 END AS energy, fuel, energy / CASE WHEN stated_energy > 1200 THEN 1000 ELSE 1 END AS north, stated_energy > 1200 AS unit_slip FROM fuels")
def c15_rescaled(spark, d):
    out = g.scale_units(zone_maps(spark, d), "energy", ["energy"], "zone_fuel", 1200.0)
    return out.select("date", "energy", "unit_slip", F.explode(F.element_at("zone_fuel", "north")).alias("fuel", "north"))


@query(f"""WITH {DAYS}, b AS (SELECT max(date) AS d FROM days), r AS (SELECT * FROM days, b WHERE day(date) <= day(d)),
s AS (SELECT avg(demand) FILTER (date_trunc('month', date) = date_trunc('month', d)) AS a, avg(demand) FILTER (date_trunc('month', date) = date_trunc('month', d - INTERVAL 12 MONTH)) AS b, count(*) FILTER (date_trunc('month', date) = date_trunc('month', d)) AS n, count(*) FILTER (date_trunc('month', date) = date_trunc('month', d - INTERVAL 12 MONTH)) AS m FROM r)
SELECT round(a, 4) AS now, round(b, 4) AS "then", n, m, CASE WHEN n >= 1 AND m >= 1 THEN round((a - b) / b * 100, 4) END AS change_pct FROM s""")
def a32_same_month(spark, d):
    return g.same_month_change(line_days(spark, d), "demand")


PLANTS = "plants AS (SELECT l_shipdate::DATE AS date, l_partkey AS plant, l_quantity AS capacity, CASE WHEN l_discount > 0.05 THEN 0 ELSE l_quantity * l_tax END AS peak, ['gas shortage', 'under overhaul', '-', 'reserve'][l_suppkey % 4 + 1] AS remark FROM lineitem)"


def plants(spark, d):
    l = table(spark, d, "lineitem")  # noqa: E741
    remark = F.element_at(F.array(*[F.lit(x) for x in ("gas shortage", "under overhaul", "-", "reserve")]), (F.col("l_suppkey") % 4 + 1).cast("int"))
    return l.select(F.to_date("l_shipdate").alias("date"), F.col("l_partkey").alias("plant"), F.col("l_quantity").alias("capacity"), F.when(F.col("l_discount") > 0.05, 0.0).otherwise(F.col("l_quantity") * F.col("l_tax")).alias("peak"), remark.alias("remark"))


@query(f"""WITH {PLANTS} SELECT date, CASE remark WHEN 'gas shortage' THEN 'gas_shortage' WHEN 'under overhaul' THEN 'maintenance' WHEN '-' THEN 'none' ELSE 'not_needed' END AS reason, count(*) AS n, round(sum(capacity), 2) AS idle FROM plants WHERE capacity > 0 AND peak <= 0 GROUP BY 1, 2""")
def a33_idle_by_reason(spark, d):
    return g.idle_by_reason(plants(spark, d), cause(F.col("remark")))


@query(f"WITH {PLANTS} SELECT date, round(sum(greatest(capacity - peak, 0)), 2) AS idle, round(sum(CASE WHEN capacity > 0 THEN peak / capacity END), 4) AS uses FROM plants GROUP BY 1")
def c28_idle_and_use(spark, d):
    idle, use = g.idle_and_use(F.col("capacity"), F.col("peak"))
    return plants(spark, d).groupBy("date").agg(F.round(F.sum(idle), 2).alias("idle"), F.round(F.sum(use), 4).alias("uses"))


def plant_reports(spark, d):
    return plants(spark, d).groupBy("date").agg(F.array_sort(F.collect_list(F.struct("plant", "capacity"))).alias("plants"))


@query(f"WITH {PLANTS} SELECT date, count(*) AS n FROM plants WHERE month(date) <= 3 AND date = (SELECT max(date) FROM plants WHERE month(date) <= 3) GROUP BY 1")
def a34_latest_with(spark, d):
    # the reports of later months list no plants
    listed = F.when(F.month("date") <= 3, F.col("plants")).otherwise(F.array().cast("array<struct<plant:bigint,capacity:double>>"))
    return g.latest_with(plant_reports(spark, d).withColumn("plants", listed), "plants").select("date", F.size("plants").cast("long").alias("n"))


@query(f"WITH {PLANTS} SELECT date, count(*) FILTER (capacity <= 40) AS n FROM plants GROUP BY 1")
def c14_plausible(spark, d):
    return g.drop_implausible(plant_reports(spark, d), "plants", "capacity", 40.0)[0].select("date", F.size("plants").cast("long").alias("n"))


@query(f"WITH {PLANTS} SELECT date, plant, capacity FROM plants WHERE capacity > 40")
def c14_ledger(spark, d):
    return g.drop_implausible(plant_reports(spark, d), "plants", "capacity", 40.0)[1].select("date", "item.plant", "item.capacity")


@query(f"""WITH {DAYS}, a AS (SELECT date, demand FROM days WHERE day(date) % 2 = 0), b AS (SELECT date, demand * 10 AS demand, shed FROM days WHERE day(date) % 3 = 0) SELECT date, coalesce(a.demand, b.demand) AS demand, shed FROM a FULL JOIN b USING (date)""")
def j10_filled(spark, d):
    day = line_days(spark, d)
    a = day.filter(F.dayofmonth("date") % 2 == 0).select("date", "demand")
    b = day.filter(F.dayofmonth("date") % 3 == 0).select("date", (F.col("demand") * 10).alias("demand"), "shed")
    return g.fill_by_priority([a, b], "date", ["demand", "shed"])


@query(f"""WITH {DAYS}, j AS (SELECT d.date, year(d.date) AS year, CASE WHEN day(d.date) % 3 = 0 THEN 0 ELSE d.shed END AS forecast, d.shed AS actual FROM days d)
SELECT year, count(*) AS days, count(*) FILTER (forecast <= 0) AS zero_forecasts, count(*) FILTER (forecast <= 0 AND actual > 0) AS missed, round(avg(actual) FILTER (forecast <= 0 AND actual > 0), 4) AS mean_missed,
  arg_max(date, (CASE WHEN forecast <= 0 AND actual > 0 THEN actual END, -(epoch(date::TIMESTAMP) // 86400))) FILTER (forecast <= 0 AND actual > 0) AS worst FROM j GROUP BY ROLLUP (year)""")
def a37_j9_forecast(spark, d):
    day = line_days(spark, d)
    return g.forecast_score(day.select("date", F.when(F.dayofmonth("date") % 3 == 0, 0.0).otherwise(F.col("shed")).alias("forecast")), day.select("date", F.col("shed").alias("actual")))


@query(f"WITH {HOURLY} SELECT count(*) AS n, count(*) FILTER (abs(demand - (supply + loadshed)) <= 0.005) AS agree, round(count(*) FILTER (abs(demand - (supply + loadshed)) <= 0.005) / count(*), 6) AS rate FROM hourly WHERE demand IS NOT NULL AND loadshed IS NOT NULL")
def a43_identity_rate(spark, d):
    return g.identity_rate(hourly(spark, d), F.col("demand"), F.col("supply") + F.col("loadshed"), 0.005)


@query(f"""WITH {HOURLY}, r AS (SELECT strftime(datetime, '%Y-%m') AS month, (demand - supply) / loadshed AS f FROM hourly WHERE loadshed > 0 AND demand IS NOT NULL AND supply IS NOT NULL), m AS (SELECT median(f) AS m FROM r)
SELECT month, count(*) AS n, round(median(f), 6) AS median, round(count(*) FILTER (abs(f - m) <= 0.002) / count(*), 6) AS near FROM r, m GROUP BY ROLLUP (month) HAVING month IS NULL OR count(*) >= 24""")
def a42_identity_factor(spark, d):
    return g.identity_factor(hourly(spark, d))


@query(f"WITH {DAYS}, j AS (SELECT date, CASE WHEN day(date) % 4 = 0 THEN 0 ELSE shed END AS a, shed AS b FROM days) SELECT count(*) AS n, count(*) FILTER (a = 0 AND b > 0) AS hidden, round(coalesce(sum(b) FILTER (a = 0 AND b > 0), 0), 2) AS hidden_sum FROM j")
def a44_j8_hidden_zero(spark, d):
    day = line_days(spark, d)
    other = day.select("date", F.when(F.dayofmonth("date") % 4 == 0, 0.0).otherwise(F.col("shed")).alias("a"))
    return g.zero_against(day.withColumnRenamed("shed", "b").join(other, "date"), "a", "b")


@query(f"WITH {HOURLY} SELECT year(date) AS year, count(*) AS n, count(demand) AS demand_present, count(*) FILTER (demand <> 0) AS demand_nonzero, count(loadshed) AS loadshed_present, count(*) FILTER (loadshed <> 0) AS loadshed_nonzero FROM hourly GROUP BY 1")
def a45_completeness(spark, d):
    return g.completeness(hourly(spark, d), ["demand", "loadshed"])


@query(f"""WITH {DAYS}, r AS (SELECT year(date) AS year, demand, row_number() OVER (PARTITION BY year(date) ORDER BY demand) - 1 AS k, count(*) OVER (PARTITION BY year(date)) AS n FROM days WHERE demand > 0),
y AS (SELECT year, max(n) AS days, max(demand) FILTER (k = floor(n / 2)) AS median, max(demand) FILTER (k = floor(0.95::DOUBLE * (n - 1))) AS p95, min(demand) AS least FROM r GROUP BY 1 HAVING max(n) >= 200),
z AS (SELECT *, first(median) OVER (ORDER BY year) AS m0, year - first(year) OVER (ORDER BY year) AS span FROM y)
SELECT year, days, median, p95, least, round((median / m0 - 1) * 100, 4) AS growth_pct, CASE WHEN span > 0 THEN round((power(median / m0, 1.0::DOUBLE / span) - 1) * 100, 4) END AS cagr_pct FROM z""")
def a46_annual_growth(spark, d):
    return g.annual_growth(line_days(spark, d), "demand")


@query(f"""WITH {DAYS}, r AS (SELECT * FROM days WHERE month(date) BETWEEN 4 AND 9), b AS (SELECT strftime(max(date), '%m%d') AS d FROM r), p AS (SELECT year(date) AS year, count(*) AS days, avg(demand) AS s, avg(shed) AS h FROM r, b WHERE strftime(date, '%m%d') <= d GROUP BY 1),
l AS (SELECT *, s - lag(s) OVER (ORDER BY year) AS ds, h - lag(h) OVER (ORDER BY year) AS dh FROM p) SELECT year, days, round(s, 4) AS served, round(h, 4) AS shed, round(dh / (ds + dh), 6) AS shed_share_of_rise FROM l""")
def a47_demand_split(spark, d):
    return g.demand_split(line_days(spark, d), "demand", "shed")


@query(f"""WITH {FUELS}, p AS (SELECT strftime(date, '%Y-%m') AS month, fuel, energy / stated_energy AS share, cost / energy AS price FROM fuels), m AS (SELECT month, fuel, avg(share) AS s, avg(price) AS p FROM p GROUP BY 1, 2)
SELECT count(*) AS groups, round(sum((a.s - b.s) * b.p), 6) AS mix, round(sum(a.s * (a.p - b.p)), 6) AS price, round(sum(a.s * a.p - b.s * b.p), 6) AS change FROM m a JOIN m b USING (fuel) WHERE a.month = '1998-03' AND b.month = '1997-03'""")
def a49_mix_price(spark, d):
    parts = fuel_days(spark, d).select(F.date_format("date", "yyyy-MM").alias("month"), F.col("fuel").alias("group"), (F.col("energy") / F.col("stated_energy")).alias("share"), (F.col("cost") / F.col("energy")).alias("price"))
    return g.mix_price(parts, "1998-03", "1997-03")


@query(f"WITH {FUELS} SELECT date, fuel, round(cost / energy, 6) AS unit_cost FROM fuels WHERE energy >= 1")
def a36_unit_costs(spark, d):
    slipped = F.when(F.dayofmonth("date") % 7 == 0, 1000.0).otherwise(1.0)
    return g.unit_costs(fuel_days(spark, d).withColumn("stated", F.col("stated_energy")).withColumn("energy", F.col("energy") * slipped))


@query(f"""WITH {FUELS}, b AS (SELECT *, sum(cost) OVER (PARTITION BY date) / sum(energy) OVER (PARTITION BY date) AS b FROM fuels), p AS (SELECT fuel, count(DISTINCT date) AS days, sum(cost) AS c, sum(energy) AS e FROM b WHERE abs(b - stated) <= 0.05 * stated GROUP BY 1 HAVING count(DISTINCT date) >= 60)
SELECT fuel, days, round(c / sum(c) OVER (), 6) AS cost_share, round(e / sum(e) OVER (), 6) AS energy_share FROM p""")
def a38_fuel_cost(spark, d):
    return g.blended_fuel_cost(fuel_days(spark, d))


COSTS = FUELS + """, costs AS (SELECT date, CASE WHEN day(date) = 3 THEN NULL ELSE sum(cost) END AS cost, sum(energy) AS energy, CASE WHEN day(date) % 4 = 0 THEN NULL ELSE max(stated) END AS stated FROM fuels GROUP BY date), good AS (SELECT *, coalesce(stated, round((cost / energy)::DECIMAL(38,6), 3)::DOUBLE) AS u FROM costs WHERE cost > 0 AND energy > 0)"""


def daily_costs(spark, d):
    day = F.dayofmonth("date")
    per = fuel_days(spark, d).groupBy("date").agg(F.sum("cost").alias("cost"), F.sum("energy").alias("energy"), F.max("stated").alias("stated"))
    return per.select("date", F.when(day != 3, F.col("cost")).alias("cost"), "energy", F.when(day % 4 != 0, F.col("stated")).alias("stated"))


@query(f"WITH {COSTS} SELECT strftime(date, '%Y-%m') AS month, count(*) AS days, round(avg(cost)::DECIMAL(38,6), 1)::DOUBLE AS cost, round(avg(u)::DECIMAL(38,6), 3)::DOUBLE AS unit_cost, min(date) AS first, max(date) AS last FROM good GROUP BY 1")
def a48_cost_monthly(spark, d):
    return g.cost_monthly(daily_costs(spark, d))


@query(f"WITH {COSTS} SELECT count(*) AS days, min(date) AS first, max(date) AS last, round(arg_max(cost, date)::DECIMAL(38,6), 1)::DOUBLE AS cost, round((arg_max(cost, date) / arg_max(energy, date))::DECIMAL(38,6), 3)::DOUBLE AS unit_cost FROM good")
def a48_cost_coverage(spark, d):
    return g.cost_coverage(daily_costs(spark, d))


@query(f"""WITH {ZONES}, a AS (SELECT *, dense_rank() OVER (ORDER BY date DESC) AS age FROM zones), w AS (SELECT * FROM a, (VALUES (30), (90), (365), (0)) v(w) WHERE w = 0 OR age <= w),
p AS (SELECT w AS "window", zone, sum(demand) AS d, sum(shed) AS s, any_value(population) AS population, count(DISTINCT date) AS days FROM w GROUP BY 1, 2)
SELECT "window", zone, days, round(s / d, 6) AS shed_rate, round(d / days / population, 6) AS per_head, round((s / sum(s) OVER (PARTITION BY "window")) / (d / sum(d) OVER (PARTITION BY "window")), 6) AS shed_over_demand, round(sum(s) OVER (PARTITION BY "window") / sum(d) OVER (PARTITION BY "window"), 6) AS national_rate FROM p""")
def a50_equity(spark, d):
    return g.equity(zone_days(spark, d), [30, 90, 365, None])


@query(f"WITH {HOURLY}, q AS (SELECT date FROM (SELECT date, row_number() OVER (ORDER BY date DESC) AS k FROM hourly GROUP BY date HAVING count(*) >= 15) WHERE k <= 10) SELECT hour AS slot, count(*) AS n, round(avg(demand), 4) AS demand, round(avg(loadshed), 4) AS loadshed FROM hourly SEMI JOIN q USING (date) GROUP BY 1")
def w7_slot_profile(spark, d):
    return g.slot_profile(hourly(spark, d).withColumnRenamed("hour", "slot"), ["demand", "loadshed"], 10, 15)


@query(f"""WITH {HOURLY}, p AS (SELECT hour AS slot, round(avg(demand), 4) AS demand, round(avg(loadshed), 4) AS loadshed FROM hourly WHERE date IN (SELECT date FROM (SELECT date, row_number() OVER (ORDER BY date DESC) AS k FROM hourly GROUP BY date HAVING count(*) >= 15) WHERE k <= 10) GROUP BY 1),
u AS (SELECT 'demand' AS value, round(max(demand) - min(demand), 4) AS swing, arg_max(slot, (demand, -slot)) AS peak_slot, arg_min(slot, (demand, slot)) AS trough_slot FROM p UNION ALL SELECT 'loadshed', round(max(loadshed) - min(loadshed), 4), arg_max(slot, (loadshed, -slot)), arg_min(slot, (loadshed, slot)) FROM p)
SELECT *, round(swing / sum(swing) OVER (), 6) AS share FROM u""")
def w9_profile_features(spark, d):
    profile = g.slot_profile(hourly(spark, d).withColumnRenamed("hour", "slot"), ["demand", "loadshed"], 10, 15)
    return g.profile_features(profile, ["demand", "loadshed"])


SHAPE = """half AS (SELECT hour(ts) AS slot, ts, CASE WHEN event_type = 'view' THEN value END AS gas, CASE WHEN event_type = 'click' THEN value END AS hfo, CASE WHEN event_type = 'purchase' THEN value ELSE 0 END AS hsd, CASE WHEN event_type = 'error' THEN value END AS shortage FROM events),
slots AS (SELECT slot, coalesce(round(avg(gas)::DECIMAL(38,6), 2)::DOUBLE, 0) AS gas, coalesce(round(avg(hfo)::DECIMAL(38,6), 2)::DOUBLE, 0) AS hfo, coalesce(round(avg(hsd)::DECIMAL(38,6), 2)::DOUBLE, 0) AS hsd, round(avg(shortage)::DECIMAL(38,6), 2)::DOUBLE AS mean, round(median(shortage)::DECIMAL(38,6), 2)::DOUBLE AS med FROM half GROUP BY 1),
s AS (SELECT *, gas + hfo + hsd AS whole, hfo + hsd AS oil FROM slots)"""


@query(f"""WITH {SHAPE} SELECT arg_max(slot, (whole, -slot)) AS peak_slot, arg_min(slot, (whole, slot)) AS trough_slot, arg_max(slot, (oil, -slot)) AS oil_peak_slot, round(max(oil)::DECIMAL(38,6), 1)::DOUBLE AS oil_peak, round((max(oil) - arg_min(oil, (whole, slot)))::DECIMAL(38,6), 1)::DOUBLE AS oil_swing,
round((100 * round((max(oil) - min(oil))::DECIMAL(38,6), 1)::DOUBLE / round((max(whole) - min(whole))::DECIMAL(38,6), 1)::DOUBLE)::DECIMAL(38,6), 1)::DOUBLE AS oil_share_of_swing, arg_max(slot, (med, -slot)) FILTER (med IS NOT NULL) AS shortage_slot, max(med) AS shortage, arg_max(slot, (mean, -slot)) FILTER (mean IS NOT NULL) AS shortage_mean_slot, max(mean) AS shortage_mean FROM s""")
def w9_shape_features(spark, d):
    kind, value = F.col("event_type"), F.col("value")
    half = table(spark, d, "events").select(F.hour("ts").alias("slot"), F.when(kind == "view", value).alias("gas"), F.when(kind == "click", value).alias("hfo"), F.when(kind == "purchase", value).otherwise(0.0).alias("hsd"), F.when(kind == "error", value).alias("shortage"))
    return g.shape_features(half, ["gas", "hfo", "hsd"], ["hfo", "hsd"], "shortage")


@query(f"WITH {HOURLY} SELECT date, round(sum(coalesce(loadshed, 0))::DECIMAL(38,6), 2)::DOUBLE AS shed, floor(sum(coalesce(loadshed, 0)) * 1000 / (560::DOUBLE / 365) + 1e-6)::BIGINT AS people FROM hourly GROUP BY 1")
def a75_people(spark, d):
    return g.people_equivalent(hourly(spark, d))


@query(f"""WITH {DAYS}, n AS (SELECT max(date) AS d FROM days), w AS (SELECT b AS back, (d - to_months(12 * b))::DATE AS hi FROM n, range(5) r(b)) SELECT back, count(*) AS days, round(avg(demand), 4) AS mean FROM w JOIN days ON date BETWEEN hi - 29 AND hi GROUP BY 1""")
def w10_like_for_like(spark, d):
    return g.like_for_like(line_days(spark, d), "demand")


@query(f"""WITH {DAYS}, h AS (SELECT make_date(y, 7, 4) AS holiday FROM (SELECT DISTINCT year(o_orderdate) AS y FROM orders)), r AS (SELECT holiday, date, demand, date - holiday AS gap FROM days JOIN h ON date BETWEEN holiday - 28 AND holiday + 3),
l AS (SELECT holiday, min(demand) AS low, arg_min(date, (demand, date)) AS low_date FROM r WHERE gap BETWEEN -1 AND 3 GROUP BY 1), b AS (SELECT holiday, demand, row_number() OVER (PARTITION BY holiday ORDER BY demand) - 1 AS k, count(*) OVER (PARTITION BY holiday) AS n FROM r WHERE gap BETWEEN -28 AND -8)
SELECT holiday, low_date, low, demand AS base, round(1 - low / demand, 6) AS dip FROM l JOIN b USING (holiday) WHERE k = floor(n / 2) AND n >= 8 AND 1 - low / demand >= 0.05""")
def w11_holiday_dips(spark, d):
    h = table(spark, d, "orders").select(F.make_date(F.year("o_orderdate"), F.lit(7), F.lit(4)).alias("holiday")).distinct()
    return g.holiday_dips(line_days(spark, d), h, "demand")


@query(f"""WITH {DAYS}, r AS (SELECT year(date) AS year, (dayofyear(date) - CASE WHEN (year(date) % 4 = 0 AND year(date) % 100 <> 0 OR year(date) % 400 = 0) AND dayofyear(date) > 59 THEN 1 ELSE 0 END)::INT AS doy, max(demand) AS value FROM days GROUP BY 1, 2),
s AS (SELECT year, unnest(range(1, max(doy) + 1))::INT AS doy FROM r GROUP BY 1) SELECT year, doy, value, round(avg(value) OVER (PARTITION BY year ORDER BY doy ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING), 4) AS mean FROM s LEFT JOIN r USING (year, doy)""")
def w1_seasonal_curve(spark, d):
    return g.seasonal_curve(line_days(spark, d), "demand")


@query(f"WITH {HOURLY} SELECT datetime, round(avg(coalesce(loadshed, 0)) OVER (ORDER BY datetime ROWS BETWEEN 36 PRECEDING AND 36 FOLLOWING) + 1e-9, 6) AS days, round(avg(coalesce(loadshed, 0)) OVER (ORDER BY datetime ROWS BETWEEN 84 PRECEDING AND 84 FOLLOWING) + 1e-9, 6) AS week FROM hourly")
def w2_rolling_mean(spark, d):
    out = st.centred_mean(hourly(spark, d), [], "datetime", "loadshed", 36, "days", True)
    out = st.centred_mean(out, [], "datetime", "loadshed", 84, "week", True)
    return out.select("datetime", *[F.round(F.col(c) + 1e-9, 6).alias(c) for c in ("days", "week")])


@query(f"""WITH {HOURLY}, r AS (SELECT *, row_number() OVER (PARTITION BY hour ORDER BY datetime DESC) AS k FROM hourly WHERE demand IS NOT NULL), t AS (SELECT *, row_number() OVER (PARTITION BY hour ORDER BY demand) - 1 AS i, count(*) OVER (PARTITION BY hour) AS n FROM r WHERE k <= 20)
SELECT hour, max(n) AS n, max(demand) FILTER (k = 1) AS latest, max(demand) FILTER (i = floor(0.25::DOUBLE * (n - 1))) AS q1, max(demand) FILTER (i = floor(0.5::DOUBLE * (n - 1))) AS q2, max(demand) FILTER (i = floor(0.75::DOUBLE * (n - 1))) AS q3 FROM t GROUP BY 1""")
def a75_same_hour(spark, d):
    return g.same_hour_context(hourly(spark, d), "demand", 20)


@query(f"WITH {FUELS}, r AS (SELECT fuel, cost / energy AS u, row_number() OVER (PARTITION BY fuel ORDER BY date DESC) AS k FROM fuels) SELECT fuel, count(*) AS n, round(avg(u), 4) AS mean FROM r WHERE k <= 30 GROUP BY 1")
def a76_recent_cost(spark, d):
    return g.recent_mean(fuel_days(spark, d).withColumn("u", F.col("cost") / F.col("energy")), "fuel", "u")


@query(f"""WITH {DAYS}, m AS (SELECT strftime(date, '%Y-%m') AS month, round(sum(shed), 2) AS total, max(shed) AS peak FROM days GROUP BY 1)
SELECT *, total <> peak AS differ FROM (SELECT arg_max(month, (total, -replace(month, '-', '')::INT)) AS total, arg_max(month, (peak, -replace(month, '-', '')::INT)) AS peak FROM m)""")
def a77_metric_disagreement(spark, d):
    m = line_days(spark, d).groupBy(F.date_format("date", "yyyy-MM").alias("month")).agg(F.round(F.sum("shed"), 2).alias("total"), F.max("shed").alias("peak"))
    return g.metric_disagreement(m, ["total", "peak"])


@query(f"""WITH {HOURLY}, {ZONES}, l AS (SELECT * FROM hourly WHERE datetime = (SELECT max(datetime) FROM hourly))
SELECT datetime, demand, loadshed, (SELECT max(loadshed) FROM hourly WHERE date = l.date) AS today, (SELECT max(loadshed) FROM hourly WHERE date = l.date - 1) AS yesterday, (SELECT arg_max(zone, (shed, zone)) FROM zones WHERE date = (SELECT max(date) FROM zones)) AS worst_zone FROM l""")
def a78_latest(spark, d):
    return g.latest_block(hourly(spark, d), zone_days(spark, d))


@query(f"WITH {HOURLY}, {ZONES} SELECT 'hourly' AS source, min(date) AS first, max(date) AS last, count(DISTINCT date) AS days FROM hourly UNION ALL SELECT 'zones', min(date), max(date), count(DISTINCT date) FROM zones")
def a79_freshness(spark, d):
    return g.freshness({"hourly": hourly(spark, d), "zones": zone_days(spark, d)})


@query(f"WITH {HOURLY} SELECT hour, CASE WHEN count(*) FILTER (demand IS NOT NULL AND loadshed IS NOT NULL) >= 10 THEN round(covar_pop(demand, loadshed) / (stddev_pop(demand) FILTER (loadshed IS NOT NULL) * stddev_pop(loadshed) FILTER (demand IS NOT NULL)), 6) END AS r FROM hourly GROUP BY 1")
def a41_pearson(spark, d):
    return hourly(spark, d).groupBy("hour").agg(F.round(st.pearson(F.col("demand"), F.col("loadshed")), 6).alias("r"))


@query(f"WITH {DAYS} SELECT strftime(date, '%Y-%m') AS month, count(*) AS n, round(median(demand)::DECIMAL(38,6), 4)::DOUBLE AS demand, round(median(shed)::DECIMAL(38,6), 4)::DOUBLE AS shed FROM days GROUP BY 1 HAVING count(*) >= 5")
def a39_monthly_medians(spark, d):
    day = line_days(spark, d).withColumn("month", F.date_format("date", "yyyy-MM"))
    return st.medians(day, ["month"], ["demand", "shed"], small=True).filter("n >= 5")


@query(f"""WITH {DAYS}, h AS (SELECT * FROM days WHERE month(date) BETWEEN 4 AND 9), s AS (SELECT *, row_number() OVER (ORDER BY demand) - 1 AS k, count(*) OVER () AS n FROM h), c AS (SELECT max(demand) FILTER (k = n // 3) AS lo, max(demand) FILTER (k = 2 * n // 3) AS hi FROM s)
SELECT CASE WHEN demand <= lo THEN 'low' WHEN demand >= hi THEN 'high' ELSE 'middle' END AS band, count(*) AS n, round(median(demand)::DECIMAL(38,6), 4)::DOUBLE AS demand, round(median(shed)::DECIMAL(38,6), 4)::DOUBLE AS shed FROM h, c GROUP BY 1""")
def a40_hot_months(spark, d):
    return st.band_medians(line_days(spark, d), "demand", ["shed"], months=range(4, 10))


@query(f"""WITH {DAYS}, s AS (SELECT *, row_number() OVER (ORDER BY demand) - 1 AS k, count(*) OVER () AS n FROM days), c AS (SELECT max(demand) FILTER (k = n // 3) AS lo, max(demand) FILTER (k = 2 * n // 3) AS hi FROM s)
SELECT CASE WHEN demand <= lo THEN 'low' WHEN demand >= hi THEN 'high' ELSE 'middle' END AS band, count(*) AS n, round(median(shed)::DECIMAL(38,6), 4)::DOUBLE AS shed FROM days, c GROUP BY 1""")
def a40_tercile_bands(spark, d):
    return st.medians(st.tercile_bands(line_days(spark, d), "demand"), ["band"], ["shed"])


@query(f"WITH {DAYS}, q AS (SELECT quantile_cont(demand, 0.25) AS a, quantile_cont(demand, 0.5) AS b, quantile_cont(demand, 0.75) AS c FROM days) SELECT ((demand > a)::INT + (demand > b)::INT + (demand > c)::INT)::INT AS bin, count(*) AS n FROM days, q GROUP BY 1")
def w12_quantile_bins(spark, d):
    return st.quantile_bins(line_days(spark, d), "demand", 4).groupBy("bin").agg(F.count("*").alias("n"))


@query("""WITH p AS (SELECT l_discount AS v, count(*) AS n FROM lineitem WHERE l_discount > 0 GROUP BY 1), b AS (SELECT v, (1 + floor(coalesce(sum(n) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * 4 / sum(n) OVER ()))::INT AS bin FROM p)
SELECT coalesce(bin, 0) AS bin, count(*) AS n FROM lineitem LEFT JOIN b ON v = l_discount GROUP BY 1""")
def w13_rank_bins(spark, d):
    return st.rank_bins(table(spark, d, "lineitem").select("l_discount"), "l_discount", 5).groupBy("bin").agg(F.count("*").alias("n"))


@query(f"WITH {DAYS}, l AS (SELECT date, demand, dense_rank() OVER (ORDER BY date DESC) AS k FROM days) SELECT date, demand FROM l WHERE k <= 30")
def w3_trailing(spark, d):
    return sets.trailing(line_days(spark, d), "date", 30).select("date", "demand")


@query(f"WITH {ZONES} SELECT zone, round(sum(shed), 2) AS shed, rank() OVER (ORDER BY round(sum(shed), 2) DESC) AS place, round(round(sum(shed), 2) / sum(round(sum(shed), 2)) OVER (), 6) AS share, round(sum(shed), 2) - lag(round(sum(shed), 2)) OVER (ORDER BY zone) AS step FROM zones GROUP BY 1")
def w4_w5_w6_ranks(spark, d):
    z = zone_days(spark, d).groupBy("zone").agg(F.round(F.sum("shed"), 2).alias("shed"))
    return sets.ranked(z, "zone", "shed")


@query(f"""WITH {DAYS}, n AS (SELECT max(date) AS d FROM days), w AS (SELECT b AS back, (d - to_months(12 * b))::DATE AS hi FROM n, range(1, 3) r(b)) SELECT back, count(*) AS days, round(avg(shed), 4) AS mean FROM w JOIN days ON date BETWEEN hi - 29 AND hi GROUP BY 1 HAVING count(*) >= 7""")
def w8_earlier_years(spark, d):
    return g.like_for_like(line_days(spark, d), "shed", back=(1, 2), least=7)


@query(f"WITH {DAYS} SELECT CASE WHEN date < DATE '1998-01-01' THEN day(date) % 4 <> 0 ELSE true END AS reported, count(*) AS n FROM days GROUP BY 1")
def c32_reported(spark, d):
    zeros = line_days(spark, d).withColumn("shed", F.when(F.dayofmonth("date") % 4 == 0, 0.0).otherwise(1.0))
    return g.reported(zeros, "shed", "1998-01-01").groupBy("reported").agg(F.count("*").alias("n"))
