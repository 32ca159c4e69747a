"""Quality, matching, crime and migration queries on the stand-in tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordscope.functions import dates as dt
from recordscope.operators import match as mt
from recordscope.operators import quality as ql
from recordscope.operators import regions as rg
from recordscope.operators import sets
from recordscope.operators import stats as st
from recordscope.plans.base import DAYS, line_days, query, table

PRIORITIES = "['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW']"


def facts(spark, d):
    """Orders as daily migration facts: date, district, country, gender, n."""
    c = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    o = table(spark, d, "orders").join(c, F.col("o_custkey") == F.col("c_custkey"))
    return o.groupBy(
        F.to_date("o_orderdate").alias("date"), F.when(F.col("c_custkey") % 50 != 0, F.col("n_name")).alias("district"), F.col("c_mktsegment").alias("country"), F.col("o_orderstatus").alias("gender"), F.col("n_regionkey").alias("division")
    ).agg(F.count("*").alias("n"))


FACTS = """facts AS (SELECT o_orderdate::DATE AS date, CASE WHEN c_custkey % 50 <> 0 THEN n_name END AS district, c_mktsegment AS country, o_orderstatus AS gender, n_regionkey AS division, count(*) AS n
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY ALL)"""
CUBE = FACTS + """, cube AS (SELECT strftime(date, '%Y-%m') AS month, district, CASE country WHEN 'MACHINERY' THEN 'AUTOMOBILE' ELSE country END AS country, gender, sum(n)::BIGINT AS n
  FROM facts WHERE district IS NOT NULL AND date NOT IN (DATE '1996-01-01') GROUP BY ALL)"""


def fact_cube(spark, d):
    alias = table(spark, d, "customer").filter("c_mktsegment = 'MACHINERY'").select(F.col("c_mktsegment").alias("alias"), F.lit("AUTOMOBILE").alias("canonical")).distinct()
    return rg.cube(facts(spark, d), alias, ["1996-01-01"])


@query(f"WITH {CUBE} SELECT * FROM cube")
def a63_cube(spark, d):
    return fact_cube(spark, d)


@query(f"WITH {CUBE}, s AS (SELECT month, district, country, sum(n) FILTER (gender = 'F')::BIGINT AS n FROM cube GROUP BY ALL) SELECT month, district, country, n FROM s WHERE n > 0")
def a64_derived_slice(spark, d):
    c = fact_cube(spark, d)
    key = ["month", "district", "country"]
    whole = c.groupBy(*key).agg(F.sum("n").alias("n"))
    return ql.derive_slice(whole, c.filter("gender <> 'F'").groupBy(*key).agg(F.sum("n").alias("n")), key, "n")


@query(f"""WITH {CUBE} SELECT 'district' AS grain, district AS name, sum(n)::BIGINT AS n FROM cube WHERE country = 'BUILDING' AND month BETWEEN '1997-01' AND '1998-06' GROUP BY 2
UNION ALL SELECT 'country', country, sum(n)::BIGINT FROM cube WHERE district = 'NATION_3' AND month BETWEEN '1997-01' AND '1998-06' GROUP BY 2
UNION ALL SELECT 'month', month, sum(n)::BIGINT FROM cube WHERE district = 'NATION_3' AND country = 'BUILDING' GROUP BY 2""")
def a70_corridor(spark, d):
    return rg.corridor(fact_cube(spark, d), "NATION_3", "BUILDING", "1997-01", "1998-06")


@query(f"WITH {CUBE}, p AS (SELECT n_name AS district, count(*) AS population FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1) SELECT district, round(t.n / population * 100000, 4) AS rate FROM (SELECT district, sum(n) AS n FROM cube GROUP BY 1) t JOIN p USING (district) WHERE population >= 10 ORDER BY rate DESC, district LIMIT 14")
def a71_per_capita(spark, d):
    p = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("n_nationkey") == F.col("c_nationkey")).groupBy(F.col("n_name").alias("district")).agg(F.count("*").alias("population"))
    return rg.per_capita(fact_cube(spark, d).groupBy("district").agg(F.sum("n").alias("n")), p, "district", "n", 100000.0, 14, 10)


@query(f"""WITH {FACTS}, m AS (SELECT district, year(date) AS year, month(date) AS month, sum(n) AS value FROM facts WHERE district IS NOT NULL GROUP BY ALL), t AS (SELECT district, year, sum(value)::BIGINT AS total, count(*) AS k FROM m GROUP BY 1, 2)
SELECT district, year, total, CASE WHEN year % 2 = 0 THEN 'stated' ELSE 'months' END AS source FROM t WHERE year % 2 = 0 OR k = 12""")
def a72_annual(spark, d):
    m = facts(spark, d).filter("district is not null").groupBy("district", F.year("date").alias("year"), F.month("date").alias("month")).agg(F.sum("n").alias("value"))
    stated = m.filter("year % 2 = 0").groupBy("district", "year").agg(F.sum("value").alias("total"))
    return rg.annual_from_months(m, stated, ["district", "year"])


@query(f"WITH {FACTS}, s AS (SELECT country, sum(n)::BIGINT AS total FROM facts WHERE gender = 'P' AND country <> 'MACHINERY' GROUP BY 1) SELECT c_mktsegment AS country, coalesce(total, 0) AS total, coalesce(total > 0, false) AS has_data FROM (SELECT DISTINCT c_mktsegment FROM customer) LEFT JOIN s ON country = c_mktsegment")
def a73_country_rollup(spark, d):
    spans = facts(spark, d).filter("gender = 'P' and country <> 'MACHINERY'").withColumnRenamed("n", "total")
    return rg.country_rollup(spans, table(spark, d, "customer").select(F.col("c_mktsegment").alias("country")).distinct())


@query("SELECT p_partkey, (p_size + coalesce(CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_size * 2 END, 0))::BIGINT AS working_age FROM part")
def a74_working_age(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.col("p_size").cast("long").alias("a"), F.when(F.col("p_size") % 3 != 0, F.col("p_size").cast("long") * 2).alias("b"))
    return rg.working_age(p, ["a", "b"]).select("p_partkey", "working_age")


@query(f"""WITH {FACTS}, p AS (SELECT date, sum(n) AS parts FROM facts WHERE district IS NOT NULL GROUP BY 1), c AS (SELECT date, sum(n) AS control FROM facts GROUP BY 1)
SELECT date, parts, control, coalesce(control, 0) - coalesce(parts, 0) AS residual, coalesce(control, 0) - coalesce(parts, 0) < 0 OR coalesce(control, 0) - coalesce(parts, 0) > 0.02 * coalesce(control, 0) AS bad FROM p FULL JOIN c USING (date)""")
def a65_reconciled(spark, d):
    f = facts(spark, d)
    return ql.reconcile(f.filter("district is not null"), f, ["date"], "n")


@query(f"""WITH {FACTS}, m AS (SELECT strftime(date, '%Y-%m') AS month, sum(n)::BIGINT AS days FROM facts GROUP BY 1) SELECT month, days, days + 3 AS stated, -3::BIGINT AS diff FROM m WHERE substr(month, 6, 2) = '05' AND month <> '1997-05'""")
def a66_month_check(spark, d):
    f = facts(spark, d)
    stated = f.groupBy(F.date_format("date", "yyyy-MM").alias("month")).agg(F.sum("n").alias("s")).select("month", (F.col("s") + F.when(F.substring("month", 6, 2) == "05", 3).otherwise(0)).alias("stated"))
    return ql.crosscheck_months(f, stated, "n", ["1997-05"])


@query(f"WITH {FACTS} SELECT gender, coalesce(sum(n) FILTER (district IS NOT NULL), 0)::BIGINT AS have, sum(n)::BIGINT AS want, round(coalesce(sum(n) FILTER (district IS NOT NULL), 0) / sum(n), 6) AS share FROM facts GROUP BY 1")
def a67_slice_completeness(spark, d):
    f = facts(spark, d)
    return rg.completeness_by_slice(f.filter("district is not null"), f, "gender", "n")


def classified(spark, d):
    f = facts(spark, d)
    known = table(spark, d, "nation").select(F.col("n_name").alias("district"), F.col("n_regionkey").alias("division"))
    odd = f.withColumn("division", F.when(F.dayofmonth("date") == 7, (F.col("division") + 1) % 5).otherwise(F.col("division"))).withColumn("district", F.when(F.dayofmonth("date") == 9, F.lit("NOWHERE")).otherwise(F.col("district")))
    return ql.classify_pairs(odd, known)


@query(f"""WITH {FACTS}, c AS (SELECT n, CASE WHEN day(date) = 9 THEN 'invalid' WHEN district IS NULL THEN 'unknown' WHEN day(date) = 7 THEN 'wrong_division' ELSE 'valid' END AS class FROM facts)
SELECT class, count(*) AS rows, sum(n)::BIGINT AS total, round(sum(n) * 100 / sum(sum(n)) OVER (), 4) AS percent FROM c GROUP BY 1""")
def c23_a68_classes(spark, d):
    return ql.class_summary(classified(spark, d), "n")


@query(f"WITH {CUBE} SELECT district, sum(n) FILTER (country = 'AUTOMOBILE')::BIGINT AS \"AUTOMOBILE\", sum(n) FILTER (country = 'BUILDING')::BIGINT AS \"BUILDING\" FROM cube GROUP BY 1")
def a69_pivot(spark, d):
    return fact_cube(spark, d).groupBy("district").pivot("country", ["AUTOMOBILE", "BUILDING"]).agg(F.sum("n"))


@query(f"""WITH {FACTS}, r AS (SELECT strftime(date, '%Y-%m') AS month, division::VARCHAR AS division, district, country, sum(n)::BIGINT AS n FROM facts WHERE district IS NOT NULL GROUP BY ALL)
SELECT 'month' AS grain, month, division, district, country, n FROM r UNION ALL SELECT * FROM (SELECT 'top_country', NULL, NULL, NULL, country, sum(n)::BIGINT AS n FROM r GROUP BY country ORDER BY n DESC, country LIMIT 10)
UNION ALL SELECT * FROM (SELECT 'top_district', NULL, NULL, district, NULL, sum(n)::BIGINT AS n FROM r GROUP BY district ORDER BY n DESC, district LIMIT 10)""")
def a69_exports(spark, d):
    return rg.exports(facts(spark, d).filter("district is not null"))


@query("""SELECT CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'MACHINERY') THEN 'Vehicles' ELSE c_mktsegment END AS country, count(*) AS n FROM customer GROUP BY 1""")
def c18_canonical(spark, d):
    c = table(spark, d, "customer")
    alias = c.filter("c_mktsegment in ('AUTOMOBILE', 'MACHINERY')").select(F.lower("c_mktsegment").alias("alias"), F.lit("Vehicles").alias("canonical")).distinct()
    return ql.canonical(c.withColumn("country", F.concat("c_mktsegment", F.lit(" "))), "country", alias).groupBy(F.trim("country").alias("country")).agg(F.count("*").alias("n"))


@query("SELECT c_nationkey, count(*) AS rows, round(sum(c_acctbal), 2) AS total FROM customer WHERE c_nationkey % 6 = 0 GROUP BY 1 HAVING round(sum(c_acctbal), 2) > 500")
def j18_unmatched(spark, d):
    ref = table(spark, d, "nation").filter("n_nationkey % 6 <> 0").select(F.col("n_nationkey").alias("c_nationkey"))
    return ql.unmatched(table(spark, d, "customer"), ref, ["c_nationkey"], "c_acctbal", 500.0)


@query("SELECT o_orderdate::DATE::VARCHAR AS date, c_mktsegment AS country, count(*) AS rows FROM orders JOIN customer ON c_custkey = o_custkey WHERE day(o_orderdate) = 11 GROUP BY 1, 2")
def j19_log_gap(spark, d):
    f = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(F.to_date("o_orderdate").alias("date"), F.col("c_mktsegment").alias("country"))
    log = f.groupBy(F.concat_ws("|", F.col("date").cast("string"), "country").alias("key")).agg(F.count("*").alias("rows"))
    return ql.log_gap(log, f.filter(F.dayofmonth("date") != 11), F.col("key"), ["date", "country"])


@query("SELECT date_trunc('month', l_shipdate)::DATE AS date_from, last_day(l_shipdate) AS date_to, count(*) AS n FROM lineitem WHERE l_linenumber <> 2 GROUP BY 1, 2")
def j20_month_spans(spark, d):
    l = table(spark, d, "lineitem").withColumn("date_from", F.to_date(F.trunc("l_shipdate", "month")))  # noqa: E741
    l = l.withColumn("date_to", F.when(F.col("l_linenumber") == 2, F.date_add("date_from", 20)).otherwise(F.last_day("l_shipdate")))  # noqa: E741
    return ql.month_spans(l).groupBy("date_from", "date_to").agg(F.count("*").alias("n"))


def compiled(spark, d):
    o = table(spark, d, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month"), "o_orderstatus")
    return o.agg(F.count("*").alias("n"))


@query("SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderstatus, count(*) * CASE WHEN month(o_orderdate) = 3 THEN 10 ELSE 1 END AS n FROM orders WHERE month(o_orderdate) <> 3 OR o_orderstatus <> 'P' GROUP BY month(o_orderdate), 1, 2")
def c11_j11_override(spark, d):
    base = compiled(spark, d)
    better = base.filter("month like '%-03' and o_orderstatus <> 'P'").withColumn("n", F.col("n") * 10)
    return ql.override(base, better, ["month"])


@query("""WITH b AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderstatus, count(*) AS n, sum(o_custkey)::BIGINT AS s FROM orders GROUP BY 1, 2)
SELECT month, count(*) AS rows, sum(CASE WHEN o_orderstatus = 'P' THEN 2 WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END)::BIGINT AS differing FROM b WHERE month LIKE '%-03' GROUP BY 1""")
def c11_superseded(spark, d):
    base = table(spark, d, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month"), "o_orderstatus").agg(F.count("*").alias("n"), F.sum("o_custkey").alias("s"))
    better = base.filter("month like '%-03' and o_orderstatus <> 'P'").withColumn("n", F.when(F.col("o_orderstatus") == "F", F.col("n") + 1).otherwise(F.col("n")))
    return ql.superseded(base, better, ["month"], ["n", "s"])


@query("SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderstatus, CASE WHEN month(o_orderdate) = 4 AND o_orderstatus = 'F' THEN -1 ELSE count(*) END AS n, month(o_orderdate) = 4 AND o_orderstatus = 'F' AS fixed FROM orders GROUP BY month(o_orderdate), 1, 2")
def c11_fixes(spark, d):
    base = compiled(spark, d)
    fixes = base.filter("month like '%-04' and o_orderstatus = 'F'").withColumn("n", F.lit(-1).cast("long"))
    return ql.apply_fixes(base, fixes, ["month", "o_orderstatus"], "n")


SHEETS = f"""cells AS (SELECT o_orderpriority AS sheet, coalesce(c_nationkey % 5, 5)::INT AS "row", coalesce(CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END, 3)::INT AS col, count(*) AS value
  FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY GROUPING SETS ((o_orderpriority, c_nationkey % 5, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END), (o_orderpriority, c_nationkey % 5), (o_orderpriority, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END), (o_orderpriority)))"""


def sheets(spark, d):
    """Order counts by nation group and status, with total rows and columns, one sheet a priority."""
    o = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    o = o.select(F.col("o_orderpriority").alias("sheet"), (F.col("c_nationkey") % 5).alias("r"), F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2).alias("c"))
    sets = [[F.col(x) for x in s] for s in (("sheet", "r", "c"), ("sheet", "r"), ("sheet", "c"), ("sheet",))]
    return o.groupingSets(sets, "sheet", "r", "c").agg(F.count("*").alias("value")).select("sheet", F.coalesce("r", F.lit(5)).alias("row"), F.coalesce("c", F.lit(3)).alias("col"), "value")


def sheet_rules(spark):
    """A total for each row of the first three columns, and for each column of the first five rows."""
    rows = [(f"row{r}", "total" if c == 3 else "member", r, c) for r in range(6) for c in range(4)] + [(f"col{c}", "total" if r == 5 else "member", r, c) for c in range(4) for r in range(6)]
    return spark.createDataFrame(rows, "constraint string, role string, row int, col int")


@query(f"""WITH {SHEETS}, b AS (SELECT * REPLACE (value + CASE WHEN sheet = '1-URGENT' AND "row" = 2 AND col = 1 THEN 7 ELSE 0 END AS value) FROM cells)
SELECT sheet, 'row2' AS "constraint", (sum(value) FILTER (col < 3))::BIGINT AS members, max(value) FILTER (col = 3) AS total, 7::BIGINT AS delta FROM b WHERE sheet = '1-URGENT' AND "row" = 2 GROUP BY 1
UNION ALL SELECT sheet, 'col1', (sum(value) FILTER ("row" < 5))::BIGINT, max(value) FILTER ("row" = 5), 7 FROM b WHERE sheet = '1-URGENT' AND col = 1 GROUP BY 1""")
def a53_checksums(spark, d):
    bad = (F.col("sheet") == "1-URGENT") & (F.col("row") == 2) & (F.col("col") == 1)
    return ql.checksum_audit(sheets(spark, d).withColumn("value", F.col("value") + F.when(bad, 7).otherwise(0)), sheet_rules(spark))


#: One complete sheet for each priority and month; ``m`` is the month's number.
MONTH_SHEETS = """o AS (SELECT o_orderpriority || '/' || strftime(o_orderdate, '%Y-%m') AS sheet, month(o_orderdate)::INT AS m, (c_nationkey % 5)::INT AS r, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS c FROM orders JOIN customer ON c_custkey = o_custkey),
cells AS (SELECT sheet, m, x.r::INT AS "row", y.c::INT AS col, count(*) FILTER ((o.r = x.r OR x.r = 5) AND (o.c = y.c OR y.c = 3)) AS value FROM o, range(6) x(r), range(4) y(c) GROUP BY ALL)"""
#: A chain of holes, each of which is determined once the one before it is known.
CHAIN = [(0, 0), (0, 1), (1, 1), (1, 2), (2, 2), (2, 3), (3, 3)]
IN_CHAIN = "(" + " OR ".join(f'"row" = {r} AND col = {c}' for r, c in CHAIN) + ")"
#: Holes that no constraint determines.
IN_SQUARE = """("row" IN (1, 3) AND col IN (0, 2))"""


def month_sheets(spark, d):
    """(sheet, m, row, col, value): order counts by nation group and status with their totals, complete."""
    o = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    r, c = F.col("c_nationkey") % 5, F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    o = o.select(F.concat_ws("/", "o_orderpriority", F.date_format("o_orderdate", "yyyy-MM")).alias("sheet"), F.month("o_orderdate").alias("m"), r.alias("r"), c.alias("c"))
    grid = [(i, j) for i in range(6) for j in range(4)]
    counts = [F.count_if((F.lit(i == 5) | (F.col("r") == i)) & (F.lit(j == 3) | (F.col("c") == j))).alias(f"n{i}_{j}") for i, j in grid]
    cells = F.array(*[F.struct(F.lit(i).alias("row"), F.lit(j).alias("col"), F.col(f"n{i}_{j}").alias("value")) for i, j in grid])
    return o.groupBy("sheet", "m").agg(*counts).select("sheet", "m", F.inline(cells))


@query(f"""WITH {MONTH_SHEETS} SELECT sheet, "row", col, CASE WHEN m % 3 <> 2 OR NOT {IN_SQUARE} THEN value END AS value, m % 3 = 1 AND {IN_CHAIN} AS deduced FROM cells""")
def a54_deduced(spark, d):
    gone = (F.col("m") % 3 == 1) & F.expr(IN_CHAIN.replace('"', "")) | (F.col("m") % 3 == 2) & F.expr(IN_SQUARE.replace('"', ""))
    cells = month_sheets(spark, d).withColumn("value", F.when(~gone, F.col("value")))
    # holes of both kinds: null, and not there at all
    return ql.deduce_missing(cells.filter("value is not null or row > 0").drop("m"), sheet_rules(spark))


#: By the month's number: 0 a doubtful misread, 1 two in one row, 2 a hole beside it, 3 a misread that was read as sure, 4 a hole alone, which leaves nothing to change.
MISREAD = """CASE WHEN m % 5 < 4 AND "row" = 2 AND col = 1 THEN 7 WHEN m % 5 = 1 AND "row" = 2 AND col = 0 THEN 2 ELSE 0 END"""
MISSED = """(m % 5 = 2 AND "row" = 4 AND col = 2 OR m % 5 = 4 AND "row" = 2 AND col = 1)"""
UNSURE = """("row" = 2 AND col < 2 AND m % 5 <> 3)"""


def misread_sheets(spark, d):
    """``month_sheets`` with holes and misread cells, and ``sure``."""
    sql = lambda text: F.expr(text.replace('"', ""))
    cells = month_sheets(spark, d).withColumn("read", F.when(~sql(MISSED), F.col("value") + sql(MISREAD)))
    return cells.select("sheet", "row", "col", F.col("read").alias("value"), (~sql(UNSURE)).alias("sure"))


@query(f"""WITH {MONTH_SHEETS}, b AS (SELECT *, CASE WHEN NOT {MISSED} THEN value + {MISREAD} END AS read FROM cells)
SELECT sheet, "row", col, read AS before, value AS after FROM b WHERE read IS DISTINCT FROM value AND m % 5 <> 3""")
def a55_repaired(spark, d):
    return ql.repair_sheets(misread_sheets(spark, d), sheet_rules(spark))


MONTHS = "m AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderpriority AS unit, count(*) FILTER (o_orderstatus = 'F') AS f, count(*) FILTER (o_orderstatus = 'O') AS o FROM orders GROUP BY 1, 2)"


def month_units(spark, d):
    o = table(spark, d, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.col("o_orderpriority").alias("unit"))
    return o.agg(F.count_if(F.col("o_orderstatus") == "F").alias("f"), F.count_if(F.col("o_orderstatus") == "O").alias("o"))


@query(f"WITH {MONTHS} SELECT month, 'o' AS \"column\", sum(o)::DOUBLE AS computed, sum(o)::DOUBLE + 2 AS printed, -2.0::DOUBLE AS delta FROM m WHERE month LIKE '%-08' GROUP BY 1")
def a56_total_row(spark, d):
    m = month_units(spark, d)
    printed = m.groupBy("month").agg(F.sum("f").alias("f"), (F.sum("o") + F.when(F.col("month").like("%-08"), 2).otherwise(0)).alias("o"))
    return ql.total_row_audit(m, printed, "month", ["f", "o"])


@query(f"""WITH {MONTHS}, x AS (SELECT month, unit, unnest(['f', 'o']) AS c, unnest([CASE WHEN month LIKE '%-02' THEN f / 50.0::DOUBLE ELSE f END, o::DOUBLE]) AS v FROM m), s AS (SELECT *, v / nullif(sum(v) OVER (PARTITION BY month, unit), 0) AS share FROM x),
r AS (SELECT *, row_number() OVER (PARTITION BY unit, c ORDER BY share) - 1 AS k, count(*) OVER (PARTITION BY unit, c) AS n FROM s WHERE share IS NOT NULL), u AS (SELECT unit, c, share AS usual FROM r WHERE k = floor(n / 2))
SELECT month, unit, c AS "column", round(share, 6) AS share, round(usual, 6) AS usual FROM r JOIN u USING (unit, c) WHERE usual >= 0.01 AND (share > 6 * usual OR share < usual / 6)""")
def a51_anomalies(spark, d):
    m = month_units(spark, d).withColumn("f", F.when(F.col("month").like("%-02"), F.col("f") / 50.0).otherwise(F.col("f")))
    return ql.profile_anomalies(m, "month", "unit", ["f", "o"])


@query(f"WITH {MONTHS}, k AS (SELECT DISTINCT month FROM m), u AS (SELECT DISTINCT unit FROM m) SELECT k.month, u.unit, c AS \"column\" FROM k, u, (VALUES ('f'), ('o')) v(c) WHERE (c = 'o' AND u.unit = '5-LOW' AND k.month LIKE '%-01') OR NOT EXISTS (SELECT 1 FROM m WHERE m.month = k.month AND m.unit = u.unit)")
def a52_holes(spark, d):
    m = month_units(spark, d)
    holey = m.withColumn("o", F.when(~((F.col("unit") == "5-LOW") & F.col("month").like("%-01")), F.col("o")))
    return ql.holes(holey, m.select("month").distinct(), m.select("unit").distinct(), ["f", "o"], ("month", "unit"))


def cases(spark, d):
    return table(spark, d, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.col("o_orderpriority").alias("unit"), F.col("o_orderstatus").alias("category")).agg(F.count("*").alias("n"))


CASES = "cases AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderpriority AS unit, o_orderstatus AS category, count(*) AS n FROM orders GROUP BY ALL)"


@query(f"WITH {CASES} SELECT unit, CASE WHEN category IN ('F', 'O') THEN 'closed' ELSE category END AS category, sum(n)::BIGINT AS n FROM cases WHERE month BETWEEN '1996-03' AND '1997-02' GROUP BY 1, 2")
def a58_categories(spark, d):
    return rg.category_totals(cases(spark, d), {"F": "closed", "O": "closed"}, "1996-03", "1997-02")


@query("""WITH p AS (SELECT c_nationkey AS unit, CASE WHEN c_nationkey % 8 = 0 THEN NULL ELSE count(DISTINCT c_custkey) END AS population, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1) SELECT unit, round(n / population * 100000 * 12 / 80, 4) AS rate FROM p""")
def a57_rates(spark, d):
    c = table(spark, d, "customer").join(table(spark, d, "orders"), F.col("o_custkey") == F.col("c_custkey"), "left").groupBy(F.col("c_nationkey").alias("unit")).agg(F.count_distinct("c_custkey").alias("p"), F.count("o_orderkey").alias("n"))
    return c.select("unit", F.round(rg.rate_per_100k(F.col("n"), F.when(F.col("unit") % 8 != 0, F.col("p")), F.lit(80)), 4).alias("rate"))


TENURES = """tn AS (SELECT 'tenure ' || k AS tenure, k::INT AS no, strftime(DATE '1992-01-01' + to_months((k * 18)::INT), '%Y-%m') AS first, strftime(DATE '1992-01-01' + to_months((k * 18 + 17)::INT), '%Y-%m') AS last FROM range(6) t(k)),
sp AS (SELECT first AS month, tenure, no, 0.4::DOUBLE AS share FROM tn WHERE no > 0 UNION ALL SELECT n.first, p.tenure, p.no, 0.6 FROM tn n JOIN tn p ON p.no = n.no - 1),
sh AS (SELECT tenure, no, month, share FROM sp UNION ALL SELECT tenure, no, m.month, 1.0 FROM (SELECT DISTINCT month FROM cases) m JOIN tn ON m.month BETWEEN first AND last WHERE m.month NOT IN (SELECT month FROM sp)),
tenures AS (SELECT * FROM sh WHERE month IN (SELECT month FROM cases)), w AS (SELECT tenure, no, sum(share) AS w FROM sh GROUP BY 1, 2)"""


def tenures(spark, months):
    """Six tenures of 18 months; the first month of each is split with the one before."""
    k = F.col("id").cast("int")
    at = lambda n: F.date_format(F.add_months(F.lit("1992-01-01").cast("date"), n), "yyyy-MM")
    tn = spark.range(6).select(F.concat(F.lit("tenure "), k.cast("string")).alias("tenure"), k.alias("no"), at(k * 18).alias("first"), at(k * 18 + 17).alias("last"))
    before = tn.select((F.col("no") + 1).alias("no"), "tenure")
    splits = tn.filter("no > 0").select(F.col("first").alias("month"), "tenure", F.lit(0.4).alias("share")).unionByName(tn.select("no", F.col("first").alias("month")).join(before, "no").select("month", "tenure", F.lit(0.6).alias("share")))
    return rg.tenure_shares(months, tn, splits)


@query(f"""WITH {CASES}, {TENURES}, p AS (SELECT tenure, no, w.w, sum(n * share) / w.w AS mean FROM (SELECT month, sum(n) AS n FROM cases GROUP BY 1) JOIN tenures USING (month) RIGHT JOIN w USING (tenure, no) GROUP BY 1, 2, 3)
SELECT tenure, no, round(w, 4) AS months, round(coalesce(mean, 0), 4) AS mean, CASE WHEN lag(mean) OVER (ORDER BY no) > 0.5 THEN round((coalesce(mean, 0) / lag(mean) OVER (ORDER BY no) - 1) * 100, 4) END AS change_pct FROM p""")
def a59_tenures(spark, d):
    m = cases(spark, d).groupBy("month").agg(F.sum("n").alias("n"))
    return rg.tenure_rate(m, tenures(spark, m))


@query(f"""WITH {CASES}, {TENURES}, m AS (SELECT month, category, sum(n) AS n FROM cases GROUP BY 1, 2), x AS (SELECT category, first AS month, no - 1 AS no FROM tn, (SELECT 'F' AS category) WHERE no > 0),
c AS (SELECT no, category, n * share AS s FROM m JOIN tenures USING (month) WHERE (category, month) NOT IN (SELECT (category, month) FROM x) UNION ALL SELECT x.no, m.category, n FROM m JOIN x ON x.category = m.category AND x.month = m.month),
p AS (SELECT w.tenure, w.no, k.category, w.w, coalesce(sum(c.s), 0) / w.w AS mean FROM w CROSS JOIN (SELECT DISTINCT category FROM m) k LEFT JOIN c ON c.no = w.no AND c.category = k.category GROUP BY 1, 2, 3, 4)
SELECT tenure, no, category, round(w, 4) AS months, round(mean, 4) AS mean, CASE WHEN lag(mean) OVER (PARTITION BY category ORDER BY no) > 0.5 THEN round((mean / lag(mean) OVER (PARTITION BY category ORDER BY no) - 1) * 100, 4) END AS change_pct FROM p""")
def a59_offences(spark, d):
    """Cases of one category in a split month count with the earlier tenure as a whole."""
    m = cases(spark, d).groupBy("month", "category").agg(F.sum("n").alias("n"))
    shares = tenures(spark, m)
    moved = shares.filter("share = 0.6").select(F.lit("F").alias("category"), "month", "tenure", F.lit(1.0).alias("share"))
    return rg.tenure_rate(m, shares, ["category"], moved)


@query(f"WITH {CASES} SELECT unit, (sum(n) FILTER (month BETWEEN '1998-01' AND '1998-06'))::BIGINT AS now, (sum(n) FILTER (month BETWEEN '1997-07' AND '1997-12'))::BIGINT AS before, round((avg(n) FILTER (month BETWEEN '1998-01' AND '1998-06') - avg(n) FILTER (month BETWEEN '1997-07' AND '1997-12')) / avg(n) FILTER (month BETWEEN '1997-07' AND '1997-12') * 100, 4) AS change_pct FROM cases GROUP BY 1")
def a60_previous_window(spark, d):
    return rg.against_previous(cases(spark, d), ["unit"], "1998-01", "1998-06")


@query(f"""WITH {CASES}, s AS (SELECT unit, month, sum(n)::DOUBLE AS n FROM cases GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY unit ORDER BY month) AS k, count(*) OVER (PARTITION BY unit) AS c FROM s)
SELECT unit, max(c) AS n, round(sum(n) FILTER (k <= c // 2), 4) AS first, round(sum(n) FILTER (k > c - c // 2), 4) AS second, round(sum(n) FILTER (k > c - c // 2) / sum(n) FILTER (k <= c // 2) - 1, 6) AS trend FROM r GROUP BY 1""")
def a61_half_trend(spark, d):
    s = cases(spark, d).groupBy("unit", "month").agg(F.sum("n").cast("double").alias("n"))
    return st.half_trend(s, ["unit"], "month", "n")


@query(f"WITH {DAYS} SELECT year(date) AS year, {', '.join(f'round(sum(demand) FILTER (month(date) = {k}), 2) AS m{k}' for k in range(1, 13))} FROM days GROUP BY 1")
def a62_year_matrix(spark, d):
    return rg.year_matrix(line_days(spark, d), "demand")


UNITS = "u AS (SELECT c_name AS unit, c_nationkey AS division, CASE WHEN c_custkey % 10 = 0 THEN 'metro' ELSE 'range' END AS kind, c_custkey * 10 + 5000 AS population FROM customer)"


@query(f"WITH {UNITS} SELECT unit, kind, population, CASE WHEN kind = 'range' THEN population - coalesce(sum(population) FILTER (kind = 'metro') OVER (PARTITION BY division), 0) ELSE population END::BIGINT AS remaining FROM u")
def j17_remaining(spark, d):
    kind = F.when(F.col("c_custkey") % 10 == 0, "metro").otherwise("range")
    u = table(spark, d, "customer").select(F.col("c_name").alias("unit"), F.col("c_nationkey").alias("division"), kind.alias("kind"), (F.col("c_custkey") * 10 + 5000).alias("population"))
    return rg.remaining_population(u).select("unit", "kind", "population", "remaining")


@query("SELECT r_name AS zone, count(*) AS population FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY 1")
def j16_zone_population(spark, d):
    per = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("population"))
    parts = table(spark, d, "nation").join(table(spark, d, "region"), F.col("r_regionkey") == F.col("n_regionkey")).select("n_nationkey", F.col("r_name").alias("zone"))
    return rg.sum_up(per, parts, "n_nationkey", "zone", "population")


# Squares of side 10 around a grid of nations; points from customers.
@query("""WITH p AS (SELECT c_custkey AS id, (c_custkey * 37 % 6000) / 100.0::DOUBLE AS lon, (c_custkey * 91 % 6000) / 100.0::DOUBLE AS lat FROM customer)
SELECT id, CASE WHEN lon < 50 AND lat < 50 THEN 'NATION_' || (floor(lat / 10) * 5 + floor(lon / 10))::INT END AS name FROM p""")
def j14_in_polygon(spark, d):
    return mt.point_in_polygon(points(spark, d), squares(spark, d), 20)


def squares(spark, d):
    n = table(spark, d, "nation")
    x, y = (F.col("n_nationkey") % 5 * 10).cast("double"), (F.floor(F.col("n_nationkey") / 5) * 10).cast("double")
    at = lambda a, b: F.struct((x + a).alias("lon"), (y + b).alias("lat"))
    return n.select(F.col("n_name").alias("name"), F.array(at(0, 0), at(10, 0), at(10, 10), at(0, 10)).alias("ring"))


def points(spark, d):
    c = table(spark, d, "customer")
    return c.select(F.col("c_custkey").alias("id"), (F.col("c_custkey") * 37 % 6000 / 100.0).alias("lon"), (F.col("c_custkey") * 91 % 6000 / 100.0).alias("lat"))


@query("SELECT n_name AS name, 100.0::DOUBLE AS area, (n_nationkey % 5 * 10 + 5)::DOUBLE AS lon, (n_nationkey // 5 * 10 + 5)::DOUBLE AS lat FROM nation")
def g2_g3_rings(spark, d):
    c = mt.ring_centroid(F.col("ring"))
    return squares(spark, d).select("name", mt.ring_area(F.col("ring")).alias("area"), F.round(c["lon"], 6).alias("lon"), F.round(c["lat"], 6).alias("lat"))


@query("""WITH p AS (SELECT c_custkey AS id, c_mktsegment AS kind, (c_custkey * 37 % 6000) / 100.0::DOUBLE AS lon, (c_custkey * 91 % 6000) / 100.0::DOUBLE AS lat, 'Place ' || c_custkey % 40 AS name FROM customer)
SELECT DISTINCT kind, name, 'NATION_' || (floor(lat / 10) * 5 + floor(lon / 10))::INT AS district FROM p WHERE lon < 50 AND lat < 50""")
def a80_gazetteer(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("kind"), F.concat(F.lit("Place "), (F.col("c_custkey") % 40).cast("string"), F.lit(" Upazila")).alias("name"))
    return mt.gazetteer(c.join(points(spark, d), "id"), squares(spark, d))


@query("""WITH t AS (SELECT p_partkey, p_name, list_distinct(list_filter(string_split(lower(p_name), ' '), lambda x: length(x) > 2)) AS a FROM part), o AS (SELECT DISTINCT p_name AS other, list_distinct(list_filter(string_split(lower(p_name), ' '), lambda x: length(x) > 2)) AS b FROM part WHERE p_size > 3),
s AS (SELECT p_partkey, p_name, other, round(len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))), 6) AS score FROM t, o WHERE len(list_intersect(a, b)) > 0)
SELECT p_partkey, p_name, arg_min(other, (-score, other)) AS other, max(score) AS score FROM s WHERE score >= 0.34 GROUP BY 1, 2""")
def j12_token_match(spark, d):
    p = table(spark, d, "part")
    return mt.token_match(p.select("p_partkey", "p_name"), p.filter("p_size > 3").select(F.col("p_name").alias("other")), "p_name", "other")


_DUCK = lambda text: text.replace("AS string", "AS VARCHAR")


# Stations and features are named after all parts and towns that spell a number; some stations have a town alone, or none.
TOWN = "concat('kor', translate(cast({} AS string), '0123456789', 'bdfgklmnrt'))"
STATION = f"CASE p_partkey % 5 WHEN 1 THEN concat({TOWN.format('(p_partkey % 997)')}, ' unit') WHEN 2 THEN concat('unit ', {TOWN.format('(p_partkey % 313 + 2000)')}) ELSE concat(p_name, ' plant (new) ', {TOWN.format('(p_partkey % 97)')}) END"
FEATURE = f"concat({TOWN.format('(p_partkey * 5 % 97)')}, ' ', p_name, ' station')"
DUCK_TOKENS = "list_distinct(list_filter(regexp_split_to_array(trim(regexp_replace(lower(regexp_replace({}, '\\(.*?\\)', ' ', 'g')), '[^a-z\\s]', ' ', 'g')), '\\s+'), lambda w: length(w) > 2 AND w NOT IN ('unit', 'plant', 'station')))"


@query(f"""WITH s AS (SELECT DISTINCT {_DUCK(STATION)} AS name FROM part), t AS (SELECT name, {DUCK_TOKENS.format('name')} AS t FROM s),
f1 AS (SELECT {_DUCK(FEATURE)} AS name, min({{'lat': p_size::DOUBLE, 'lon': p_partkey::DOUBLE}}) AS pos FROM part GROUP BY 1), f2 AS (SELECT {_DUCK(TOWN.format('(p_partkey % 997)'))} || ' town ' || p_size % 3 AS name, min({{'lat': p_size + 100.0::DOUBLE, 'lon': p_partkey::DOUBLE}}) AS pos FROM part WHERE p_partkey % 997 >= 400 GROUP BY 1),
c AS (SELECT {_DUCK(TOWN.format('(p_partkey % 2500)'))} AS token, min({{'lat': p_size + 200.0::DOUBLE, 'lon': p_partkey::DOUBLE}}) AS pos FROM part WHERE p_partkey % 2500 % 3 = 0 GROUP BY 1),
f AS (SELECT 1 AS tier, name AS other, pos, {DUCK_TOKENS.format('name')} AS u FROM f1 UNION ALL SELECT 2, name, pos, {DUCK_TOKENS.format('name')} FROM f2), cl AS (SELECT list(token) AS l FROM c),
j AS (SELECT name, tier, other, pos, len(list_intersect(t, u)) / len(list_distinct(list_concat(t, u))) + CASE WHEN list_has_any(list_intersect(t, u), l) THEN 0.15 ELSE 0 END AS j FROM t, f, cl WHERE len(list_intersect(t, u)) > 0),
m AS (SELECT name, tier, pos, round(round(j, 6), 2) AS score FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY tier, round(j, 6) DESC, other) AS k FROM j WHERE round(j, 6) >= 0.34) WHERE k = 1),
w AS (SELECT name, pos FROM (SELECT name, c.pos, row_number() OVER (PARTITION BY name ORDER BY list_position(t, token)) AS k FROM t JOIN c ON list_contains(t, token)) WHERE k = 1)
SELECT p_partkey, coalesce(m.pos, w.pos, z.pos).lat AS lat, coalesce(m.pos, w.pos, z.pos).lon AS lon, CASE WHEN m.pos IS NOT NULL THEN ['osm', 'place'][tier] WHEN w.pos IS NOT NULL THEN 'curated' WHEN z.pos IS NOT NULL THEN 'zone' ELSE 'none' END AS tier, score
FROM (SELECT p_partkey, {_DUCK(STATION)} AS name, p_size % 4 AS zone FROM part) p LEFT JOIN m USING (name) LEFT JOIN w USING (name) LEFT JOIN (SELECT zone, {{'lat': zone * 10.0::DOUBLE, 'lon': 0.0::DOUBLE}} AS pos FROM (VALUES (0), (1), (2)) z(zone)) z USING (zone)""")
def j12_locate(spark, d):
    p = table(spark, d, "part")
    at = lambda more: [(F.col("p_size") + more).cast("double").alias("lat"), F.col("p_partkey").cast("double").alias("lon")]
    stations = p.select("p_partkey", F.expr(STATION).alias("name"), (F.col("p_size") % 4).alias("zone"))
    osm = p.select(F.expr(FEATURE).alias("name"), *at(0))
    place = p.filter("p_partkey % 997 >= 400").select(F.concat_ws(" ", F.expr(TOWN.format("(p_partkey % 997)")), F.lit("town"), (F.col("p_size") % 3).cast("string")).alias("name"), *at(100))
    curated = p.filter("p_partkey % 2500 % 3 = 0").select(F.expr(TOWN.format("(p_partkey % 2500)")).alias("token"), *at(200))
    zones = p.select((F.col("p_size") % 4).alias("zone")).filter("zone < 3").distinct().select("zone", (F.col("zone") * 10.0).alias("lat"), F.lit(0.0).alias("lon"))
    return mt.locate(stations, [("osm", osm), ("place", place)], curated, zones, ("unit", "plant", "station")).select("p_partkey", "lat", "lon", "tier", "score")


@query("SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN c_name WHEN c_custkey % 3 = 0 THEN c_mktsegment END AS place, CASE WHEN c_custkey % 4 = 0 THEN 'name' WHEN c_custkey % 3 = 0 THEN 'segment' ELSE 'none' END AS tier FROM customer")
def j12_tiers(spark, d):
    c = table(spark, d, "customer")
    tiers = [("name", c.filter("c_custkey % 4 = 0").select("c_custkey", F.col("c_name").alias("place"))), ("segment", c.filter("c_custkey % 3 = 0").select("c_custkey", F.col("c_mktsegment").alias("place")))]
    return mt.tiered(c.select("c_custkey"), tiers, ["c_custkey"], "place")


@query("""WITH w AS (SELECT p_partkey AS id, p_brand AS page, p_size * 2.0::DOUBLE AS x FROM part), c AS (SELECT DISTINCT p_brand AS page, (p_size // 10 * 20 + 7)::DOUBLE AS centre FROM part), n AS (SELECT id, page, x, centre, abs(centre - x) AS gap, row_number() OVER (PARTITION BY id ORDER BY abs(centre - x), centre) AS k FROM w JOIN c USING (page) WHERE abs(centre - x) <= 6)
SELECT id, page, x, centre, gap FROM n WHERE k = 1""")
def j15_nearest_centre(spark, d):
    p = table(spark, d, "part")
    words = p.select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("page"), (F.col("p_size") * 2.0).alias("x"))
    centres = p.select(F.col("p_brand").alias("page"), (F.floor(F.col("p_size") / 10) * 20 + 7).cast("double").alias("centre")).distinct()
    return mt.nearest_centre(words, centres, ["page"], "x", "centre", 6.0)


# A place for each part: its name and a word that spells its key, some letters with marks; some have another spelling. Typed names
# take each way in turn: whole, beginning, beginning of the other spelling, inner letters, other vowels, a letter left out.
CODE = "translate({}, '0123456789', 'bdfgklmnrt')"
PLACE_NAME = f"translate(concat(p_name, ' ', {CODE.format('cast(p_partkey AS string)')}), CASE WHEN p_partkey % 5 = 0 THEN 'og' ELSE '' END, CASE WHEN p_partkey % 5 = 0 THEN 'óğ' ELSE '' END)"
PLACE_ALIAS = f"concat('Qx', {CODE.format('cast(p_partkey AS string)')}, ' old')"
TYPED = """CASE p_partkey % 6 WHEN 0 THEN upper(name) WHEN 1 THEN concat(' ', substr(name, 1, 8)) WHEN 2 THEN substr(alias, 1, 4) WHEN 3 THEN substr(name, 4, 7) WHEN 4 THEN translate(name, 'aeiou', 'eioua') ELSE concat(substr(name, 1, 5), substr(name, 7)) END"""


def _duck_sounds(c: str) -> str:
    from recordscope.functions.text import SOUNDS

    t = f"regexp_replace(strip_accents(lower({c})), '[^a-z\\s]', '', 'g')"
    for pattern, to in SOUNDS:
        t = f"regexp_replace({t}, '{pattern}', '{to}', 'g')"
    letters = f"string_split({t}, '')"
    return f"replace(array_to_string(list_filter({letters}, lambda x, i: i = 1 OR x <> {letters}[i - 1]), ''), ' ', '')"



@query(f"""WITH p AS (SELECT p_partkey, {_DUCK(PLACE_NAME)} AS name, {_DUCK(PLACE_ALIAS)} AS alias, p_brand AS district, ['district', 'upazila', 'place', 'zone', 'plant', 'substation'][p_size % 6 + 1] AS kind, 'Zone ' || p_size % 4 AS zone FROM part),
q AS (SELECT DISTINCT {TYPED} AS q FROM p), s AS (SELECT q, lower(trim(q)) AS t, {_duck_sounds('trim(q)')} AS k FROM q),
e AS (SELECT *, lower(name) AS l, CASE WHEN p_partkey % 7 < 3 THEN lower(alias) END AS al, {_duck_sounds('name')} AS k1, CASE WHEN p_partkey % 7 < 3 THEN {_duck_sounds('alias')} ELSE '' END AS k2 FROM p),
m AS (SELECT q, e.*, CASE WHEN l = t THEN 0 WHEN starts_with(l, t) THEN 1 WHEN starts_with(al, t) THEN 2 WHEN contains(l, t) THEN 3 WHEN s.k <> '' AND (s.k = k1 OR s.k = k2) THEN 4
  WHEN length(s.k) >= 3 AND (k1 <> '' AND levenshtein(s.k, k1) <= 1 OR k2 <> '' AND levenshtein(s.k, k2) <= 1) THEN 5 END AS rank FROM s, e WHERE length(t) >= 2),
o AS (SELECT q, rank, kind, name, district, zone, row_number() OVER (PARTITION BY q ORDER BY rank, list_position(['district', 'upazila', 'place', 'zone', 'plant', 'substation'], kind), length(name), name, kind, zone, district) AS place FROM m WHERE rank IS NOT NULL)
SELECT q, place::INT AS place, rank, kind, name, district, zone FROM o WHERE place <= 8""")
def j21_places(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.expr(PLACE_NAME).alias("name"), F.expr(PLACE_ALIAS).alias("alias"), F.col("p_brand").alias("district"), F.get(F.array(*[F.lit(k) for k in mt.KINDS]), F.col("p_size") % 6).alias("kind"), F.concat(F.lit("Zone "), (F.col("p_size") % 4).cast("string")).alias("zone"))
    return mt.resolve_places(p.select(F.expr(TYPED).alias("q")), p.select("kind", "name", "district", "zone"), "q", p.filter("p_partkey % 7 < 3").select("name", "alias"))


@query("""WITH a AS (SELECT c_custkey AS id, 'Town ' || c_custkey % 50 AS name, c_nationkey AS district FROM customer), b AS (SELECT s_suppkey, 'TOWN-' || s_suppkey % 50 AS name, s_nationkey AS district FROM supplier),
p AS (SELECT a.*, b.name AS match, a.district = b.district AS same_district, row_number() OVER (PARTITION BY a.id ORDER BY (a.district = b.district) DESC, b.name, b.district) AS k FROM a JOIN b ON regexp_replace(lower(a.name), '[^a-z0-9]', '', 'g') = regexp_replace(lower(b.name), '[^a-z0-9]', '', 'g'))
SELECT id, name, district, match, same_district FROM p WHERE k = 1""")
def j22_same_name(spark, d):
    a = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.concat(F.lit("Town "), (F.col("c_custkey") % 50).cast("string")).alias("name"), F.col("c_nationkey").alias("district"))
    b = table(spark, d, "supplier").select(F.concat(F.lit("TOWN-"), (F.col("s_suppkey") % 50).cast("string")).alias("name"), F.col("s_nationkey").alias("district"))
    return mt.same_name(a, b)


@query("""SELECT o_orderdate::DATE AS date, o_orderpriority AS slot, min(CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END) AS a, coalesce(min(CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END), min(CASE WHEN o_orderkey % 2 = 1 THEN o_custkey END)) AS b FROM orders GROUP BY 1, 2""")
def j23_merged_slots(spark, d):
    o = table(spark, d, "orders").select(F.to_date("o_orderdate").alias("date"), F.col("o_orderpriority").alias("slot"), "o_orderkey", "o_totalprice", "o_custkey")
    half = lambda k: o.filter(F.col("o_orderkey") % 2 == k).groupBy("date", "slot")
    a = half(0).agg(F.min("o_totalprice").alias("a"), F.min("o_custkey").alias("b"))
    b = half(1).agg(F.lit(None).cast("double").alias("a"), F.min("o_custkey").alias("b"))
    return mt.merge_slots(a, b, ["date", "slot"], ["a", "b"])


@query("SELECT doc_id, lang FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY length(text) DESC, doc_id) AS k FROM documents) WHERE k = 1")
def a3_richest(spark, d):
    docs = table(spark, d, "documents").select("source", "doc_id", "lang", F.length("text").alias("size"), F.regexp_replace("text", "(?s).", "x").alias("body"))
    k = docs.withColumn("pad", F.lpad(F.col("doc_id").cast("string"), 12, "0")).withColumn("lang2", F.rpad("lang", 4, "_"))
    best = ql.richest(k.select("source", "body", F.lit("x").alias("c"), "pad"), ["source"], ["pad"])
    return best.join(docs.withColumn("pad", F.lpad(F.col("doc_id").cast("string"), 12, "0")), ["source", "pad"]).select("doc_id", "lang")


@query("SELECT o_orderkey, a AS stored, b AS fresh FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 3 THEN NULL ELSE o_totalprice END AS a, CASE WHEN o_orderkey % 40 = 1 THEN o_totalprice + 1 ELSE o_totalprice END AS b FROM orders) WHERE a IS DISTINCT FROM b")
def u4_diff(spark, d):
    o = table(spark, d, "orders")
    fresh = o.withColumn("o_totalprice", F.col("o_totalprice") + F.when(F.col("o_orderkey") % 40 == 1, 1).otherwise(0))
    return ql.dataset_diff(o.filter("o_orderkey % 50 <> 3"), fresh, ["o_orderkey"], "o_totalprice")


@query("SELECT l_orderkey, l_linenumber, count(DISTINCT l_returnflag) AS values FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P') GROUP BY 1, 2 HAVING count(DISTINCT l_returnflag) > 1")
def u5_unstable(spark, d):
    volatile = table(spark, d, "orders").filter("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("l_orderkey"), F.explode(F.sequence(F.lit(1), F.lit(7))).alias("l_linenumber"))
    return ql.unstable_keys(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], "l_returnflag", volatile)


@query(f"WITH {DAYS}, s AS (SELECT unnest(generate_series(DATE '1995-01-01', DATE '2002-01-31', INTERVAL 1 DAY))::DATE AS date) SELECT date FROM s ANTI JOIN days USING (date)")
def u3_missing_days(spark, d):
    return ql.missing_days(line_days(spark, d), dt.days(spark, "1995-01-01", "2002-01-31"))


@query(f"""WITH {FACTS}, f AS (SELECT DISTINCT date, gender FROM facts WHERE day(date) <> 21), c AS (SELECT date, gender FROM facts WHERE day(date) % 6 <> 0 GROUP BY 1, 2) SELECT date FROM f ANTI JOIN (SELECT DISTINCT date FROM c WHERE gender = 'F') USING (date) GROUP BY 1""")
def u3_dead_days(spark, d):
    f = facts(spark, d)
    log = f.filter(F.dayofmonth("date") != 21).select("date")
    control = f.filter("gender = 'F'").withColumn("n", F.when(F.dayofmonth("date") % 6 == 0, 0).otherwise(F.col("n")))
    return ql.dead_periods(log, control)


@query(f"""WITH {FACTS}, f AS (SELECT DISTINCT gender, strftime(date, '%Y-%m') AS month FROM facts), c AS (SELECT DISTINCT gender, strftime(date, '%Y-%m') AS month FROM facts WHERE NOT (gender = 'P' AND month(date) % 3 = 1)) SELECT gender, month FROM f ANTI JOIN c USING (gender, month)""")
def u3_dead_months(spark, d):
    f = facts(spark, d).withColumn("month", F.date_format("date", "yyyy-MM"))
    quiet = (F.col("gender") == "P") & (F.month("date") % 3 == 1)
    return ql.dead_periods(f, f.withColumn("n", F.when(quiet, 0).otherwise(F.col("n"))), ["gender"], "month")


@query("SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier")
def u2_intersection(spark, d):
    a, b = table(spark, d, "customer").select(F.col("c_nationkey").alias("k")), table(spark, d, "supplier").select(F.col("s_nationkey").alias("k"))
    return sets.common_keys(a, b, ["k"])


@query("SELECT name, max(balance) AS balance, count(brand) AS brands FROM (SELECT c_name AS name, c_acctbal AS balance, NULL AS brand FROM customer UNION ALL SELECT p_name, NULL, p_brand FROM part) GROUP BY 1")
def u1_union(spark, d):
    a = table(spark, d, "customer").select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    b = table(spark, d, "part").select(F.col("p_name").alias("name"), F.col("p_brand").alias("brand"))
    return sets.union_all([a, b]).groupBy("name").agg(F.max("balance").alias("balance"), F.count("brand").alias("brands"))


@query("""WITH m AS (SELECT unnest(generate_series(DATE '1997-01-01', DATE '1998-03-17', INTERVAL 1 MONTH))::DATE AS ms), c AS (SELECT ms, greatest(ms, DATE '1997-01-10') AS a, least(last_day(ms), DATE '1998-03-17') AS b FROM m),
w AS (SELECT ms, unnest(generate_series(a, b, INTERVAL 7 DAY))::DATE AS s, b FROM c) SELECT ms AS month_start, s AS "start", least(s + 6, b) AS "end", (SELECT count(*) FROM orders WHERE o_orderdate::DATE BETWEEN s AND least(s + 6, b)) AS n FROM w""")
def u6_weeks(spark, d):
    w = dt.weeks(spark, "1997-01-10", "1998-03-17").withColumn("date", F.explode(F.sequence("start", "end")))
    o = table(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("date")).agg(F.count("*").alias("n"))
    return w.join(o, "date", "left").groupBy("month_start", "start", "end").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


@query(f"""WITH {FACTS}, lv AS (SELECT country, date_trunc('month', date)::DATE AS ms, sum(n) AS n FROM facts GROUP BY 1, 2), med AS (SELECT 40 AS cut),
wk AS (SELECT DISTINCT country, date_trunc('month', date)::DATE AS ms, (date_trunc('month', date)::DATE + ((day(date) - 1) // 7 * 7)::INT)::DATE AS s FROM facts WHERE gender = 'P'),
p AS (SELECT country, unnest(generate_series(ms, last_day(ms), INTERVAL 1 DAY))::DATE AS date FROM lv WHERE n >= 40 UNION SELECT wk.country, unnest(generate_series(s, least(s + 6, last_day(s)), INTERVAL 1 DAY))::DATE FROM wk JOIN lv ON lv.country = wk.country AND lv.ms = wk.ms WHERE lv.n < 40)
SELECT country, date FROM p WHERE NOT (country = 'BUILDING' AND day(date) < 4) AND day(date) <> 13""")
def u7_screening(spark, d):
    f = facts(spark, d)
    month = F.to_date(F.trunc("date", "month"))
    live = f.groupBy("country", month.alias("month_start")).agg(F.sum("n").alias("n"))
    start = F.date_add(month, (F.floor((F.dayofmonth("date") - 1) / 7) * 7).cast("int"))
    weeks = f.filter("gender = 'P'").select("country", start.alias("start")).distinct().withColumn("end", F.least(F.date_add("start", 6), F.last_day("start")))
    span = f.agg(F.to_date(F.trunc(F.min("date"), "month")).alias("a"), F.last_day(F.max("date")).alias("b"))
    days = span.select(F.explode(F.sequence("a", "b")).alias("date"))
    done = days.filter(F.dayofmonth("date") < 4).withColumn("country", F.lit("BUILDING"))
    return rg.screening_plan(live, weeks, 40, done, days.filter(F.dayofmonth("date") == 13))


@query("SELECT o_orderkey, o_custkey % 12 BETWEEN 1 AND 8 AS valid, CASE WHEN o_orderdate::DATE IN (DATE '1996-01-01', DATE '1997-06-19') THEN 'volatile_sentinel' END AS date_flag FROM orders")
def c24_c25_flags(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", (F.col("o_custkey") % 12).alias("division"), F.to_date("o_orderdate").alias("date"))
    return ql.flag_rows(o, "division", range(1, 9), "date", ["1996-01-01", "1997-06-19"]).select("o_orderkey", "valid", "date_flag")


@query("SELECT o_orderkey, o_totalprice, CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE o_custkey END AS c FROM orders ORDER BY o_orderstatus = 'P' DESC, c DESC NULLS LAST, o_totalprice, o_orderkey LIMIT 200")
def l1_l2_l3_order(spark, d):
    o = table(spark, d, "orders").withColumn("c", F.when(F.col("o_custkey") % 5 != 0, F.col("o_custkey")))
    return sets.first_rows(o, [(F.col("o_orderstatus") == "P").desc(), F.col("c").desc_nulls_last(), "o_totalprice", "o_orderkey"], 200).select("o_orderkey", "o_totalprice", "c")


@query("SELECT o_custkey FROM (SELECT DISTINCT o_custkey FROM orders) ORDER BY md5(o_custkey || ':7'), o_custkey LIMIT 50")
def l4_random_keys(spark, d):
    return sets.random_keys(table(spark, d, "orders"), "o_custkey", 50)


@query("""WITH a AS (SELECT p_partkey, list_distinct(list_filter(string_split(lower(p_name), ' '), lambda x: length(x) > 2 AND x NOT IN ('small', 'red'))) AS t FROM part), b AS (SELECT DISTINCT p_name AS other, list_distinct(list_filter(string_split(lower(p_name), ' '), lambda x: length(x) > 2 AND x NOT IN ('small', 'red'))) AS u FROM part),
s AS (SELECT p_partkey, other, round(len(list_intersect(t, u)) / len(list_distinct(list_concat(t, u))), 6) AS score FROM a, b WHERE len(list_intersect(t, u)) > 0) SELECT p_partkey, arg_min(other, (-score, other)) AS other, max(score) AS score FROM s WHERE score >= 0.5 GROUP BY 1""")
def j13_header_match(spark, d):
    p = table(spark, d, "part")
    return mt.token_match(p.select("p_partkey", "p_name"), p.select(F.col("p_name").alias("other")), "p_name", "other", ("small", "red"), 0.5).select("p_partkey", "other", "score")
