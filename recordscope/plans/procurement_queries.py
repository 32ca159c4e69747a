"""Procurement queries on the stand-in tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordscope.functions import text as tx
from recordscope.operators import procurement as pr
from recordscope.operators import stats as st
from recordscope.plans.base import BANS, CONTRACTS, FIRST, ONCE, PLANS, bans, contracts, plans, query, table

METHODS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
RANK = dict(zip(METHODS, (5, 4, 3, 2, 2), strict=True))
RANK_SQL = "MAP {'1-URGENT': 5, '2-HIGH': 4, '3-MEDIUM': 3, '4-NOT SPECIFIED': 2, '5-LOW': 2}"


def once(spark, d):
    """Contracts without repeated keys."""
    return pr.pick_first(contracts(spark, d), ["tender_id", "pkg_lot_id"], FIRST)


@query(f"WITH {ONCE} SELECT tender_id, pkg_lot_id, package_ref, signed, value FROM once")
def a1_first_wins(spark, d):
    return once(spark, d).select("tender_id", "pkg_lot_id", "package_ref", "signed", "value")


@query(f"WITH {CONTRACTS} SELECT sum(n)::BIGINT AS n_rows, count(*) AS n_keys, sum(n - 1)::BIGINT AS n_duplicates FROM (SELECT count(*) AS n FROM contracts GROUP BY tender_id, pkg_lot_id)")
def a1_duplicate_count(spark, d):
    return pr.duplicate_count(contracts(spark, d), ["tender_id", "pkg_lot_id"])


@query(f"""WITH {CONTRACTS} SELECT tender_id, pkg_lot_id, package_ref, signed, value FROM (SELECT *, row_number() OVER (PARTITION BY tender_id, pkg_lot_id ORDER BY signed DESC, batch DESC, package_ref DESC, value DESC) AS k FROM contracts) WHERE k = 1""")
def a2_last_wins(spark, d):
    return pr.pick_last(contracts(spark, d), ["tender_id", "pkg_lot_id"], FIRST).select("tender_id", "pkg_lot_id", "package_ref", "signed", "value")


DIM = "dim AS (SELECT row_number() OVER (ORDER BY o) - 1 AS id, entity AS name FROM (SELECT entity, min((tender_id, pkg_lot_id, signed, batch, package_ref, value)) AS o FROM contracts GROUP BY entity))"


@query(f"WITH {CONTRACTS}, {DIM} SELECT id, name FROM dim")
def a4_dimension(spark, d):
    return pr.build_dimension(contracts(spark, d), "entity", ["tender_id", "pkg_lot_id", *FIRST])


@query(f"WITH {CONTRACTS}, {DIM} SELECT CASE WHEN c.batch % 10 = 0 THEN 'Unknown' ELSE dim.name END AS entity_name, count(*) AS n FROM contracts c LEFT JOIN dim ON dim.name = c.entity GROUP BY 1")
def j1_decode(spark, d):
    c = contracts(spark, d)
    dim = pr.build_dimension(c, "entity", ["tender_id", "pkg_lot_id", *FIRST])
    coded = c.join(dim.withColumnRenamed("name", "entity"), "entity").select(F.when(F.col("batch") % 10 != 0, F.col("id")).alias("entity_id"))
    return pr.decode_dimension(coded, "entity_id", dim, "entity_name").groupBy("entity_name").agg(F.count("*").alias("n"))


@query("SELECT name, n FROM (SELECT coalesce(CASE WHEN o_custkey % 9 = 0 THEN NULL ELSE o_orderpriority END, 'Unknown') AS name, count(*) AS n FROM orders GROUP BY 1)")
def a5_counts(spark, d):
    return pr.value_counts(table(spark, d, "orders").withColumn("p", F.when(F.col("o_custkey") % 9 != 0, F.col("o_orderpriority"))), "p")


@query(f"WITH {CONTRACTS} SELECT awarded_to AS name, count(*) AS n FROM contracts GROUP BY 1 ORDER BY n DESC, name LIMIT 50")
def a5_top_counts(spark, d):
    return pr.value_counts(contracts(spark, d), "awarded_to", 50)


@query("""WITH p AS (SELECT 'FY' || y || '-' || lpad(((y + 1) % 100)::VARCHAR, 2, '0') AS fiscal_year, coalesce(m, 'Unknown') AS ministry FROM (SELECT CASE WHEN month(o_orderdate) >= 7 THEN year(o_orderdate) ELSE year(o_orderdate) - 1 END AS y, CASE WHEN o_custkey % 41 = 0 THEN NULL ELSE 'Ministry ' || o_custkey % 41 END AS m FROM orders)),
t AS (SELECT ministry, count(*) AS n FROM p GROUP BY 1 ORDER BY n DESC, ministry LIMIT 20)
SELECT 'year' AS grain, fiscal_year, NULL AS ministry, count(*) AS n FROM p GROUP BY 2 UNION ALL SELECT 'ministry_year', fiscal_year, ministry, count(*) FROM p GROUP BY 2, 3 UNION ALL SELECT 'top_ministry', NULL, ministry, n FROM t""")
def a6_plan_rollup(spark, d):
    from recordscope.functions.dates import fiscal_year

    k = F.col("o_custkey") % 41
    o = table(spark, d, "orders").select(fiscal_year(F.year("o_orderdate"), F.month("o_orderdate")).alias("fiscal_year"), F.when(k != 0, F.concat(F.lit("Ministry "), k.cast("string"))).alias("ministry"))
    return pr.plan_rollup(o)


def register(spark, d):
    """Orders as bans: companies of one or several bans and some without a name, scopes and reasons in their words."""
    o, k = table(spark, d, "orders"), F.col("o_orderkey")
    start = F.to_date("o_orderdate")
    pick = lambda c, words: F.get(F.array(*[F.lit(w) for w in words]), (c % len(words)).cast("int"))
    name = F.when(F.col("o_custkey") % 17 == 0, "Co. Ltd.").otherwise(F.concat(F.lit("Firm no"), F.col("o_custkey").cast("string"), F.when(k % 2 == 0, " Ltd.").otherwise("")))
    rows = o.select(name.alias("company"), pick(k, ("this Package only", "e-GP Portal", "whole PROCURING ENTITY")).alias("scope"), F.lit(None).cast("string").alias("debarred_by"), pick(F.col("o_custkey"), ("forged papers and a bribe", "late", "Failed to complete")).alias("reason"), start.alias("start"), F.date_add(start, (F.col("o_custkey") % 3 * 365 + 100).cast("int")).alias("end"))
    return pr.ban_register(rows)


REGISTER = """r AS (SELECT CASE WHEN o_custkey % 17 = 0 THEN '' ELSE 'firm no' || o_custkey END AS "key", CASE WHEN o_custkey % 17 = 0 THEN 'Co. Ltd.' ELSE 'Firm no' || o_custkey || CASE WHEN o_orderkey % 2 = 0 THEN ' Ltd.' ELSE '' END END AS company,
  [1, 4, 2][o_orderkey % 3 + 1] AS points, o_custkey % 3 * 365 + 100 AS days, [['forgery_false_document', 'corruption'], ['unspecified'], ['non_performance']][o_custkey % 3 + 1] AS tags FROM orders),
g AS (SELECT *, CASE WHEN "key" = '' THEN 1 ELSE count(*) OVER (PARTITION BY "key") END AS repeats FROM r), s AS (SELECT *, points + CASE WHEN days >= 730 THEN 2 WHEN days >= 365 THEN 1 ELSE 0 END + CASE WHEN repeats > 1 THEN 2 ELSE 0 END AS p FROM g)"""


@query(f"""WITH {REGISTER} SELECT 'severity' AS grain, CASE WHEN p >= 6 THEN 'critical' WHEN p >= 4 THEN 'high' WHEN p >= 2 THEN 'medium' ELSE 'low' END AS name, count(*) AS n FROM s GROUP BY 2
UNION ALL SELECT 'tag', tag, count(*) FROM (SELECT unnest(tags) AS tag FROM s) GROUP BY 2 UNION ALL SELECT 'repeat', min(company), count(*) FROM s WHERE repeats > 1 GROUP BY "key" """)
def a7_ban_rollup(spark, d):
    return pr.ban_rollup(register(spark, d))


@query(f"""WITH {CONTRACTS}, y AS (SELECT *, year(signed) AS year FROM contracts)
SELECT CASE grouping_id(year, method, ministry, district) WHEN 7 THEN 'year' WHEN 3 THEN 'year_method' WHEN 5 THEN 'ministry_year' ELSE 'district' END AS grain, year, method, ministry, district, count(*) AS n, round(sum(value), 2) AS value
FROM y GROUP BY GROUPING SETS ((year), (year, method), (ministry, year), (district))""")
def a8_spend_cube(spark, d):
    return pr.spend_cube(contracts(spark, d).withColumn("year", F.year("signed")))


@query(f"""WITH {CONTRACTS}, t AS (SELECT entity, sum(value) AS v FROM contracts GROUP BY 1 ORDER BY round(v, 2) DESC, 1 LIMIT 5)
SELECT entity, year(signed) AS year, count(*) AS n, round(sum(value), 2) AS value FROM contracts SEMI JOIN t USING (entity) GROUP BY 1, 2""")
def a9_top_entities_by_year(spark, d):
    c = contracts(spark, d)
    top = pr.top_entities(c, "entity", "value", 5).select("entity")
    return c.join(top, "entity", "left_semi").groupBy("entity", F.year("signed").alias("year")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("value"))


PROFILE = r"""v AS (SELECT *, trim(regexp_replace(regexp_replace(regexp_replace(lower(awarded_to), '[.,]', '', 'g'), '\b(ltd|limited|pvt|private|co|company|m/s)\b', '', 'g'), '\s+', ' ', 'g')) AS vendor FROM contracts),
e AS (SELECT vendor, entity, count(*) AS c FROM v GROUP BY ALL), te AS (SELECT vendor, arg_min(entity, (-c, entity)) AS top_entity, max(c) AS m FROM e GROUP BY vendor),
prof AS (SELECT v.vendor, min(awarded_to) AS name, count(*) AS n, round(sum(value), 2) AS value, count(DISTINCT entity) AS n_entities, count(DISTINCT ministry) AS n_ministries, count(DISTINCT year(signed)) AS n_years,
  any_value(te.top_entity) AS top_entity, round(any_value(te.m) / count(*), 3) AS top_share FROM v JOIN te ON te.vendor = v.vendor GROUP BY v.vendor)"""


@query(f"WITH {CONTRACTS}, {PROFILE} SELECT * FROM prof")
def a10_vendor_profile(spark, d):
    return pr.vendor_profile(contracts(spark, d))


@query(f"""WITH {CONTRACTS}, {PROFILE}, r AS (
SELECT 'value' AS list, row_number() OVER (ORDER BY value DESC, vendor) AS place, vendor FROM prof UNION ALL
SELECT 'count', row_number() OVER (ORDER BY n DESC, vendor), vendor FROM prof UNION ALL
SELECT 'concentrated', row_number() OVER (ORDER BY value DESC, vendor), vendor FROM prof WHERE n >= 5 AND top_share >= 0.12)
SELECT list, place, vendor FROM r WHERE place <= 40""")
def a11_vendor_lists(spark, d):
    return pr.vendor_lists(pr.vendor_profile(contracts(spark, d)), share=0.12)


@query("SELECT year(o_orderdate) AS year, count(*) FILTER (o_orderstatus = 'F') AS \"F\", count(*) FILTER (o_orderstatus = 'O') AS \"O\", count(*) FILTER (o_orderstatus = 'P') AS \"P\" FROM orders GROUP BY 1")
def a12_tender_funnel(spark, d):
    return pr.tender_funnel(table(spark, d, "orders"), ["F", "O", "P"], "o_orderdate", "o_orderstatus")


def with_nature(spark, d):
    """J2: contracts with the nature of their tender, where some tenders are unknown."""
    t = table(spark, d, "orders").filter("o_orderkey % 7 <> 0").groupBy(F.col("o_orderkey").alias("tender_id")).agg(F.max_by("o_orderstatus", "o_orderdate").alias("nature"))
    return contracts(spark, d).join(t, "tender_id", "left")


NATURE = CONTRACTS + ", t AS (SELECT o_orderkey AS tender_id, o_orderstatus AS nature FROM orders WHERE o_orderkey % 7 <> 0), cn AS (SELECT contracts.*, t.nature FROM contracts LEFT JOIN t USING (tender_id))"


@query(f"WITH {NATURE} SELECT coalesce(nature, 'none') AS nature, count(*) AS n, round(count(nature) / count(*), 6) AS coverage FROM cn GROUP BY 1")
def j2_nature_coverage(spark, d):
    return with_nature(spark, d).groupBy(F.coalesce("nature", F.lit("none")).alias("nature")).agg(F.count("*").alias("n"), F.round(F.count("nature") / F.count("*"), 6).alias("coverage"))


@query(f"""WITH {NATURE}, m AS (SELECT entity, count(*) AS n, round(sum(value), 2) AS value FROM cn GROUP BY 1),
nat AS (SELECT entity, list_sort(list(x)) AS natures FROM (SELECT entity, coalesce(nature, 'Unknown') || '=' || count(*) AS x FROM cn GROUP BY entity, coalesce(nature, 'Unknown')) GROUP BY entity),
v AS (SELECT entity, awarded_to, row_number() OVER (PARTITION BY entity ORDER BY round(sum(value), 2) DESC, awarded_to) AS k FROM cn GROUP BY entity, awarded_to)
SELECT m.entity, n, value, natures, vendors FROM m JOIN nat USING (entity) JOIN (SELECT entity, list(awarded_to ORDER BY k) AS vendors FROM v WHERE k <= 5 GROUP BY entity) USING (entity)""")
def a13_entity_profile(spark, d):
    return pr.entity_profile(with_nature(spark, d), "entity")


@query(f"""WITH {CONTRACTS}, p AS (SELECT awarded_to, ministry, sum(value) AS v, count(*) AS c, row_number() OVER (PARTITION BY awarded_to ORDER BY sum(value) DESC, ministry) AS k FROM contracts GROUP BY 1, 2)
SELECT awarded_to, count(*) AS n_ministries, sum(c)::BIGINT AS n, round(sum(v), 2) AS value, list(ministry ORDER BY k) FILTER (k <= 10) AS ministries FROM p GROUP BY 1 HAVING count(*) >= 3 ORDER BY 2 DESC, 4 DESC, 1 LIMIT 30""")
def a14_cross_vendors(spark, d):
    return pr.cross_vendors(contracts(spark, d))


@query(f"WITH {CONTRACTS} SELECT month(signed) AS month, count(*) AS n, round(sum(value), 2) AS value, round(sum(value) / sum(sum(value)) OVER (), 6) AS share FROM contracts GROUP BY 1")
def a15_seasonality(spark, d):
    return pr.shares(contracts(spark, d).withColumn("month", F.month("signed")), ["month"]).select("month", "n", "value", "share")


@query(f"WITH {CONTRACTS} SELECT year(signed) AS year, count(*) AS n, round(coalesce(sum(value) FILTER (month(signed) = 6), 0) / sum(value), 6) AS share, make_date(year(signed), 12, 31) > DATE '2001-06-30' AS partial FROM contracts GROUP BY year(signed) HAVING count(*) >= 500")
def a15_june_share(spark, d):
    return pr.month_rush(contracts(spark, d), partial_from="2001-06-30")


@query(f"WITH {CONTRACTS} SELECT year(signed) AS year, method, count(*) AS n, round(sum(value), 2) AS value, round(sum(value) / sum(sum(value)) OVER (PARTITION BY year(signed)), 6) AS share FROM contracts GROUP BY 1, 2")
def a16_method_mix(spark, d):
    return pr.shares(contracts(spark, d).withColumn("year", F.year("signed")), ["method"], ["year"]).select("year", "method", "n", "value", "share")


@query(f"""WITH {CONTRACTS}, p AS (SELECT ministry, awarded_to, sum(value) AS v FROM contracts GROUP BY 1, 2), k AS (SELECT *, row_number() OVER (PARTITION BY ministry ORDER BY v DESC, awarded_to) AS k FROM p)
SELECT ministry, round(sum(v), 2) AS total, count(*) AS n_keys, round(sum(v * v) / (sum(v) * sum(v)) * 10000, 4) AS hhi, round(sum(v) FILTER (k <= 10) / sum(v), 6) AS top_share FROM k GROUP BY 1""")
def a17_concentration(spark, d):
    return st.concentration(contracts(spark, d), ["ministry"], "awarded_to", "value")


@query(f"""WITH {CONTRACTS}, p AS (SELECT awarded_to, sum(value) AS v FROM contracts GROUP BY 1), k AS (SELECT *, row_number() OVER (ORDER BY v DESC, awarded_to) AS k FROM p)
SELECT round(sum(v), 2) AS total, count(*) AS n_keys, round(sum(v * v) / (sum(v) * sum(v)) * 10000, 4) AS hhi, round(sum(v) FILTER (k <= 10) / sum(v), 6) AS top_share FROM k""")
def a17_national(spark, d):
    return st.concentration(contracts(spark, d), [], "awarded_to", "value")


@query(f"""WITH {CONTRACTS}, p AS (SELECT entity, awarded_to, sum(value) AS v FROM contracts GROUP BY 1, 2), k AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY v DESC, awarded_to) AS k FROM p)
SELECT entity, round(sum(v), 2) AS total, count(*) AS n_keys, round(sum(v * v) / (sum(v) * sum(v)) * 10000, 4) AS hhi, round(sum(v) FILTER (k <= 10) / sum(v), 6) AS top_share FROM k GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15""")
def a17_largest_groups(spark, d):
    return st.concentration(contracts(spark, d), ["entity"], "awarded_to", "value", groups=15)


@query(f"""WITH {CONTRACTS}, p AS (SELECT entity, awarded_to, count(*) AS c, sum(value) AS v FROM contracts GROUP BY 1, 2), o AS (SELECT entity, sum(c)::BIGINT AS n, sum(v) AS value, max(v) AS most FROM p GROUP BY 1)
SELECT entity, n, round(value, 2) AS value, round(most / value, 6) AS share, least(floor(most / value * 5), 4)::INT AS bucket FROM o WHERE n >= 50 AND value >= 1e6 ORDER BY 4 DESC, 1 LIMIT 20""")
def a18_worst_offices(spark, d):
    return pr.office_concentration(contracts(spark, d), least_value=1e6, worst=20)


@query(f"""WITH {CONTRACTS}, p AS (SELECT entity, awarded_to, count(*) AS c, sum(value) AS v FROM contracts GROUP BY 1, 2), o AS (SELECT entity, sum(c)::BIGINT AS n, sum(v) AS value, max(v) AS most FROM p GROUP BY 1)
SELECT entity, n, round(value, 2) AS value, round(most / value, 6) AS share, least(floor(most / value * 5), 4)::INT AS bucket FROM o WHERE n >= 50 AND value >= 1e6""")
def a18_office_concentration(spark, d):
    return pr.office_concentration(contracts(spark, d), least_value=1e6)


PRICES = CONTRACTS + ", pp AS (SELECT * REPLACE (floor(value / 10000) * 10000 AS value) FROM contracts)"


def stepped(spark, d):
    return contracts(spark, d).withColumn("value", F.floor(F.col("value") / 10000) * 10000.0)


@query(f"""WITH {PRICES}, c AS (SELECT value, method, count(*) AS c FROM pp GROUP BY 1, 2)
SELECT value, sum(c)::BIGINT AS n, round(sum(c) FILTER (method = '1-URGENT') / sum(c), 6) AS method_share, arg_min(method, (-c, method)) AS modal_method FROM c GROUP BY 1 ORDER BY n DESC, value LIMIT 25""")
def a19_price_points(spark, d):
    return pr.price_points(stepped(spark, d), "1-URGENT")


@query(f"""WITH {PRICES}, c AS (SELECT value, count(*) AS n, count(*) FILTER (method = '1-URGENT') AS m FROM pp GROUP BY 1)
SELECT count(*) AS n_values, round((SELECT sum(n) FROM (SELECT n FROM c ORDER BY n DESC, value LIMIT 5)) / sum(n), 6) AS top_share, round(sum(m) / sum(n), 6) AS method_share FROM c""")
def a19_price_summary(spark, d):
    return pr.price_summary(stepped(spark, d), "1-URGENT", 5)


@query(f"WITH {CONTRACTS} SELECT floor(value / 5000)::BIGINT AS bin, floor(value / 5000) * 5000.0 AS lower, count(*) AS n FROM contracts WHERE value >= 0 AND value < 60000 GROUP BY 1, 2")
def a20_histogram(spark, d):
    return st.histogram(contracts(spark, d), "value", 5000.0, 60000.0)


def plan_pairs(spark, d):
    """J3: awards with the plan item of their reference and the ratio of both."""
    award = contracts(spark, d).withColumn("reference", F.concat(F.lit("PKG-"), F.col("package_ref").cast("string"), F.lit(" ")))
    return pr.match_plans(plans(spark, d), award, ["estimate", "name"]).withColumn("ratio", F.col("value") / F.col("estimate"))


PAIRS = f"{CONTRACTS}, {PLANS}, pairs AS (SELECT contracts.*, plans.*, value / estimate AS ratio FROM contracts JOIN plans ON plans.ref = 'pkg-' || package_ref WHERE value <> 0 AND estimate > 0)"


@query(f"WITH {PAIRS} SELECT count(*) AS n, count(DISTINCT ref) AS n_refs, round(sum(value), 2) AS value, round(sum(estimate), 2) AS estimate FROM pairs")
def j3_plan_match(spark, d):
    return plan_pairs(spark, d).agg(F.count("*").alias("n"), F.count_distinct("ref").alias("n_refs"), F.round(F.sum("value"), 2).alias("value"), F.round(F.sum("estimate"), 2).alias("estimate"))


@query(f"""WITH {PAIRS} SELECT CASE WHEN ratio < 0.7 THEN '<70%' WHEN ratio < 0.85 THEN '70-85%' WHEN ratio < 0.95 THEN '85-95%' WHEN ratio <= 1 THEN '95-100%' WHEN ratio <= 1.15 THEN '100-115%' ELSE '>115%' END AS bucket, count(*) AS n FROM pairs GROUP BY 1""")
def a21_ratio_buckets(spark, d):
    return plan_pairs(spark, d).groupBy(pr.ratio_bucket(F.col("ratio")).alias("bucket")).agg(F.count("*").alias("n"))


@query(f"WITH {PAIRS} SELECT floor(ratio * 100 + 0.5)::INT AS point, count(*) AS n FROM pairs WHERE ratio BETWEEN 0.6 AND 1.2 GROUP BY 1")
def a21_ratio_points(spark, d):
    return plan_pairs(spark, d).filter("ratio between 0.6 and 1.2").groupBy(F.floor(F.col("ratio") * 100 + 0.5).cast("int").alias("point")).agg(F.count("*").alias("n"))


@query(f"""WITH {PAIRS} SELECT count(*) AS n, count(*) FILTER (ratio BETWEEN 0.895 AND 0.905) AS at_10pct_below, count(*) FILTER (ratio BETWEEN 0.945 AND 0.955) AS at_5pct_below, count(*) FILTER (ratio BETWEEN 0.845 AND 0.855) AS at_15pct_below,
count(*) FILTER (ratio BETWEEN 0.999 AND 1.001) AS exactly_at_estimate, round(count(*) FILTER (ratio > 1) / count(*), 6) AS share_above FROM pairs""")
def a21_ratio_bands(spark, d):
    return pr.ratio_bands(plan_pairs(spark, d))


@query(f"""WITH {PAIRS}, s AS (SELECT ratio, row_number() OVER (ORDER BY ratio) - 1 AS k, count(*) OVER () AS n FROM pairs)
SELECT q, max(ratio) AS ratio FROM s, (VALUES (0.1::DOUBLE), (0.25::DOUBLE), (0.75::DOUBLE), (0.9::DOUBLE)) v(q) WHERE k = least(floor(n * q), n - 1) GROUP BY q""")
def a21_ratio_quantiles(spark, d):
    return st.quantiles(plan_pairs(spark, d), [], "ratio", [0.1, 0.25, 0.75, 0.9], "index").withColumnRenamed("quantile", "ratio")


@query(f"""WITH {PAIRS}, r AS (SELECT {RANK_SQL} AS r) SELECT planned_method, method, count(*) AS n,
CASE WHEN planned_method = method THEN 'same' WHEN any_value(r[method]) < any_value(r[planned_method]) THEN 'less_open' ELSE 'more_open' END AS change,
any_value(r[method]) = any_value(r[planned_method]) AND planned_method <> method AS equal_rank FROM pairs, r GROUP BY 1, 2""")
def a22_method_changes(spark, d):
    return pr.method_changes(plan_pairs(spark, d), RANK)


@query(f"""WITH {PAIRS}, r AS (SELECT {RANK_SQL} AS r) SELECT planned_method, method, count(*) AS n,
CASE WHEN planned_method = method THEN 'same' WHEN any_value(r[method]) < any_value(r[planned_method]) THEN 'less_open' ELSE 'more_open' END AS change,
any_value(r[method]) = any_value(r[planned_method]) AND planned_method <> method AS equal_rank FROM pairs, r GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 15""")
def a22_top_changes(spark, d):
    return pr.method_changes(plan_pairs(spark, d), RANK, top=15)


@query(f"WITH {PAIRS} SELECT tender_id, pkg_lot_id, batch, round(value - estimate, 2) AS excess FROM pairs ORDER BY round(value - estimate, 2) DESC, tender_id, pkg_lot_id, batch LIMIT 20")
def a23_top_overruns(spark, d):
    p = plan_pairs(spark, d).withColumn("excess", F.round(F.col("value") - F.col("estimate"), 2))
    return p.orderBy(F.col("excess").desc(), "tender_id", "pkg_lot_id", "batch").limit(20).select("tender_id", "pkg_lot_id", "batch", "excess")


@query(f"WITH {PAIRS}, r AS (SELECT {RANK_SQL} AS r) SELECT tender_id, pkg_lot_id, batch, value FROM pairs, r WHERE r[method] < r[planned_method] ORDER BY value DESC, tender_id, pkg_lot_id, batch LIMIT 20")
def a23_top_downgrades(spark, d):
    ranks = F.create_map(*[F.lit(x) for kv in RANK.items() for x in kv])
    p = plan_pairs(spark, d).filter(F.element_at(ranks, F.col("method")) < F.element_at(ranks, F.col("planned_method")))
    return p.orderBy(F.col("value").desc(), "tender_id", "pkg_lot_id", "batch").limit(20).select("tender_id", "pkg_lot_id", "batch", "value")


FLAGS = f"""{ONCE}, {BANS}, g AS (SELECT awarded_to FROM once SEMI JOIN bans ON bans.company = awarded_to GROUP BY 1 HAVING count(DISTINCT lower(trim(coalesce(once.district, '')))) > 5),
flags AS (SELECT company, tender_id, pkg_lot_id, signed, value, start, stop, CASE WHEN signed <= stop THEN 'violation' ELSE 'later_award' END AS kind
  FROM once JOIN bans ON company = awarded_to AND lower(once.district) = bans.district AND signed >= start WHERE awarded_to NOT IN (SELECT awarded_to FROM g))"""


@query(f"WITH {FLAGS} SELECT DISTINCT awarded_to AS company FROM g")
def j5_generic_names(spark, d):
    a = once(spark, d).withColumn("key", tx.company_key(F.col("awarded_to")))
    b = bans(spark, d).select(tx.company_key(F.col("company")).alias("key"), "company")
    return pr.generic_keys(a, b).join(b, "key").select("company").distinct()


@query(f"WITH {FLAGS} SELECT company, tender_id, pkg_lot_id, signed, value, start AS \"start\", stop AS \"end\", kind FROM flags")
def ban_flags(spark, d):
    """J4: awards that match the ban register (the flagship query)."""
    return pr.ban_flags(once(spark, d), bans(spark, d))


@query(f"WITH {FLAGS} SELECT kind, year(signed) AS year, count(*) AS n, round(sum(value), 2) AS value, count(DISTINCT company) AS n_firms FROM flags GROUP BY GROUPING SETS ((kind), (kind, year(signed)))")
def a24_flag_rollup(spark, d):
    return pr.flag_rollup(pr.ban_flags(once(spark, d), bans(spark, d)).withColumn("year", F.year("signed")))


OWNERS = "d AS (SELECT c_name AS company, lower(c_mktsegment) || ' ' || lower(n_name) || ' k' || c_custkey % 8 AS owner, c_nationkey FROM customer JOIN nation ON n_nationkey = c_nationkey)"


def owner_details(spark, d):
    c = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    owner = F.concat_ws(" ", F.lit("Md."), "c_mktsegment", "n_name", F.concat(F.lit("k"), F.col("c_custkey") % 8))
    return c.select(F.col("c_name").alias("company"), F.array(owner, F.lit("two tokens")).alias("owners"), "c_nationkey", "c_custkey")


@query(f"WITH {OWNERS} SELECT owner, list_sort(list(DISTINCT company)) AS companies FROM d GROUP BY 1 HAVING count(DISTINCT company) >= 2")
def j6_shared_owners(spark, d):
    return pr.shared_owners(owner_details(spark, d))


@query("SELECT c_custkey // 3 AS id, list_sort(list(DISTINCT lower(c_name))) AS keys FROM customer GROUP BY 1 HAVING count(DISTINCT lower(c_name)) >= 2")
def j7_id_aliases(spark, d):
    c = table(spark, d, "customer").select(F.floor(F.col("c_custkey") / 3).alias("id"), tx.company_key(F.col("c_name")).alias("key"))
    return pr.id_aliases(c, "id", "key")


@query("SELECT count(*) AS n, count(*) FILTER (c_custkey % 5 <> 0) AS n_with_owner, count(DISTINCT c_mktsegment || c_nationkey) AS n_owners, round(count(*) FILTER (c_custkey % 5 <> 0) / count(*), 6) AS coverage FROM customer")
def a25_owner_coverage(spark, d):
    c = table(spark, d, "customer").withColumn("owner", F.when(F.col("c_custkey") % 5 != 0, F.col("c_mktsegment")))
    return pr.owner_coverage(c.withColumn("person", F.concat("c_mktsegment", F.col("c_nationkey").cast("string"))), "owner", "person")


@query(f"""WITH {CONTRACTS} SELECT awarded_to, round(sum(value), 2) AS value, max(signed) AS signed, arg_min(tender_id, (-(epoch(signed::TIMESTAMP) // 86400), tender_id, pkg_lot_id)) AS tender_id FROM contracts GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 100""")
def a26_latest_samples(spark, d):
    return pr.latest_samples(contracts(spark, d), 100)


@query(f"""WITH {CONTRACTS}, o AS (SELECT entity, count(*) AS n FROM contracts GROUP BY 1), k AS (SELECT * FROM o, (VALUES ('dev'), ('own'), ('rev')) v(kind))
SELECT entity, kind, n FROM k ANTI JOIN (SELECT DISTINCT entity, 'own' AS kind FROM contracts WHERE batch % 2 = 0 AND entity LIKE '%1%') USING (entity, kind)""")
def a27_work_list(spark, d):
    c = contracts(spark, d)
    done = c.filter("batch % 2 = 0 and entity like '%1%'").select("entity", F.lit("own").alias("kind")).distinct()
    return pr.work_list(c, "entity", ["dev", "own", "rev"], done)


for _kind, _rank in {"floor": "floor(0.95 * (n - 1))", "index": "least(floor(n * 0.95), n - 1)", "upper": "floor(n / 2)"}.items():

    def _quantile(spark, d, kind=_kind):
        return st.quantile(contracts(spark, d), ["ministry"], "value", 0.95, kind)

    _quantile.__name__ = f"q_{_kind}"
    query(f"WITH {CONTRACTS}, s AS (SELECT ministry, value, row_number() OVER (PARTITION BY ministry ORDER BY value) - 1 AS k, count(*) OVER (PARTITION BY ministry) AS n FROM contracts) SELECT ministry, value AS quantile FROM s WHERE k = {_rank.replace('0.95', '0.95::DOUBLE')}")(_quantile)


@query(f"WITH {CONTRACTS} SELECT ministry, round(quantile_cont(value, 0.95), 6) AS quantile FROM contracts GROUP BY 1")
def q_interpolated(spark, d):
    return st.quantile(contracts(spark, d), ["ministry"], "value", 0.95, "interpolated").withColumn("quantile", F.round("quantile", 6))
