"""Registry of queries, and test-table stand-ins in both languages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordscope.sources.io import owned

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    """Registers a function of (spark, sf_dir) under its name, with DuckDB SQL for the same rows."""

    def add(f):
        QUERIES[f.__name__] = owned(f)
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def contracts(spark: SparkSession, d: str) -> DataFrame:
    """Line items as contract awards; repeated (tender_id, pkg_lot_id) rows are repeated batches."""
    t = lambda n: table(spark, d, n)
    cn = t("nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("cn"))
    sn = t("nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("sn"), F.col("n_regionkey").alias("r_regionkey"))
    supplier = t("supplier").join(sn, "s_nationkey").join(t("region"), "r_regionkey").select(F.col("s_suppkey").alias("l_suppkey"), "sn", "r_name")
    # parts, customers and orders grow with the lines, so they meet by sorted shuffles; orders come last, whose keys group the contracts
    orders = t("orders").join(t("customer").join(cn, "c_nationkey").hint("merge"), F.col("o_custkey") == F.col("c_custkey"))
    orders = orders.select(F.col("o_orderkey").alias("l_orderkey"), "c_custkey", "c_name", "cn", "o_orderpriority")
    part = t("part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    rows = t("lineitem").join(part.hint("merge"), "l_partkey").join(orders.hint("merge"), "l_orderkey").join(supplier, "l_suppkey")
    return rows.select(
        F.col("l_orderkey").alias("tender_id"), F.col("l_linenumber").alias("pkg_lot_id"), F.col("l_partkey").alias("package_ref"), F.col("l_suppkey").alias("batch"),
        F.col("r_name").alias("ministry"), F.col("p_brand").alias("entity"), F.col("o_orderpriority").alias("method"), F.to_date("l_shipdate").alias("signed"), F.col("c_name").alias("awarded_to"),
        F.when(F.col("c_custkey") % 4 == 0, F.col("sn")).otherwise(F.col("cn")).alias("district"), F.col("l_extendedprice").alias("value"),
    )


CONTRACTS = """contracts AS (
  SELECT l_orderkey AS tender_id, l_linenumber AS pkg_lot_id, l_partkey AS package_ref, l_suppkey AS batch, r_name AS ministry, p_brand AS entity, o_orderpriority AS method,
    l_shipdate::DATE AS signed, c_name AS awarded_to, CASE WHEN c_custkey % 4 = 0 THEN sn.n_name ELSE cn.n_name END AS district, l_extendedprice AS value
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN nation cn ON cn.n_nationkey = c_nationkey
  JOIN supplier ON s_suppkey = l_suppkey JOIN nation sn ON sn.n_nationkey = s_nationkey JOIN region ON r_regionkey = sn.n_regionkey JOIN part ON p_partkey = l_partkey)"""

#: Order that makes "first" well defined among repeated keys.
FIRST = ["signed", "batch", "package_ref", "value"]
ONCE = CONTRACTS + """, once AS (
  SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY tender_id, pkg_lot_id ORDER BY signed, batch, package_ref, value) AS k FROM contracts) WHERE k = 1)"""


def bans(spark: SparkSession, d: str) -> DataFrame:
    """Some customers as a ban register, with the district at the end of an address."""
    c = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    start = F.date_add(F.lit("1996-01-01").cast("date"), ((F.col("c_custkey") % 5) * 180).cast("int"))
    rows = c.filter((F.col("c_custkey") % 3 == 0) | (F.col("c_custkey") % 4 == 0)).withColumn("start", start)
    end = F.date_add("start", (365 + (F.col("c_custkey") % 3) * 365).cast("int"))
    return rows.select(F.col("c_name").alias("company"), F.concat(F.lit("1 Road, Area, "), "n_name", F.lit(". ")).alias("address"), "start", end.alias("end"), F.col("c_mktsegment").alias("reason"))


BANS = """bans AS (
  SELECT c_name AS company, lower(n_name) AS district, DATE '1996-01-01' + (c_custkey % 5 * 180)::INT AS start, DATE '1996-01-01' + (c_custkey % 5 * 180 + 365 + c_custkey % 3 * 365)::INT AS stop, c_mktsegment AS reason
  FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE c_custkey % 3 = 0 OR c_custkey % 4 = 0)"""


def plans(spark: SparkSession, d: str) -> DataFrame:
    """Parts as plan items: reference, estimate, planned method."""
    p = table(spark, d, "part")
    method = F.element_at(F.array(*[F.lit(x) for x in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")]), (F.col("p_size") % 5 + 1).cast("int"))
    return p.select(F.concat(F.lit(" PKG-"), F.col("p_partkey").cast("string")).alias("package_no"), (F.col("p_retailprice") * 60).alias("estimate"), method.alias("planned_method"), F.col("p_name").alias("name"))


PLANS = """plans AS (
  SELECT 'pkg-' || p_partkey AS ref, p_retailprice * 60 AS estimate, ['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'][p_size % 5 + 1] AS planned_method, p_name AS name FROM part)"""


def hourly(spark: SparkSession, d: str) -> DataFrame:
    """Events by hour as grid readings: supply from views and clicks, shed load from errors."""
    e = table(spark, d, "events").groupBy(F.date_trunc("hour", "ts").alias("datetime")).agg(
        F.round(F.sum(F.when(F.col("event_type").isin("view", "click"), F.col("value"))), 2).alias("supply"),
        F.round(F.sum(F.when(F.col("event_type") == "error", F.col("value"))), 2).alias("loadshed"),
    )
    return e.select("datetime", F.to_date("datetime").alias("date"), F.hour("datetime").alias("hour"), F.round(F.col("supply") + F.coalesce("loadshed", F.lit(0.0)), 2).alias("demand"), "supply", "loadshed")


HOURLY = """hourly AS (
  SELECT datetime, datetime::DATE AS date, hour(datetime) AS hour, round(supply + coalesce(loadshed, 0), 2) AS demand, supply, loadshed FROM (
    SELECT date_trunc('hour', ts) AS datetime, round(sum(value) FILTER (event_type IN ('view', 'click')), 2) AS supply, round(sum(value) FILTER (event_type = 'error'), 2) AS loadshed FROM events GROUP BY 1))"""


def zone_days(spark: SparkSession, d: str) -> DataFrame:
    """Line items by ship date and supplier region as zone readings; population is the region's number of customers."""
    t = lambda n: table(spark, d, n)
    region = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.col("r_name").alias("zone"))
    people = t("customer").join(region, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("zone").agg(F.count("*").alias("population"))
    supplier = t("supplier").join(region, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("l_suppkey"), "zone")
    price = F.col("l_extendedprice")
    rows = t("lineitem").join(supplier, "l_suppkey").groupBy(F.to_date("l_shipdate").alias("date"), "zone").agg(F.round(F.sum(price), 2).alias("demand"), F.round(F.sum(price * F.col("l_discount")), 4).alias("shed"))
    return rows.join(people, "zone").select("date", "zone", "demand", "shed", "population")


ZONES = """zones AS (
  SELECT date, zone, demand, shed, population FROM (
    SELECT l_shipdate::DATE AS date, r_name AS zone, round(sum(l_extendedprice), 2) AS demand, round(sum(l_extendedprice * l_discount), 4) AS shed
    FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY 1, 2)
  JOIN (SELECT r_name AS zone, count(*) AS population FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY 1) USING (zone))"""


def line_days(spark: SparkSession, d: str) -> DataFrame:
    """All zones of a date together."""
    return zone_days(spark, d).groupBy("date").agg(F.round(F.sum("demand"), 2).alias("demand"), F.round(F.sum("shed"), 4).alias("shed"))


DAYS = ZONES + ", days AS (SELECT date, round(sum(demand), 2) AS demand, round(sum(shed), 4) AS shed FROM zones GROUP BY 1)"


def fuel_days(spark: SparkSession, d: str) -> DataFrame:
    """Line items by date and return flag as fuels: energy, cost and the date's stated unit cost and energy."""
    rows = table(spark, d, "lineitem").groupBy(F.to_date("l_shipdate").alias("date"), F.col("l_returnflag").alias("fuel")).agg(F.sum("l_quantity").alias("energy"), F.round(F.sum("l_extendedprice"), 2).alias("cost"))
    every = rows.groupBy("date").agg(F.round(F.sum("cost") / F.sum("energy") * F.when(F.dayofmonth("date") % 5 == 0, 1.2).otherwise(1.0), 6).alias("stated"), F.sum("energy").alias("stated_energy"))
    return rows.join(every, "date")


FUELS = """f AS (SELECT l_shipdate::DATE AS date, l_returnflag AS fuel, sum(l_quantity) AS energy, round(sum(l_extendedprice), 2) AS cost FROM lineitem GROUP BY 1, 2),
fuels AS (SELECT * FROM f JOIN (SELECT date, round(sum(cost) / sum(energy) * CASE WHEN day(date) % 5 = 0 THEN 1.2::DOUBLE ELSE 1.0::DOUBLE END, 6) AS stated, sum(energy) AS stated_energy FROM f GROUP BY 1) USING (date))"""
