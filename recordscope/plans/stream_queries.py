"""Incremental jobs replayed over batches of the test tables, with SQL for their end state."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from recordscope.plans.base import DAYS, line_days, query, table
from recordscope.plans.region_queries import IN_SQUARE, MISREAD, MISSED, MONTH_SHEETS, misread_sheets, month_sheets, sheet_rules
from recordscope.sources.io import shared_dir
from recordscope.streaming import jobs


@query("SELECT l_orderkey, l_linenumber, min(l_shipdate)::DATE AS signed FROM lineitem WHERE NOT (l_suppkey % 2 = 1 AND (l_orderkey, l_linenumber) IN (SELECT (l_orderkey, l_linenumber) FROM lineitem WHERE l_suppkey % 2 = 0)) GROUP BY 1, 2")
def t1_unseen(spark, d):
    l = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("signed"), "l_suppkey")  # noqa: E741
    key = ["l_orderkey", "l_linenumber"]
    first = jobs.unseen(l.filter("l_suppkey % 2 = 0"), l.limit(0), key, ["signed"])
    return first.unionByName(jobs.unseen(l.filter("l_suppkey % 2 = 1"), first, key, ["signed"])).select(*key, "signed")


@query(f"WITH {DAYS} SELECT date, CASE WHEN day(date) % 2 = 0 THEN demand ELSE demand + 1 END AS demand, CASE WHEN day(date) % 3 = 0 THEN -1 ELSE shed END AS shed FROM days")
def t2_filled(spark, d):
    day = line_days(spark, d)
    old = day.withColumn("demand", F.when(F.dayofmonth("date") % 2 == 0, F.col("demand")))
    new = day.withColumn("demand", F.col("demand") + 1).withColumn("shed", F.when(F.dayofmonth("date") % 3 == 0, F.lit(-1.0)))
    return jobs.fill_nulls(old, new, ["date"], ["demand", "shed"], ["shed"])


@query("SELECT o_custkey, min((year(o_orderdate) - 1900) // 3)::INT AS bucket FROM orders GROUP BY 1")
def t1_first_seen(spark, d):
    """Orders arrive as one batch for three years; a customer is new once, also where a later batch brings another bucket."""
    o = table(spark, d, "orders").select("o_custkey", F.to_timestamp("o_orderdate").alias("at"), F.floor((F.year("o_orderdate") - 1900) / 3).cast("int").alias("bucket"))
    top = f"{shared_dir(spark)}/first-seen-{uuid.uuid4().hex}"
    batches = sorted(r["bucket"] for r in o.select("bucket").distinct().collect())
    for k in batches:
        o.filter(F.col("bucket") == k).coalesce(1).write.parquet(f"{top}/in/{k}")
    stream = spark.readStream.schema(o.schema).option("maxFilesPerTrigger", 1).parquet(f"{top}/in/*")
    jobs.first_seen_stream(stream, f"{top}/table", f"{top}/state", ["o_custkey"], "at", "36500 days", "bucket").awaitTermination()
    return spark.read.schema("o_custkey long, at timestamp, bucket int").parquet(f"{top}/table").select("o_custkey", "bucket")


@query(f"WITH {DAYS}, b AS (SELECT max(date) - 20 AS f FROM days) SELECT date, CASE WHEN date >= f THEN 0 ELSE demand END AS demand FROM days, b WHERE date < f OR day(date) % 2 = 0 OR date = f + 20")
def t4_trailing(spark, d):
    day = line_days(spark, d).select("date", "demand")
    newest = day.agg(F.max("date").alias("m"))
    new = day.join(F.broadcast(newest)).filter((F.dayofmonth("date") % 2 == 0) | (F.col("date") == F.col("m"))).select("date", F.lit(0.0).alias("demand"))
    return jobs.replace_trailing(day, new, "date", 21)


@query(f"""WITH {MONTH_SHEETS}, b AS (SELECT *, CASE WHEN NOT {MISSED} AND NOT (m % 5 = 0 AND sheet < '3' AND {IN_SQUARE}) THEN value + {MISREAD} END AS read, m % 5 <> 3 AND NOT (m % 5 = 0 AND sheet < '3') AS good FROM cells)
SELECT sheet, sum(CASE WHEN good THEN value ELSE read END)::BIGINT AS total, count(CASE WHEN good THEN value ELSE read END) AS known, good AS published FROM b GROUP BY sheet, good""")
def t5_gate(spark, d):
    square = (F.col("m") % 5 == 0) & (F.col("sheet") < "3") & F.expr(IN_SQUARE.replace('"', ""))
    gone = month_sheets(spark, d).filter(square).select("sheet", "row", "col")
    good, review = jobs.gate(misread_sheets(spark, d).join(gone, ["sheet", "row", "col"], "left_anti"), sheet_rules(spark))
    total = lambda df, p: df.groupBy("sheet").agg(F.sum("value").alias("total"), F.count("value").alias("known")).withColumn("published", F.lit(p))
    return total(good, True).unionByName(total(review, False))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice * 2 ELSE o_totalprice END AS price FROM orders")
def t6_replaced(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"))
    again = o.filter("o_orderkey % 3 = 0")
    new = again.unionByName(again.withColumn("price", F.col("price") * 2))
    return jobs.replace_keys(o, new, ["o_orderkey"], ["price"])


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 20 = 0)")
def t7_still_to_do(spark, d):
    return jobs.still_to_do(table(spark, d, "customer").select("c_custkey"), table(spark, d, "orders").filter("o_orderkey % 20 = 0").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])
