"""Readers and writers: test tables written in a published form, read back, and compared with SQL over the tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordscope.plans.base import query, table
from recordscope.sources import io

NUMBER, TEXT = T.DoubleType(), T.StringType()


def folder(spark, name):
    return f"{io.shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def as_files(df, spark, name, key):
    """One text file for each value of ``key`` with the other column as its content; the key is in the path."""
    path = folder(spark, name)
    df.repartition(key).write.partitionBy(key).text(path)
    return path


def struct(**fields):
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


@query("SELECT o_orderkey AS id, o_totalprice AS price FROM orders WHERE o_orderkey % 50 <> 3")
def s1_batches(spark, d):
    path, k = folder(spark, "batches"), F.col("o_orderkey")
    line = F.to_json(F.struct(k.alias("id"), F.col("o_totalprice").alias("price")))
    table(spark, d, "orders").select(F.when(k % 50 == 3, F.substring(line, 1, 9)).otherwise(line).alias("value")).write.text(path, compression="gzip")
    return io.read_batches(spark, path, struct(id=T.LongType(), price=NUMBER), pattern="*.txt*").select("id", "price")


@query("SELECT count(*) AS n, min(left(line, 6)) AS line FROM (SELECT left('{\"id\":' || o_orderkey, 9) AS line FROM orders WHERE o_orderkey % 50 = 3)")
def s1_broken_lines(spark, d):
    path, k = folder(spark, "batches"), F.col("o_orderkey")
    line = F.to_json(F.struct(k.alias("id"), F.col("o_totalprice").alias("price")))
    table(spark, d, "orders").select(F.when(k % 50 == 3, F.substring(line, 1, 9)).otherwise(line).alias("value")).write.text(path)
    return io.broken_lines(spark, path, struct(id=T.LongType(), price=NUMBER), "*.txt*").agg(F.count("*").alias("n"), F.min(F.substring("line", 1, 6)).alias("line"))


@query("SELECT CASE WHEN o_orderkey % 9 = 0 THEN 'unknown' ELSE year(o_orderdate)::VARCHAR END AS bucket, o_orderkey AS id, o_totalprice AS price FROM orders")
def s2_buckets(spark, d):
    year = F.when(F.col("o_orderkey") % 9 == 0, "unknown").otherwise(F.year("o_orderdate").cast("string"))
    rows = table(spark, d, "orders").select(year.alias("year"), F.struct(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price")).alias("r"))
    files = rows.groupBy("year").agg(F.to_json(F.collect_list("r")).alias("value"))
    path = as_files(files, spark, "buckets", "year")
    return io.read_buckets(spark, path, struct(id=T.LongType(), price=NUMBER), "*.txt", r"year=([^/]+)/").select("bucket", "id", "price")


@query("SELECT event_id, ts AS at, value FROM events WHERE event_id % 10 <> 0")
def s3_time_series(spark, d):
    path, at = folder(spark, "series"), F.when(F.col("event_id") % 10 == 0, F.col("ts") - F.expr("INTERVAL 100 YEARS")).otherwise(F.col("ts"))
    table(spark, d, "events").select("event_id", at.cast("string").alias("at"), "value").write.option("header", True).csv(path)
    return io.read_time_series(spark, path, struct(event_id=T.LongType(), at=T.TimestampType(), value=NUMBER), "at")


DAY_FLAGS = "f AS (SELECT l_shipdate::DATE AS date, l_returnflag AS flag, round(sum(l_quantity), 2) AS q FROM lineitem GROUP BY 1, 2)"


def flag_maps(spark, d):
    per = table(spark, d, "lineitem").groupBy(F.to_date("l_shipdate").alias("date"), F.col("l_returnflag").alias("flag")).agg(F.round(F.sum("l_quantity"), 2).alias("q"))
    return per.groupBy("date").agg(F.map_from_entries(F.collect_list(F.struct("flag", "q"))).alias("m"))


@query(f"WITH {DAY_FLAGS} SELECT date::VARCHAR AS date, flag, q FROM f WHERE month(date) <> 4")
def s4_reports(spark, d):
    report = F.struct(F.col("date").cast("string").alias("date"), (F.month("date") == 4).alias("failed"), F.col("m").alias("flags"))
    # a file holds the reports of a month
    month = flag_maps(spark, d).groupBy(F.date_format("date", "yyyy-MM").alias("k")).agg(F.to_json(F.collect_list(report)).alias("value"))
    path = as_files(month, spark, "reports", "k")
    schema = struct(date=TEXT, failed=T.BooleanType(), flags=T.MapType(TEXT, NUMBER))
    return io.read_reports(spark, path, schema).select("date", F.explode("flags").alias("flag", "q"))


@query(f"WITH {DAY_FLAGS} SELECT date::VARCHAR AS date, sum(q) FILTER (flag = 'A') AS a, sum(q) FILTER (flag = 'N') AS n FROM f GROUP BY 1")
def s5_keyed(spark, d):
    """Files by year; each also repeats days of the year before with other values, which the older file's do not survive."""
    day = flag_maps(spark, d)
    said = day.select(F.col("date").cast("string").alias("date"), F.year("date").alias("y"), F.struct(F.col("m")["A"].alias("a"), F.col("m")["N"].alias("n")).alias("v"))
    stale = said.withColumn("y", F.col("y") - 1).withColumn("v", F.struct(F.lit(-1.0).alias("a"), F.lit(-1.0).alias("n")))
    files = said.unionByName(stale).groupBy("y").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("date", "v")))).alias("value"))
    path = as_files(files, spark, "keyed", "y")
    return io.read_keyed(spark, path, struct(a=NUMBER, n=NUMBER)).select("date", "a", "n")


@query("""WITH c AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderpriority AS unit, count(*) FILTER (o_orderstatus = 'F')::INT AS f, count(*) FILTER (o_orderstatus = 'O')::INT AS o FROM orders GROUP BY 1, 2)
SELECT month, unit, 'f' AS "column", f AS value FROM c UNION ALL SELECT month, unit, 'o', o FROM c""")
def s6_sheets(spark, d):
    o = table(spark, d, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.col("o_orderpriority").alias("unit"))
    per = o.agg(F.array(F.count_if(F.col("o_orderstatus") == "F"), F.count_if(F.col("o_orderstatus") == "O"), F.lit(-1).cast("long")).alias("v"))
    files = per.groupBy("month").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("unit", "v")))).alias("value"))
    path = as_files(files, spark, "sheets", "month")
    return io.read_sheets(spark, path, ["f", "o"], "*.txt", r"month=(\d{4}-\d{2})/")


@query("SELECT c_custkey, c_name, true AS listed FROM customer")
def s8_optional(spark, d):
    path, schema = folder(spark, "side"), struct(c_custkey=T.LongType(), c_name=TEXT)
    absent = io.read_optional(spark, f"{path}-none", schema).withColumn("listed", F.lit(False))
    table(spark, d, "customer").select("c_custkey", "c_name").write.option("header", True).csv(path)
    return io.read_optional(spark, path, schema).withColumn("listed", F.lit(True)).unionByName(absent)


@query("SELECT CASE WHEN o_orderkey % 9 = 0 THEN 'unknown' ELSE year(o_orderdate)::VARCHAR END AS year, count(*) AS n, sum(o_custkey)::BIGINT AS s FROM orders GROUP BY 1")
def k1_buckets(spark, d):
    path = folder(spark, "by-year")
    io.write_buckets(table(spark, d, "orders").select("o_custkey", F.when(F.col("o_orderkey") % 9 != 0, F.year("o_orderdate")).alias("year")), path)
    return spark.read.option("partitionInferTypeEnabled", False).schema("o_custkey long, year string").parquet(path).groupBy("year").agg(F.count("*").alias("n"), F.sum("o_custkey").alias("s"))


@query("SELECT year(o_orderdate)::VARCHAR AS year, CASE WHEN year(o_orderdate) = 1997 THEN count(*) FILTER (o_orderkey % 2 = 0) ELSE count(*) END AS n FROM orders GROUP BY year(o_orderdate)")
def k2_rewritten_bucket(spark, d):
    path = folder(spark, "by-year")
    rows = table(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").cast("string").alias("year"))
    io.write_buckets(rows, path)
    io.rewrite_buckets(rows.filter("year = '1997' and o_orderkey % 2 = 0"), path, "year")
    return spark.read.schema("o_orderkey long, year string").parquet(path).groupBy("year").agg(F.count("*").alias("n"))


@query("""WITH c AS (SELECT o_orderkey, ['valid', 'unknown', 'invalid'][o_custkey % 3 + 1] AS class FROM orders)
SELECT 'clean' AS form, count(*) AS n, sum(o_orderkey)::BIGINT AS s FROM c WHERE class = 'valid' UNION ALL SELECT 'with_unknown', count(*), sum(o_orderkey)::BIGINT FROM c WHERE class <> 'invalid' UNION ALL SELECT 'all', count(*), sum(o_orderkey)::BIGINT FROM c""")
def k4_forms(spark, d):
    path = folder(spark, "export")
    rows = table(spark, d, "orders").select("o_orderkey", F.get(F.array(*[F.lit(x) for x in ("valid", "unknown", "invalid")]), (F.col("o_custkey") % 3).cast("int")).alias("class"))
    io.export_forms(rows, path)
    total = lambda df, form: df.agg(F.lit(form).alias("form"), F.count("*").alias("n"), F.sum("o_orderkey").alias("s"))
    # the clean form is read from its CSV, the others from their Parquet files
    clean = spark.read.schema("o_orderkey long, class string").option("header", True).csv(f"{path}/clean_csv")
    parquet = lambda form: spark.read.schema("o_orderkey long, class string").parquet(f"{path}/{form}")
    return total(clean, "clean").unionByName(total(parquet("with_unknown"), "with_unknown")).unionByName(total(parquet("all"), "all"))


@query("""WITH c AS (SELECT o_orderstatus AS gender, year(o_orderdate) AS year, month(o_orderdate) AS month, count(*) AS n FROM orders GROUP BY ALL)
SELECT gender, list(year ORDER BY year, month) AS year, list(month ORDER BY year, month) AS month, list(n ORDER BY year, month) AS n FROM c GROUP BY 1""")
def k5_packed_cube(spark, d):
    o = table(spark, d, "orders").groupBy(F.col("o_orderstatus").alias("gender"), F.year("o_orderdate").cast("long").alias("year"), F.month("o_orderdate").cast("long").alias("month")).agg(F.count("*").alias("n"))
    return io.pack_parallel(o, ["year", "month", "n"], ["gender"])


@query("SELECT o_orderkey AS id, o_custkey AS customer, o_totalprice AS price FROM orders WHERE o_totalprice > 1000")
def s7_database(spark, d):
    """Writes all orders as a crawl database of SQLite shards, keys crowded at one end, and reads them back by ranges of equal rows."""
    path = folder(spark, "database")
    orders = table(spark, d, "orders").select((F.col("o_orderkey") * F.col("o_orderkey")).alias("id"), F.col("o_orderkey").alias("orderkey"), F.col("o_custkey").alias("customer"), F.col("o_totalprice").alias("price"))
    io.write_sqlite(orders, path, "orders", "id")
    rows = io.read_sqlite(spark, path, "SELECT id, orderkey, customer, price FROM orders WHERE price > 1000", struct(orderkey=T.LongType(), customer=T.LongType(), price=NUMBER), "id")
    return rows.select(F.col("orderkey").alias("id"), "customer", "price")
