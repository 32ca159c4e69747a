"""Text and date functions over columns of the test tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordscope.functions import dates as dt
from recordscope.functions import text as tx
from recordscope.operators import extract as ex
from recordscope.plans.base import query, table


def customers(spark, d):
    return table(spark, d, "customer").withColumn("k", F.col("c_custkey") % 7)


FORM = "c_name || CASE c_custkey % 7 WHEN 0 THEN ' Co., Ltd.' WHEN 1 THEN '  (Pvt) LIMITED' WHEN 2 THEN ' Company' ELSE '' END"


@query(rf"""WITH f AS (SELECT c_custkey, {FORM} AS name FROM customer), n AS (SELECT c_custkey, trim(regexp_replace(regexp_replace(regexp_replace(lower(name), '[.,]', '', 'g'), '\b(ltd|limited|pvt|private|co|company|m/s)\b', '', 'g'), '\s+', ' ', 'g')) AS k FROM f)
SELECT c_custkey, CASE WHEN length(k) >= 4 THEN k ELSE '' END AS "key" FROM n""")
def c1_company_key(spark, d):
    k = F.col("k")
    name = F.concat("c_name", F.when(k == 0, " Co., Ltd.").when(k == 1, "  (Pvt) LIMITED").when(k == 2, " Company").otherwise(""))
    return customers(spark, d).select("c_custkey", tx.company_key(name).alias("key"))


@query(r"""WITH f AS (SELECT c_custkey, regexp_replace(regexp_replace(trim(lower(['Md. ', 'DR ', 'Engr.  ', ''][c_custkey % 4 + 1] || c_mktsegment || '  ' || 'A' || c_nationkey || ' ' || c_name)), '\s+', ' ', 'g'), '^(md|mr|mrs|ms|dr|mohammad|mohammed|engr|eng)\.?\s+', '') AS "key" FROM customer)
SELECT c_custkey, "key", len(string_split("key", ' ')) >= 3 AS usable FROM f""")
def c2_owner_key(spark, d):
    title = F.element_at(F.array(*[F.lit(x) for x in ("Md. ", "DR ", "Engr.  ", "")]), (F.col("c_custkey") % 4 + 1).cast("int"))
    key = tx.owner_key(F.concat(title, "c_mktsegment", F.lit("  A"), F.col("c_nationkey").cast("string"), F.lit(" "), "c_name"))
    return customers(spark, d).select("c_custkey", key.alias("key"), tx.has_tokens(key).alias("usable"))


@query("SELECT lower(trim('  ' || coalesce(p_brand, '') || ' ')) AS ref, count(*) AS n FROM part GROUP BY 1")
def c3_reference_key(spark, d):
    return table(spark, d, "part").groupBy(tx.reference_key(F.concat(F.lit("  "), "p_brand", F.lit(" "))).alias("ref")).agg(F.count("*").alias("n"))


@query("""SELECT CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderdate::DATE END AS date, CASE WHEN o_orderkey % 11 = 0 THEN 'unknown' ELSE year(o_orderdate)::VARCHAR END AS year, count(*) AS n FROM orders GROUP BY 1, 2""")
def c4_c5_published(spark, d):
    said = F.when(F.col("o_orderkey") % 11 == 0, F.lit("on 31-Feb-2020")).otherwise(F.concat(F.lit("Published on "), F.upper(F.date_format("o_orderdate", "dd-MMM-yyyy")), F.lit(" 10:00")))
    o = table(spark, d, "orders").withColumn("said", said)
    return o.groupBy(dt.parse_dmy(F.col("said")).alias("date"), dt.publication_year(F.col("said")).alias("year")).agg(F.count("*").alias("n"))


@query("""SELECT c_custkey, round(CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_acctbal END * 1e7, 2) AS units, round(CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_acctbal END, 2) AS amount FROM customer""")
def c6_amounts(spark, d):
    raw = F.when(F.col("c_custkey") % 13 == 0, F.lit("n/a")).otherwise(F.col("c_acctbal").cast("string"))
    return customers(spark, d).select("c_custkey", tx.crore_to_units(raw).alias("units"), tx.amount(raw).alias("amount"))


@query("SELECT 'Ministry of ' || p_type AS ministry, count(*) AS n FROM part GROUP BY 1")
def c7_ministry(spark, d):
    said = F.concat(F.lit("Ministry of "), "p_type", F.when(F.col("p_partkey") % 2 == 0, " and").otherwise(" "))
    return table(spark, d, "part").groupBy(tx.clean_ministry(said).alias("ministry")).agg(F.count("*").alias("n"))


@query(r"""SELECT doc_id, CASE WHEN length(text) > 160 THEN CASE WHEN contains(left(text, 160), ' ') THEN regexp_replace(left(text, 160), ' [^ ]*$', '') ELSE left(text, 160) END || '…' ELSE text END AS title FROM documents""")
def c8_truncate(spark, d):
    return table(spark, d, "documents").select("doc_id", tx.truncate_words(F.col("text")).alias("title"))


@query("""SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN NULL ELSE c_acctbal END AS number FROM customer""")
def c9_tolerant_number(spark, d):
    said = F.when(F.col("c_custkey") % 5 == 0, "--").otherwise(F.concat(F.lit("MW "), tx.bengali_digits(F.format_number("c_acctbal", 2)), F.lit(" at 7")))
    return customers(spark, d).select("c_custkey", tx.tolerant_number(said).alias("number"))


@query("""SELECT c_custkey, CASE c_custkey % 7 WHEN 0 THEN 111 WHEN 1 THEN CASE WHEN c_nationkey = 0 THEN 0 END WHEN 3 THEN NULL ELSE c_nationkey END::BIGINT AS value,
CASE c_custkey % 7 WHEN 0 THEN 'scan Il| counts as 111' WHEN 1 THEN CASE WHEN c_nationkey = 0 THEN NULL ELSE 'no count below zero: -' || c_nationkey END WHEN 2 THEN 'scan . ' || c_nationkey || '- counts as ' || c_nationkey END AS note FROM customer""")
def c10_scanned_count(spark, d):
    n, k = F.col("c_nationkey").cast("string"), F.col("k")
    raw = F.when(k == 0, F.lit("Il|")).when(k == 1, F.concat(F.lit("-"), n)).when(k == 2, F.concat(F.lit(". "), n, F.lit("-"))).when(k == 3, F.lit(" nan ")).otherwise(F.concat(n, F.lit(".0")))
    r = tx.repaired_count(raw)
    return customers(spark, d).select("c_custkey", r["value"].alias("value"), r["note"].alias("note"))


@query("SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders GROUP BY 1")
def c12_month_label(spark, d):
    return table(spark, d, "orders").groupBy(dt.month_label(F.date_format("o_orderdate", "MMM-yy"), 1970).alias("month")).agg(F.count("*").alias("n"))


@query("""WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate::DATE AS listing, CASE WHEN l_partkey % 3 = 0 THEN l_shipdate::DATE - (l_partkey % 9)::INT ELSE (l_shipdate::DATE - (l_partkey % 9)::INT) - INTERVAL 1 YEAR END::DATE AS report FROM lineitem),
m AS (SELECT *, try_cast(year(listing) || '-' || lpad(month(report)::VARCHAR, 2, '0') || '-' || lpad(day(report)::VARCHAR, 2, '0') AS DATE) AS moved FROM l)
SELECT CASE WHEN listing - report BETWEEN 0 AND 5 THEN report WHEN listing - moved BETWEEN 0 AND 5 THEN moved END AS date, count(*) AS n FROM m GROUP BY 1""")
def c16_repaired_year(spark, d):
    l = table(spark, d, "lineitem").withColumn("listing", F.to_date("l_shipdate"))  # noqa: E741
    near = F.date_sub("listing", (F.col("l_partkey") % 9).cast("int"))
    report = F.when(F.col("l_partkey") % 3 == 0, near).otherwise(F.add_months(near, -12))
    return l.groupBy(dt.repair_year(report, F.col("listing")).alias("date")).agg(F.count("*").alias("n"))


@query("""WITH l AS (SELECT l_shipdate::DATE AS report, (l_partkey % 31 + 1)::INT AS day, (l_suppkey % 12 + 1)::INT AS month FROM lineitem),
m AS (SELECT *, year(report) - CASE WHEN month > month(report) THEN 1 ELSE 0 END AS y FROM l)
SELECT coalesce(try_cast(y || '-' || lpad(month::VARCHAR, 2, '0') || '-' || lpad(day::VARCHAR, 2, '0') AS DATE), report - 1) AS date, count(*) AS n FROM m GROUP BY 1""")
def c17_actual_date(spark, d):
    l = table(spark, d, "lineitem")  # noqa: E741
    day, month = (F.col("l_partkey") % 31 + 1).cast("int"), (F.col("l_suppkey") % 12 + 1).cast("int")
    return l.groupBy(dt.actual_date(day, month, F.to_date("l_shipdate")).alias("date")).agg(F.count("*").alias("n"))


@query("""SELECT doc_id, CASE WHEN len(t) = 0 THEN ['unspecified'] ELSE t END AS tags FROM (SELECT doc_id, list_filter([CASE WHEN contains(lower(text), 'idiot') OR contains(lower(text), 'moron') THEN 'insult' END, CASE WHEN contains(lower(text), 'licensed') THEN 'licence' END, CASE WHEN contains(lower(text), 'token') THEN 'token' END], lambda x: x IS NOT NULL) AS t FROM documents)""")
def c19_tags(spark, d):
    rules = (("insult", ("idiot", "moron")), ("licence", ("licensed",)), ("token", ("token",)))
    return table(spark, d, "documents").select("doc_id", tx.tags(F.col("text"), rules).alias("tags"))


@query("""SELECT p_partkey, CASE WHEN contains(lower(p_name), 'ring') THEN 4 WHEN contains(lower(p_type), 'econ') THEN 3 ELSE 1 END AS score, CASE WHEN contains(lower(p_name), 'ring') THEN 'Ring' WHEN contains(lower(p_type), 'econ') THEN 'Economy' ELSE 'Unspecified' END AS label FROM part""")
def c20_scope(spark, d):
    s = tx.scope(F.col("p_name"), F.col("p_type"), (("RING", 4, "Ring"), ("Econ", 3, "Economy")))
    return table(spark, d, "part").select("p_partkey", s["score"].alias("score"), s["label"].alias("label"))


CAUSE_SAYS = ("Gas  shortage since June", "under overhaul", "No Fuel (HFO)", "bearing fault", "-", "stand by", "unclear", "contract expired")


@query("""SELECT ['gas_shortage', 'maintenance', 'fuel_shortage', 'fault', 'none', 'not_needed', 'other', 'contract_ended'][o_orderkey % 8 + 1] AS cause, count(*) AS n FROM orders GROUP BY 1""")
def c22_cause(spark, d):
    said = F.element_at(F.array(*[F.lit(s) for s in CAUSE_SAYS]), (F.col("o_orderkey") % 8 + 1).cast("int"))
    return table(spark, d, "orders").groupBy(tx.cause(said).alias("cause")).agg(F.count("*").alias("n"))


@query("SELECT n_name AS place, count(*) AS n FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1")
def c27_place_name(spark, d):
    c = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    said = F.concat("n_name", F.element_at(F.array(*[F.lit(x) for x in (" District", " জেলা", " City Corporation ", "")]), (F.col("c_custkey") % 4 + 1).cast("int")))
    return c.groupBy(tx.place_name(said).alias("place")).agg(F.count("*").alias("n"))


@query("SELECT lower(n_name) AS district, count(*) AS n FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1")
def c29_address_tail(spark, d):
    c = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    return c.groupBy(tx.address_tail(F.concat(F.lit("House 1, "), "c_name", F.lit(", "), "n_name", F.lit(" . "))).alias("district")).agg(F.count("*").alias("n"))


@query("""WITH f AS (SELECT month(o_orderdate) AS m, CASE WHEN month(o_orderdate) >= 7 THEN year(o_orderdate) ELSE year(o_orderdate) - 1 END AS s, year(o_orderdate) AS y FROM orders)
SELECT 'FY' || s || '-' || lpad(((s + 1) % 100)::VARCHAR, 2, '0') AS fiscal_year, m AS month, y AS year, count(*) AS n FROM f GROUP BY 1, 2, 3""")
def c30_fiscal_year(spark, d):
    o = table(spark, d, "orders").select(F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("month"))
    fy = dt.fiscal_year(F.col("y"), F.col("month"))
    start = F.substring(fy, 3, 4).cast("int")
    return o.groupBy(fy.alias("fiscal_year"), "month", dt.fiscal_month_year(start, F.col("month")).alias("year")).agg(F.count("*").alias("n"))


@query("""SELECT o_orderdate::DATE AS date, (dayofyear(o_orderdate) - CASE WHEN (year(o_orderdate) % 4 = 0 AND year(o_orderdate) % 100 <> 0 OR year(o_orderdate) % 400 = 0) AND dayofyear(o_orderdate) > 59 THEN 1 ELSE 0 END)::INT AS doy FROM orders GROUP BY ALL""")
def c31_day_of_365(spark, d):
    return table(spark, d, "orders").select(F.to_date("o_orderdate").alias("date"), dt.day_of_365(F.to_date("o_orderdate")).alias("doy")).distinct()


@query("SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name), 'ring') OR contains(lower(p_type), 'ring')")
def c33_search(spark, d):
    return table(spark, d, "part").filter(tx.contains_either("RiNg", F.col("p_name"), F.col("p_type"))).select("p_partkey", "p_name")


@query("""WITH f AS (SELECT o_orderkey, o_orderdate::DATE AS s, (o_orderdate::DATE + 364)::DATE AS e FROM orders) SELECT o_orderkey, s AS "start", e AS "end", CASE WHEN o_orderkey % 20 = 0 THEN 'stay order' END AS note FROM f""")
def s11_period(spark, d):
    o = table(spark, d, "orders").withColumn("e", F.date_add(F.to_date("o_orderdate"), 364))
    said = F.concat(F.date_format("o_orderdate", "d-MMM-yyyy"), F.lit(" to "), F.date_format("e", "d-MMM-yyyy"), F.when(F.col("o_orderkey") % 20 == 0, " (stay order )").otherwise(""))
    p = dt.split_period(said)
    return o.select("o_orderkey", p["start"].alias("start"), p["end"].alias("end"), p["note"].alias("note"))


@query("SELECT c_custkey, c_name AS name, c_mktsegment AS segment FROM customer")
def s13_undoubled(spark, d):
    twice = lambda c: F.regexp_replace(c, "(.)", "$1$1")
    odd = F.col("c_custkey") % 2 == 1
    cells = tx.undoubled(F.array(F.when(odd, twice("c_name")).otherwise(F.col("c_name")), F.when(odd, twice("c_mktsegment")).otherwise(F.col("c_mktsegment"))))
    return customers(spark, d).select("c_custkey", cells[0].alias("name"), cells[1].alias("segment"))


@query("SELECT p_partkey, (p_size % 4 + 1) * 120 + p_size::DOUBLE * 1.5::DOUBLE AS mw FROM part")
def s16_units_sum(spark, d):
    said = F.concat((F.col("p_size") % 4 + 1).cast("string"), F.lit("x120 + "), F.col("p_size").cast("string"), F.lit(" * 1.5 MW"))
    return table(spark, d, "part").select("p_partkey", tx.units_sum(said).alias("mw"))


# Rows of award tables as a publisher prints them: tags inside cells, entities, breaks, uneven white space.
@query("""SELECT o_orderkey, [o_orderkey::VARCHAR, 'Ref & <' || o_custkey || '>', o_orderpriority, strftime(o_orderdate, '%d-%b-%Y'), 'Son''s "' || o_orderstatus || '" ''&amp;quot;'] AS cells, o_custkey AS reference_no, o_orderdate::DATE AS signed FROM orders""")
def s9_s10_html_rows(spark, d):
    o = table(spark, d, "orders")
    page = F.concat(
        F.lit("<table><tr class='x'><td>"), F.col("o_orderkey").cast("string"), F.lit("</td>\n<td> Ref &amp; <b>&lt;"), F.col("o_custkey").cast("string"), F.lit("&gt;</b>,</td><TD>"), "o_orderpriority",
        F.lit("</TD><td>\n"), F.date_format("o_orderdate", "dd-MMM-yyyy"), F.lit(" &nbsp;</td><td>Son&#39;s &quot;"), "o_orderstatus", F.lit("&quot; &amp;#39;&amp;amp;quot;</td></tr></table>"),
    )
    rows = ex.html_rows(o.select("o_orderkey", page.alias("html")), "html")
    fields = {"reference_no": ex.number_in(1), "signed": ex.date_in(3)}
    return ex.map_cells(rows, fields).select("o_orderkey", "cells", "reference_no", "signed")


# documents of a source as the lines of one long sheet, every fourth id a subtotal, every 50th a grand total
@query("""WITH z AS (SELECT source, doc_id AS pos, CASE WHEN doc_id % 50 = 7 THEN '' WHEN doc_id % 4 = 0 THEN 'Zone' || doc_id END AS event FROM documents),
n AS (SELECT source, pos, first_value(event IGNORE NULLS) OVER (PARTITION BY source ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS event FROM z)
SELECT source, pos, nullif(event, '') AS zone FROM n""")
def s15_following_total(spark, d):
    k = F.col("doc_id")
    label = F.when(k % 50 == 7, F.lit("Grand Total")).when(k % 4 == 0, F.concat(F.lit("Zone"), k.cast("string"), F.lit(" Area Total"))).otherwise(F.lit("plant"))
    lines = table(spark, d, "documents").select("source", k.alias("pos"), label.alias("label"))
    return ex.label_by_following_total(lines, "source", "pos", "label", block=500).select("source", "pos", "zone")


CELLS = """cells AS (SELECT c_custkey AS doc, r AS "row", k AS col, CASE WHEN r = 2 THEN ['Plant', 'Date', 'Output (MW)', 'Peak'][k + 1] WHEN r = 0 AND k = 0 THEN 'Date :' WHEN r = 0 AND k = 2 THEN strftime(DATE '2024-01-01' + (c_custkey % 300)::INT, '%d-%m-%Y')
  WHEN r > 2 THEN [c_name || r, 'x', (c_nationkey * r)::VARCHAR, ''][k + 1] END AS text FROM customer, range(5) a(r), range(4) b(k))"""


def sheet_cells(spark, d):
    """Customers as small sheets of cells (doc, row, col, text): a date line, a header line and two data lines."""
    c = table(spark, d, "customer").withColumn("row", F.explode(F.sequence(F.lit(0), F.lit(4)))).withColumn("col", F.explode(F.sequence(F.lit(0), F.lit(3))))
    at = lambda *xs: F.element_at(F.array(*xs), F.col("col") + 1)
    when = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("c_custkey") % 300).cast("int")), "dd-MM-yyyy")
    text = (
        F.when(F.col("row") == 2, at(*[F.lit(x) for x in ("Plant", "Date", "Output (MW)", "Peak")]))
        .when((F.col("row") == 0) & (F.col("col") == 0), F.lit("Date :"))
        .when((F.col("row") == 0) & (F.col("col") == 2), when)
        .when(F.col("row") > 2, at(F.concat("c_name", F.col("row").cast("string")), F.lit("x"), (F.col("c_nationkey") * F.col("row")).cast("string"), F.lit("")))
    )
    return c.select(F.col("c_custkey").alias("doc"), "row", "col", text.alias("text")).filter("text is not null")


@query("""SELECT c_custkey AS doc, r AS "row", c_name || r AS plant, (c_nationkey * r)::DOUBLE AS output FROM customer, range(3, 5) a(r)""")
def s18_rows_under_header(spark, d):
    rows = ex.rows_under_header(sheet_cells(spark, d), {"plant": "(?i)^plant", "output": "(?i)output", "remarks": "(?i)remark"})
    return rows.select("doc", "row", "plant", tx.tolerant_number(F.col("output")).alias("output"))


@query("""SELECT c_custkey AS doc, DATE '2024-01-01' + (c_custkey % 300)::INT AS date FROM customer""")
def s19_sheet_date(spark, d):
    return ex.sheet_date(sheet_cells(spark, d))


@query("""SELECT c_custkey AS doc, r AS "row", (c_nationkey * r)::DOUBLE AS value FROM customer, range(3, 5) a(r)""")
def s17_value_right_of(spark, d):
    return ex.value_right_of(sheet_cells(spark, d), "^Customer", 3).select("doc", "row", "value")


@query("""SELECT c_custkey AS doc, g AS "group", c_name || g AS name, (c_nationkey + g)::DOUBLE AS load FROM customer, range(3) x(g)""")
def s14_unpacked_groups(spark, d):
    c = table(spark, d, "customer")
    cells = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(2)), lambda g: F.array(F.concat("c_name", g.cast("string")), (F.col("c_nationkey") + g).cast("string"), F.lit("12:00"))))
    out = ex.unpack_groups(c.select(F.col("c_custkey").alias("doc"), cells.alias("cells")), "cells", ["name", "load", "time"])
    return out.select("doc", "group", "name", F.col("load").cast("double").alias("load"))


@query("""SELECT c_custkey AS doc, c_acctbal AS total, (c_nationkey * 10)::DOUBLE AS gas, CASE WHEN c_custkey % 2 = 0 THEN 'forecast' ELSE 'report' END AS form FROM customer""")
def s12_report_fields(spark, d):
    report = F.concat(F.when(F.col("c_custkey") % 2 == 0, "Daily Forecast").otherwise("Daily Report"), F.lit("\nTotal generation : "), F.col("c_acctbal").cast("string"), F.lit(" MkWh\nGas supplied = "), (F.col("c_nationkey") * 10).cast("string"), F.lit(" MMCFD"))
    fields = {"total": r"Total generation\s*:\s*(-?[0-9.]+)", "gas": r"Gas supplied\s*=\s*([0-9.]+)"}
    out = ex.extract_fields(table(spark, d, "customer").select(F.col("c_custkey").alias("doc"), report.alias("report")), "report", fields)
    return out.select("doc", "total", "gas", F.when(F.col("report").rlike("(?i)^daily forecast"), "forecast").otherwise("report").alias("form"))


@query("""SELECT c_custkey AS doc, c_name AS label, y AS fiscal_year, (c_nationkey + k)::DOUBLE AS value FROM customer, (VALUES ('FY22', 0), ('FY23', 1), ('FY24', 2)) v(y, k)""")
def s20_table_lines(spark, d):
    c = table(spark, d, "customer")
    n = F.col("c_nationkey")
    lines = F.array(F.lit("Country FY22 FY23 FY24"), F.concat_ws("  ", "c_name", n.cast("string"), (n + 1).cast("string"), (n + 2).cast("string")), F.lit("Total 1 2 3"))
    rows = c.select(F.col("c_custkey").alias("doc"), F.posexplode(lines).alias("line", "text"))
    return ex.table_lines(rows, r"FY\d{2}", r"(?i)^total").select("doc", "label", "fiscal_year", "value")


def _td(*lines):
    return F.concat(F.lit("<td> "), F.concat_ws("<br/>", *lines), F.lit(" </td>"))


@query("""SELECT o_orderkey::VARCHAR AS tender_id, 'PKG/' || o_custkey AS package_ref, o_orderstatus AS status, 'Goods & works' AS procurement_nature, o_orderpriority AS procuring_entity, strftime(o_orderdate, '%d-%b-%Y') AS publish_date, NULL::VARCHAR AS close_date FROM orders""")
def s10_tenders(spark, d):
    o = table(spark, d, "orders")
    row = F.concat(
        F.lit("<tr>"), _td(F.lit("1")), _td(F.col("o_orderkey").cast("string"), F.concat(F.lit("PKG/"), F.col("o_custkey").cast("string")), F.col("o_orderstatus")), _td(F.lit("Goods &amp; works"), F.lit("<b>d</b>")),
        _td(F.lit("m"), F.lit("d"), F.lit("o"), F.col("o_orderpriority")), _td(F.lit("NCT"), F.lit("OTM")), _td(F.concat(F.date_format("o_orderdate", "dd-MMM-yyyy"), F.lit(","))), F.lit("</tr><tr><td>short</td></tr>"),
    )
    out = ex.parse_layout(ex.html_cells(o.select(row.alias("html")), "html"), ex.LAYOUTS["tenders"])
    return out.select("tender_id", "package_ref", "status", "procurement_nature", "procuring_entity", "publish_date", "close_date")


@query("""SELECT c_custkey, c_name AS name, c_mktsegment AS designation FROM customer""")
def s10_owner_table(spark, d):
    c = table(spark, d, "customer")
    page = F.concat(F.lit("<table><tr><td>Name</td></tr><tr>"), _td(F.col("c_name")), _td(F.col("c_mktsegment")), _td(F.lit("50%")), _td(F.lit("BD")), F.lit("</tr></table>"))
    return ex.owner_table(c.select("c_custkey", page.alias("html")), "html").select("c_custkey", F.explode("owners").alias("o")).select("c_custkey", "o.name", "o.designation")


def layout_rows(spark, d, cells):
    """One row fragment an order, each cell the lines given."""
    row = F.concat(F.lit("<tr>"), *[_td(*lines) for lines in cells], F.lit("</tr>"))
    return ex.html_cells(table(spark, d, "orders").select("o_orderkey", row.alias("html")), "html")


@query("""SELECT o_orderkey, o_orderkey::VARCHAR AS tender_id, 'REF-' || o_custkey AS package_ref, 'Ministry' AS ministry, 'Office' AS procuring_entity, o_orderpriority AS procurement_method, 'Firm ' || o_custkey AS awarded_to, o_totalprice::VARCHAR AS value_crore FROM orders""")
def s10_awards(spark, d):
    s = F.col("o_custkey").cast("string")
    rows = layout_rows(spark, d, [[F.lit("1")], [F.lit("Ministry"), F.lit("Division")], [F.concat(F.col("o_orderkey").cast("string"), F.lit(", REF-"), s), F.lit("supply")], [F.lit("Office"), F.col("o_orderpriority")], [F.lit("District")], [F.date_format("o_orderdate", "dd-MMM-yyyy")], [F.concat(F.lit("Firm "), s)], [F.col("o_totalprice").cast("string")]])
    return ex.parse_layout(rows, ex.LAYOUTS["awards"]).select("o_orderkey", "tender_id", "package_ref", "ministry", "procuring_entity", "procurement_method", "awarded_to", "value_crore")


@query("""SELECT o_orderkey, 'Office' AS procuring_entity, 'Goods' AS procurement_nature, o_orderkey::VARCHAR AS tender_id, 'road ' || o_custkey AS title, 'Firm ' || o_custkey AS awarded_to, strftime(o_orderdate, '%d-%b-%Y') AS contract_start_date, CASE WHEN o_orderkey % 2 = 0 THEN '31-Dec-2001' END AS contract_end_date, o_orderstatus AS work_status FROM orders""")
def s10_experience(spark, d):
    s, k = F.col("o_custkey").cast("string"), F.col("o_orderkey")
    rows = layout_rows(spark, d, [[F.lit("1")], [F.lit("Division"), F.lit("Organization"), F.lit("Office")], [F.lit("Goods"), F.lit("NCT"), F.lit("OTM")], [F.concat(k.cast("string"), F.lit(", road "), s)], [F.concat(F.lit("Firm "), s)], [s], [s], [F.col("o_totalprice").cast("string")], [F.date_format("o_orderdate", "dd-MMM-yyyy"), F.when(k % 2 == 0, "31-Dec-2001")], [F.col("o_orderstatus")]])
    return ex.parse_layout(rows, ex.LAYOUTS["experience"]).select("o_orderkey", "procuring_entity", "procurement_nature", "tender_id", "title", "awarded_to", "contract_start_date", "contract_end_date", "work_status")


@query("""SELECT o_orderkey, 'Ministry ' || o_custkey % 40 AS ministry, 'Division' AS division, 'Organization' AS organization, o_orderpriority AS project FROM orders""")
def s10_plan(spark, d):
    rows = layout_rows(spark, d, [[F.concat(F.lit("Ministry "), (F.col("o_custkey") % 40).cast("string"))], [F.lit("Division")], [F.lit("Organization")], [F.col("o_orderpriority")]])
    return ex.parse_layout(rows, ex.LAYOUTS["plan"]).select("o_orderkey", "ministry", "division", "organization", "project")


@query("""SELECT o_orderkey, o_custkey::VARCHAR AS app_id, 'APP' AS app_code, 'Works' AS procurement_nature, 'PKG ' || o_orderkey AS package_no, CASE WHEN o_orderkey % 3 = 0 THEN 'paint' END AS package_description, o_totalprice::VARCHAR AS estimated_cost, o_orderpriority AS planned_method FROM orders""")
def s10_plan_items(spark, d):
    k = F.col("o_orderkey")
    rows = layout_rows(spark, d, [[F.lit("1")], [F.col("o_custkey").cast("string")], [F.lit("APP")], [F.lit("Works"), F.lit("Project")], [F.concat(F.lit("PKG "), k.cast("string")), F.when(k % 3 == 0, "paint")], [F.col("o_totalprice").cast("string"), F.col("o_orderpriority")]])
    return ex.parse_layout(rows, ex.LAYOUTS["plan_items"]).select("o_orderkey", "app_id", "app_code", "procurement_nature", "package_no", "package_description", "estimated_cost", "planned_method")


@query("""SELECT o_orderkey, 'Firm ' || o_custkey AS company, 'BD' AS country, 'House 1, Dhaka' AS address, o_orderdate::DATE AS "start", (o_orderdate::DATE + 364)::DATE AS "end", 'Package' AS scope, o_orderpriority AS reason FROM orders""")
def s10_bans(spark, d):
    period = F.concat(F.date_format("o_orderdate", "d-MMM-yyyy"), F.lit(" to "), F.date_format(F.date_add(F.to_date("o_orderdate"), 364), "d-MMM-yyyy"))
    rows = layout_rows(spark, d, [[F.lit("1")], [F.concat(F.lit("Firm "), F.col("o_custkey").cast("string"))], [F.lit("BD")], [F.lit("House 1, Dhaka")], [F.lit("Office")], [period], [F.lit("Package")], [F.col("o_orderpriority")]])
    p = dt.split_period(F.col("period"))
    return ex.parse_layout(rows, ex.LAYOUTS["bans"]).select("o_orderkey", "company", "country", "address", p["start"].alias("start"), p["end"].alias("end"), "scope", "reason")


@query("""SELECT c_custkey, c_custkey::VARCHAR AS tenderer_id, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'Own Funds' END AS budget_source, 'Road ' || c_nationkey AS business_address, 'Site ' || c_custkey AS delivery_location, 'P-' || c_nationkey AS project_code,
CASE WHEN c_custkey % 4 = 0 THEN [] ELSE [c_name] END AS owners, CASE WHEN c_custkey % 4 = 0 THEN [] ELSE [c_mktsegment] END AS designations, CASE WHEN c_custkey % 4 = 0 THEN [] ELSE [CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE '50.0' END] END AS parts FROM customer""")
def s10_award_details(spark, d):
    line = lambda label, value: F.concat(F.lit(f"<tr><td class='l'>{label}: </td>\n <td> "), value, F.lit(" </td></tr>"))
    k, nation = F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string")
    owner = F.concat(F.lit("<tr><td>1</td><td> "), "c_name", F.lit("</td><td>"), "c_mktsegment", F.lit("</td><td>"), F.when(F.col("c_custkey") % 2 == 0, "").otherwise("50.0"), F.lit("</td><td>BD</td></tr><tr><td>2</td><td></td><td>x</td><td>1</td><td>y</td></tr>"))
    page = F.concat(
        line("Tenderer ID of the Economic Operator (if any)", k), line("Budget and Source of Funds", F.when(F.col("c_custkey") % 3 == 0, "").otherwise("Own &nbsp; Funds")), line("Project/Program Code (if any)", F.concat(F.lit("P-"), nation)),
        line("Location of Delivery/Works/Service Delivery", F.concat(F.lit("Site "), k)), F.lit("<h4>Beneficial Ownership Information</h4><table>"), F.when(F.col("c_custkey") % 4 == 0, "").otherwise(owner), F.lit("</table>"),
        line("Business Address of the Economic Operator", F.concat(F.lit("Road "), nation)),
    )
    out = ex.award_details(table(spark, d, "customer").select("c_custkey", page.alias("html")), "html")
    part = lambda f: F.transform("beneficial_owners", lambda o: o[f])
    return out.select("c_custkey", "tenderer_id", "budget_source", "business_address", "delivery_location", "project_code", part("name").alias("owners"), part("designation").alias("designations"), part("ownership_pct").alias("parts"))
