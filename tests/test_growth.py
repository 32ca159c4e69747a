"""Forms of plans that keep a query's memory from growing at the driver, and work that repeated rows must not add."""

from __future__ import annotations

import contextlib
import io as text_io
import os
import subprocess
import sys

from pyspark.sql import functions as F

from recordscope.operators import extract as ex
from recordscope.operators import match as mt
from recordscope.operators import procurement as pr
from recordscope.plans.base import contracts
from recordscope.sources import io


def plan(df):
    """The plan that Spark chooses before it runs."""
    out = text_io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("simple")
    return out.getvalue()


def test_places_are_joined_without_the_driver(spark):
    """Both sides grow; a broadcast of a guessed size filled the driver. Long texts look up long pieces."""
    names = spark.range(300).select(F.concat(F.lit("large ring "), F.translate(F.col("id").cast("string"), "0123456789", "bdfgklmnrt")).alias("name"), F.lit("a").alias("district"))
    asked = names.select(F.upper("name").alias("q")).unionByName(names.select(F.substring("name", 6, 8).alias("q")))
    found = mt.resolve_places(asked, names, aliases=names.select("name", F.concat(F.lit("Qx"), F.substring("name", 12, 3)).alias("alias")))
    assert "Broadcast" not in plan(found)
    every = [r["name"] for r in names.collect()]
    got = {}
    for r in found.filter("rank < 4").collect():
        got.setdefault(r["q"], {})[r["name"]] = r["rank"]
    for q in {r["q"] for r in asked.collect()}:
        t = q.lower().strip()
        want = {n: 0 if n == t else 1 if n.startswith(t) else 3 for n in every if t in n}
        best = sorted((k, len(n), n) for n, k in want.items())[:8]
        assert got.get(q, {}) == {n: k for k, _, n in best}


def test_rows_under_header_are_joined_without_the_driver(spark):
    """There is a header for each sheet, so a broadcast of all of them grew with the input. The first row with labels counts."""
    said = {0: ("Notes", "Plant", ""), 1: ("Plant", "Output", "Output"), 2: ("a", "1", "9"), 3: ("Output", "Plant", "")}
    sheet = F.array(*[F.struct(F.lit(row).alias("row"), F.lit(col).alias("col"), F.lit(text).alias("text")) for row, texts in said.items() for col, text in enumerate(texts)])
    cells = spark.range(20).select(F.col("id").alias("doc"), F.inline(sheet))
    rows = ex.rows_under_header(cells, {"plant": "^Plant", "output": "^Output", "remarks": "^Remark"})
    assert "Broadcast" not in plan(rows)
    assert sorted(map(tuple, rows.collect())) == sorted((doc, row, a, b, None) for doc in range(20) for row, a, b in ((2, "a", "1"), (3, "Output", "Plant")))


CLUSTER = """
import sys, tempfile
from pyspark.sql import SparkSession
top = tempfile.mkdtemp()
b = SparkSession.builder.master("local-cluster[2,1,1024]").config("spark.checkpoint.dir", f"file://{top}").config("spark.driver.host", "127.0.0.1").config("spark.ui.enabled", "false")
spark = b.config("spark.sql.files.maxPartitionBytes", "4k").getOrCreate()
from recordscope.plans.catalogue import QUERIES
got = QUERIES["s7_database"](spark, "/root/testdata/sf0.001")
want = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").filter("o_totalprice > 1000").selectExpr("o_orderkey", "o_custkey", "o_totalprice")
assert got.count() == want.count() and not got.exceptAll(want).count()
"""


def test_database_on_several_machines(tmp_path):
    """The embedded engine served one process: its executors failed while the driver held the database."""
    run = subprocess.run([sys.executable, "-c", CLUSTER], cwd=tmp_path, env=os.environ | {"SPARK_LOCAL_DIRS": str(tmp_path)}, capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stderr[-2000:]


def test_sqlite_ranges(spark, tmp_path):
    """Null, negative and repeated keys and null values come back once each, whatever the ranges."""
    rows = [(k if k % 5 else None, k % 3 or None, None if k % 4 else f"a{k}'") for k in range(-40, 40)] + [(7, 2**60 + 1, "x")] * 9 + [(0, 1, "zero")] * 3
    df = spark.createDataFrame(rows, "id long, n long, t string").repartition(3)
    assert io.write_sqlite(df, f"file://{tmp_path}/a b", "facts", "id") == len(rows)
    back = io.read_sqlite(spark, f"file://{tmp_path}/a b", "SELECT * FROM facts", df.schema, "id", 4)
    assert back.rdd.getNumPartitions() > 6
    assert sorted(map(str, map(tuple, back.collect()))) == sorted(map(str, rows))


SF = "/root/testdata/sf0.001"


def test_contracts_grow_without_broadcasts_of_large_sides(spark):
    assert plan(contracts(spark, SF)).count("SortMergeJoin") >= 3


def test_vendor_figures_need_no_join(spark):
    rows = spark.range(50).select(F.concat(F.lit("Firm no "), F.col("id") % 5).alias("awarded_to"), F.lit("e").alias("entity"), F.lit(None).cast("string").alias("ministry"), F.lit("2024-01-02").cast("date").alias("signed"), F.lit(1.5).alias("value"))
    out = pr.vendor_profile(rows)
    assert "Join" not in plan(out)
    assert {tuple(r)[2:] for r in out.collect()} == {(10, 15.0, 1, 0, 1, "e", 1.0)}


def test_sheet_dates_need_no_join(spark):
    """A date beside a label comes before earlier ones; a label's own cell counts, one too far left does not."""
    said = [("a", 0, 0, "1-2-2024"), ("a", 3, 1, "Date"), ("a", 3, 5, "3-Mar-2024"), ("b", 9, 0, "Date"), ("b", 9, 5, "1-2-2024"), ("c", 8, 2, "Date: 2024-05-06"), ("d", 5, 0, "7/8/2024"), ("d", 4, 0, "9.8.2024")]
    cells = spark.createDataFrame(said, "doc string, row int, col int, text string")
    out = ex.sheet_date(cells)
    assert "Join" not in plan(out)
    assert {r["doc"]: str(r["date"]) for r in out.collect()} == {"a": "2024-03-03", "c": "2024-05-06", "d": "2024-08-09"}


def test_points_at_one_position_cut_no_cells(spark):
    """Cells over a crowded corner were cut down to the deepest level."""
    ring = F.array(*[F.struct(F.lit(x).alias("lon"), F.lit(y).alias("lat")) for x, y in ((0.0, 0.0), (8.0, 0.0), (8.0, 8.0))])
    points = spark.range(100).select("id", F.lit(0.0).alias("lon"), F.lit(0.0).alias("lat"))
    assert mt.polygon_cover(points, spark.range(1).select(F.lit("a").alias("name"), ring.alias("ring")), 5).select("level").distinct().count() == 1


def test_tokens_are_joined_without_the_driver(spark):
    names = spark.range(20).select(F.concat(F.lit("north plant "), F.translate(F.col("id").cast("string"), "0123456789", "bdfgklmnrt"), F.lit("xyz")).alias("name"))
    found = mt.token_match(names, names.withColumnRenamed("name", "other"), "name", "other", places=names.select(F.substring("name", 1, 5).alias("token")))
    assert "Broadcast" not in plan(found)
    assert all(r["name"] == r["other"] for r in found.collect())
