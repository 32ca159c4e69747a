"""Readers, writers and streamed jobs on small files."""

from __future__ import annotations

import gzip
import json

import pytest
from pyspark.sql import types as T

from recordscope.sources import io
from recordscope.streaming import jobs

SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("v", T.DoubleType())])


def test_batches_skip_a_broken_last_line(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": "1", "v": 1}\n{"id": "2", "v"')
    with gzip.open(tmp_path / "b.jsonl.gz", "wt") as f:
        f.write('{"id": "1", "v": 2}\n{"id": "3", "v": null}\n')
    rows = io.read_batches(spark, str(tmp_path), SCHEMA, 2).collect()
    assert {(r["id"], r["v"]) for r in rows} == {("1", 1.0), ("1", 2.0), ("3", None)} and len(rows) == 3
    last = io.last_by_file(io.read_batches(spark, str(tmp_path), SCHEMA), ["id"]).collect()
    assert {r["id"]: r["v"] for r in last} == {"1": 2.0, "3": None}


def test_broken_lines_are_listed_and_order_holds_over_splits(spark, tmp_path):
    lines = [f'{{"id": "{k}", "v": {k}}}' for k in range(3_000)]
    (tmp_path / "a.jsonl").write_text("\n".join([*lines[:1500], '{"id": "cut', *lines[1500:]]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        rows = io.read_batches(spark, str(tmp_path), SCHEMA)
        assert rows.select("pos.block").distinct().count() > 3
        assert [r["id"] for r in rows.orderBy("pos").collect()] == [str(k) for k in range(3_000)]
        broken = io.broken_lines(spark, str(tmp_path), SCHEMA).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r["line"] for r in broken] == ['{"id": "cut']


def test_work_tables_go_with_their_scratch(spark):
    from pathlib import Path

    folder = Path(io.shared_dir(spark))
    before = {p.name for p in folder.glob("table-*")}
    with io.scratch(spark):
        kept = io.durable(spark.range(1_000))
        assert kept.count() == 1_000
        with io.scratch(spark) as inner:
            assert io.durable(kept.filter("id < 7"), outer=True).count() == 7 and inner == []
        assert len({p.name for p in folder.glob("table-*")} - before) == 2
    assert {p.name for p in folder.glob("table-*")} == before


def test_queries_own_their_work_tables(spark):
    """What a query wrote on its way goes; its result stays and is whole. Threads do not mix their tables."""
    from concurrent.futures import ThreadPoolExecutor
    from pathlib import Path

    folder = Path(io.shared_dir(spark))
    before = {p.name for p in folder.glob("table-*")}

    @io.owned
    def doubled(spark, n):
        return io.durable(spark.range(int(n))).unionByName(io.durable(spark.range(int(n))))

    with ThreadPoolExecutor(4) as pool:
        out = list(pool.map(lambda n: doubled(spark, str(n)), (3, 5, 7, 9)))
    assert [df.count() for df in out] == [6, 10, 14, 18] and len({p.name for p in folder.glob("table-*")} - before) == 4
    assert io.owned(lambda spark, d: spark.range(4))(spark, "").count() == 4 and len({p.name for p in folder.glob("table-*")} - before) == 4


def test_a_cluster_must_name_its_shared_folder():
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        io.shared_dir(Session())


def test_database_source(spark, tmp_path):
    """Reads by ranges of a key, from the engine that comes with Spark."""
    url = f"jdbc:derby:{tmp_path / 'db'}"
    facts = spark.createDataFrame([(k, f"2024-01-{k % 28 + 1:02d}", k % 3) for k in range(100)], "ID int, DAY string, N int")
    try:
        facts.write.jdbc(f"{url};create=true", "FACTS", properties={"driver": "org.apache.derby.jdbc.EmbeddedDriver"})
    except Exception:
        pytest.skip("no database driver on the class path")
    whole = io.read_database(spark, url, "SELECT ID, N FROM FACTS WHERE N > 0")
    parts = io.read_database(spark, url, "SELECT ID, N FROM FACTS WHERE N > 0", split="ID", parts=4)
    assert parts.rdd.getNumPartitions() == 4
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, parts.collect())) == [(k, k % 3) for k in range(100) if k % 3]


def test_year_buckets(spark, tmp_path):
    for name in ("2012.json", "unknown.json", "summary.json", "dimensions.json"):
        (tmp_path / name).write_text(json.dumps([{"id": name, "v": 1.0}]))
    assert {(r["id"], r["bucket"]) for r in io.read_buckets(spark, str(tmp_path), SCHEMA).collect()} == {("2012.json", "2012"), ("unknown.json", "unknown")}


def test_time_series_and_optional(spark, tmp_path):
    schema = T.StructType([T.StructField("datetime", T.TimestampType()), T.StructField("demand", T.DoubleType())])
    (tmp_path / "h.csv").write_text("datetime,demand\n2017-01-01 00:00:00,5\n1917-01-01 00:00:00,6\n2018-01-01 00:00:00,\n")
    assert [r["demand"] for r in io.read_time_series(spark, str(tmp_path), schema, "datetime").orderBy("datetime").collect()] == [5.0, None]
    assert io.read_optional(spark, str(tmp_path / "none.csv"), schema).count() == 0
    assert io.read_optional(spark, str(tmp_path / "h.csv"), schema).count() == 3


def test_reports_keyed_and_sheets(spark, tmp_path):
    for k, doc in enumerate([{"date": "2025-01-01", "failed": None, "m": {"z": {"gas": 1.5}}}, {"date": "2025-01-02", "failed": True}, {"failed": False}]):
        (tmp_path / f"r{k}.json").write_text(json.dumps(doc))
    schema = T.StructType([T.StructField("date", T.StringType()), T.StructField("failed", T.BooleanType()), T.StructField("m", T.MapType(T.StringType(), T.MapType(T.StringType(), T.DoubleType())))])
    got = io.read_reports(spark, str(tmp_path / "r*.json"), schema).collect()
    assert [r["m"]["z"]["gas"] for r in got] == [1.5]
    keyed = tmp_path / "keyed"
    keyed.mkdir()
    (keyed / "2023.json").write_text('{"d1": {"v": 1.0}, "d2": {"v": 2.0}}')
    (keyed / "2024.json").write_text('{"d2": {"v": 3.0}}')
    value = T.StructType([T.StructField("v", T.DoubleType())])
    assert {r["date"]: r["v"] for r in io.read_keyed(spark, str(keyed), value).collect()} == {"d1": 1.0, "d2": 3.0}
    sheets = tmp_path / "sheets"
    sheets.mkdir()
    (sheets / "2024-05.json").write_text('{"A": [1, 2, 3, 99], "B": [4, null]}')
    (sheets / "notes.json").write_text('{"A": [7]}')
    cells = {(r["month"], r["unit"], r["column"]): r["value"] for r in io.read_sheets(spark, str(sheets), ["x", "y", "z"]).collect()}
    assert cells == {("2024-05", "A", "x"): 1, ("2024-05", "A", "y"): 2, ("2024-05", "A", "z"): 3, ("2024-05", "B", "x"): 4, ("2024-05", "B", "y"): None}


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(1, 2020, "valid"), (2, None, "unknown"), (3, 2021, "invalid")], "id int, year int, class string")
    io.write_buckets(df, str(tmp_path / "b"))
    assert {p.name for p in (tmp_path / "b").glob("year=*")} == {"year=2020", "year=2021", "year=unknown"}
    io.rewrite_buckets(spark.createDataFrame([(9, "2020", "valid")], "id int, year string, class string"), str(tmp_path / "b"), "year")
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "b")).collect()) == [2, 3, 9]
    io.export_forms(df, str(tmp_path / "e"), raw=df)
    counts = {n: spark.read.parquet(str(tmp_path / "e" / n)).count() for n in ("clean", "with_unknown", "all", "raw")}
    assert counts == {"clean": 1, "with_unknown": 2, "all": 3, "raw": 3}
    packed = io.pack_parallel(df, ["id", "class"]).first()
    assert packed["id"] == [1, 2, 3] and packed["class"] == ["valid", "unknown", "invalid"]


def stream_of(spark, path, schema, parts):
    for k, rows in enumerate(parts):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/{k}")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/*")


def test_streams_equal_their_batch_forms(spark, tmp_path):
    schema = "k string, month string, a double, b double"
    parts = [[("x", "m1", 1.0, None), ("y", "m1", None, 2.0)], [("x", "m1", 9.0, 5.0), ("z", "m2", 1.0, 1.0)], [("y", "m1", 7.0, 8.0)]]
    merge = lambda old, new: jobs.fill_nulls(old, new, ["k", "month"], ["a", "b"], ["b"])
    q = jobs.merge_stream(stream_of(spark, str(tmp_path / "in"), schema, parts), str(tmp_path / "table"), str(tmp_path / "cp"), "month", merge)
    q.awaitTermination(120)
    assert q.exception() is None
    batch = None
    for rows in parts:
        new = spark.createDataFrame(rows, schema)
        batch = new if batch is None else merge(batch, new)
    got = {tuple(r) for r in spark.read.parquet(str(tmp_path / "table")).select("k", "month", "a", "b").collect()}
    assert got == {tuple(r) for r in batch.select("k", "month", "a", "b").collect()} == {("x", "m1", 1.0, 5.0), ("y", "m1", 7.0, 8.0), ("z", "m2", 1.0, 1.0)}


def test_replace_stream_and_gate(spark, tmp_path):
    schema = "k string, month string, v double"
    merge = lambda old, new: jobs.replace_keys(old, new, ["k", "month"], ["v"])
    q = jobs.merge_stream(stream_of(spark, str(tmp_path / "in"), schema, [[("x", "m", 1.0)], [("x", "m", 2.0), ("y", "m", 3.0)]]), str(tmp_path / "t"), str(tmp_path / "c"), "month", merge)
    q.awaitTermination(120)
    assert {(r["k"], r["v"]) for r in spark.read.parquet(str(tmp_path / "t")).collect()} == {("x", 2.0), ("y", 3.0)}
    rules = spark.createDataFrame([("r", "member", 0, 0), ("r", "member", 0, 1), ("r", "total", 0, 2)], "constraint string, role string, row int, col int")
    cells = [[("good", 0, c, v) for c, v in enumerate((1, 2, 3))] + [("bad", 0, c, v) for c, v in enumerate((1, 2, 4))]]
    q = jobs.gate_stream(stream_of(spark, str(tmp_path / "in2"), "sheet string, row int, col int, value long", cells), rules, str(tmp_path / "pub"), str(tmp_path / "rev"), str(tmp_path / "c2"))
    q.awaitTermination(120)
    assert {r["sheet"] for r in spark.read.parquet(str(tmp_path / "pub")).collect()} == {"good"}
    assert {r["sheet"] for r in spark.read.parquet(str(tmp_path / "rev")).collect()} == {"bad"}


def test_settled_days_wait_for_the_watermark(spark, tmp_path):
    schema = "ts timestamp, v int"
    rows = spark.sql("select timestamp'2024-01-01 10:00:00' as ts, 1 as v union all select timestamp'2024-01-02 23:00:00', 1")
    rows.coalesce(1).write.parquet(str(tmp_path / "in" / "0"))
    spark.sql("select timestamp'2024-01-04 10:00:00' as ts, 1 as v").write.parquet(str(tmp_path / "in" / "1"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
    q = jobs.settled_counts(stream, "ts", "1 hour").writeStream.outputMode("append").format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {(str(r["day"]), r["n"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert ("2024-01-01", 1) in got and not any(day == "2024-01-04" for day, _ in got)


def test_unseen_first_of_each_key(spark):
    new = spark.createDataFrame([("a", 2), ("a", 1), ("b", 1)], "k string, o int")
    known = spark.createDataFrame([("b",)], "k string")
    assert [tuple(r) for r in jobs.unseen(new, known, ["k"], ["o"]).collect()] == [("a", 1)]
