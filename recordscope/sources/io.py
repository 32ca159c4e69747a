"""Readers of published archives and writers of tables."""

from __future__ import annotations

import contextlib
import contextvars
import functools
import itertools
import os
import re
import shutil
import sqlite3
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from urllib.parse import quote, unquote

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``. Without one a temporary folder is made in local mode (tests); a cluster must name one."""
    name = spark.conf.get("spark.checkpoint.dir", None)
    if not name:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("name a folder that all machines share in spark.checkpoint.dir")
        name = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", name)
    return name.rstrip("/")


#: Tables of each open ``scratch`` of this thread, innermost last.
_OPEN: contextvars.ContextVar[tuple[list[str], ...]] = contextvars.ContextVar("open scratches", default=())


def durable(df: DataFrame, outer: bool = False) -> DataFrame:
    """``df`` written as a Parquet table in the shared folder and read again: a cut lineage that survives lost executors.

    The table stays until the ``scratch`` around it ends (with ``outer`` the one around that), or, outside of one, until the folder's
    owner clears it.
    """
    path = f"{shared_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    held = _OPEN.get()[:-1] if outer else _OPEN.get()
    if held:
        held[-1].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Deletes at its end the tables that ``durable`` wrote inside it, whose paths it gives; results must be written or collected by then."""
    mine: list[str] = []
    token = _OPEN.set((*_OPEN.get(), mine))
    try:
        yield mine
    finally:
        _OPEN.reset(token)
        for name in mine:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def owned(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """``query`` with its work tables deleted: where it wrote any, its result becomes the one table that stays."""

    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        with scratch(spark) as tables:
            out = query(spark, sf_dir)
            return durable(out, outer=True) if tables else out

    return run


def _lines(spark: SparkSession, path: str, schema: T.StructType, pattern: str) -> DataFrame:
    """(line, batch, pos, r): each line with its parsed form, whose field _broken is not null where it is no JSON of the schema."""
    told = T.StructType([*schema.fields, T.StructField("_broken", T.StringType())])
    pos = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    lines = spark.read.text(path, pathGlobFilter=pattern).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("batch"), pos.alias("pos"))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}
    return lines.filter(F.trim("line") != "").withColumn("r", F.from_json("line", told, options))


def read_batches(spark: SparkSession, path: str, schema: T.StructType, parts: int | None = None, pattern: str = "*.jsonl*") -> DataFrame:
    """JSON lines, plain or gzip, with ``batch`` (file path) and ``pos`` (order in it: block of the file, then row).

    Broken lines are left out here and listed by ``broken_lines``. A gzip file is one split, so a repartition follows where
    ``parts`` is given.
    """
    df = _lines(spark, path, schema, pattern).filter(F.col("r._broken").isNull())
    df = df.select(*[F.col(f"r.{name}").alias(name) for name in schema.names], "batch", "pos")
    return df.repartition(parts) if parts else df


def broken_lines(spark: SparkSession, path: str, schema: T.StructType, pattern: str = "*.jsonl*") -> DataFrame:
    """(batch, pos, line): lines of the same files that are no JSON of the schema, such as a last line cut short."""
    return _lines(spark, path, schema, pattern).filter(F.col("r._broken").isNotNull()).select("batch", "pos", "line")


def read_buckets(spark: SparkSession, path: str, schema: T.StructType, pattern: str = "{[0-9][0-9][0-9][0-9],unknown}.json", bucket: str = r"([^/]+)\.json$") -> DataFrame:
    """Files of JSON arrays (``2012.json``, ``unknown.json``) with their ``bucket``, taken from the path; summaries and dimensions are left out."""
    df = spark.read.schema(schema).option("multiLine", True).json(path, pathGlobFilter=pattern)
    return df.withColumn("bucket", F.regexp_extract(F.col("_metadata.file_path"), bucket, 1))


def read_time_series(spark: SparkSession, path: str, schema: T.StructType, at: str, first: int = 2010, last: int = 2035) -> DataFrame:
    """CSV buckets with a header; rows of implausible years, and of times that are none, are left out. Times may have a fraction of a second."""
    said = T.StructType([T.StructField(f.name, T.StringType()) if f.name == at else f for f in schema.fields])
    df = spark.read.schema(said).option("header", True).csv(path).withColumn(at, F.col(at).try_cast(schema[at].dataType))
    return df.filter(F.year(at).between(first, last))


def read_reports(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON reports with their ``batch`` (file path), one or an array of them a file; failed and undated ones are left out."""
    df = spark.read.schema(schema).option("multiLine", True).json(path)
    failed = F.coalesce(F.col("failed"), F.lit(False)) if "failed" in schema.names else F.lit(False)
    return df.withColumn("batch", F.col("_metadata.file_path")).filter(~failed & F.col("date").isNotNull())


def read_keyed(spark: SparkSession, path: str, value: T.DataType, key: str = "date") -> DataFrame:
    """Files of one JSON object of keyed values: (key, value fields); a key of a later file name replaces earlier ones."""
    text = spark.read.option("wholetext", True).text(path).withColumn("batch", F.col("_metadata.file_path"))
    each = text.select("batch", F.explode(F.from_json("value", T.MapType(T.StringType(), value))).alias(key, "v"))
    last = each.groupBy(key).agg(F.max_by("v", "batch").alias("v"))
    return last.select(key, "v.*") if isinstance(value, T.StructType) else last.withColumnRenamed("v", "value")


def read_sheets(spark: SparkSession, path: str, columns: Sequence[str], pattern: str = "[0-9][0-9][0-9][0-9]-[0-9][0-9].json", month: str = r"/(\d{4}-\d{2})[^/]*$") -> DataFrame:
    """Monthly files ``yyyy-MM.json`` of unit -> list of counts: (month, unit, column, value), lists cut to the columns; the month is in the path."""
    text = spark.read.option("wholetext", True).text(path, pathGlobFilter=pattern)
    text = text.select("value", F.regexp_extract(F.col("_metadata.file_path"), month, 1).alias("month"))
    units = text.select("month", F.explode(F.from_json("value", "map<string,array<int>>")).alias("unit", "v"))
    cells = units.select("month", "unit", F.posexplode(F.slice("v", 1, len(columns))).alias("k", "value"))
    return cells.select("month", "unit", F.get(F.array(*[F.lit(c) for c in columns]), F.col("k")).alias("column"), "value")


def or_nothing(df: Callable[[], DataFrame], spark: SparkSession, schema: T.StructType) -> DataFrame:
    """What ``df`` reads, or no rows of the schema where its path does not exist."""
    try:
        return df()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_optional(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A side CSV, or no rows of its schema when the path does not exist."""
    return or_nothing(lambda: spark.read.schema(schema).option("header", True).csv(path), spark, schema)


def read_database(spark: SparkSession, url: str, query: str, split: str | None = None, bounds: tuple[int, int] | None = None, parts: int = 16, **options: str) -> DataFrame:
    """Rows of a SQL query over JDBC, such as the fact and district queries of a crawl database.

    With ``split``, a numeric column of the query, ``parts`` tasks read ranges of it at most: of equal width between ``bounds`` where
    these are given, otherwise of about equal rows, by a sketch of the keys, which are read alone first. Nulls are in the first range.
    Filters and columns that follow are pushed down to the database. The driver class must be on Spark's class path.
    """
    reader = lambda: spark.read.format("jdbc").option("url", url).options(**options)
    if split is None:
        return reader().option("query", query).load()

    def ranges(sql: str, low: int, high: int) -> DataFrame:
        cut = {"partitionColumn": split, "lowerBound": str(low), "upperBound": str(high), "numPartitions": str(parts)}
        return reader().options(**cut).option("dbtable", f"({sql}) q").load()

    if bounds is not None:
        return ranges(query, *bounds)
    low, high = reader().option("query", f"SELECT min({split}) AS low, max({split}) AS high FROM ({query}) q").load().first()
    keys = ranges(f"SELECT {split} FROM ({query}) k", int(low or 0), int(high or 0) + 1)
    cuts = keys.agg(F.percentile_approx(keys[0], [k / parts for k in range(1, parts)] or [0.5], 10_000)).first()[0] or []
    cuts = sorted(set(cuts))[: parts - 1]
    if not cuts:
        return reader().option("query", query).load()
    inner = [f"{split} >= {a} AND {split} < {b}" for a, b in zip(cuts, cuts[1:], strict=False)]
    return spark.read.jdbc(url, f"({query}) q", predicates=[f"{split} < {cuts[0]} OR {split} IS NULL", *inner, f"{split} >= {cuts[-1]}"], properties=dict(options))


def _mounted(path: str) -> str:
    """A path of the local file system, without its scheme; SQLite opens no other."""
    plain = re.sub(r"^file:(//)?(?=/)", "", path)
    if not plain.startswith("/"):
        raise ValueError(f"SQLite files need a folder that all machines mount, not {path}")
    return plain


def write_sqlite(df: DataFrame, path: str, table: str, key: str) -> int:
    """Numbers and texts as a crawl database in shards: one SQLite file for each partition of ``df``, with an index on ``key``; gives the rows.

    A shard is made in its task's own folder and moved under its name when whole, so a repeated task replaces its file.
    """
    folder, names = _mounted(path), df.columns
    os.makedirs(folder, exist_ok=True)

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        with tempfile.TemporaryDirectory() as own, contextlib.closing(sqlite3.connect(f"{own}/shard.db")) as db:
            db.execute(f"CREATE TABLE {table} ({', '.join(names)})")
            n = 0
            for batch in itertools.chain([first], batches):
                db.executemany(f"INSERT INTO {table} VALUES ({', '.join('?' * len(names))})", zip(*[c.to_pylist() for c in batch.columns], strict=True))
                n += batch.num_rows
            db.execute(f"CREATE INDEX by_{key} ON {table} ({key})")
            db.commit()
            whole = f"{folder}/shard-{TaskContext.get().partitionId():05d}.db"
            shutil.copyfile(f"{own}/shard.db", part := f"{whole}.{uuid.uuid4().hex}")
            os.replace(part, whole)
        yield pa.RecordBatch.from_pydict({"n": [n]})

    return df.mapInArrow(shard, "n long").agg(F.sum("n")).first()[0] or 0


def read_sqlite(spark: SparkSession, path: str, query: str, schema: T.StructType, split: str, rows: int = 100_000) -> DataFrame:
    """Rows of a SQL query over all shards of a crawl database, numbers and texts as in ``schema``.

    Each task reads a range of about ``rows`` rows of a shard by ``split``, a column of the query; nulls are in the first range. Shards
    are opened for reading only, so all machines may read one at once. The driver sees only the ranges.
    """
    names = schema.names

    def opened(uri: str) -> sqlite3.Connection:
        return sqlite3.connect(f"file:{quote(_mounted(unquote(uri)))}?mode=ro&immutable=1", uri=True)

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbered = f"SELECT {split} AS x, row_number() OVER (ORDER BY {split}) AS k FROM ({query}) q WHERE {split} IS NOT NULL"
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                with contextlib.closing(opened(uri)) as db:
                    cuts = [x for (x,) in db.execute(f"SELECT DISTINCT x FROM ({numbered}) WHERE k % ? = 0 ORDER BY x", (rows,))]
                yield pa.RecordBatch.from_arrays([pa.array([uri] * (len(cuts) + 1)), pa.array([None, *cuts], pa.int64()), pa.array([*cuts, None], pa.int64())], names=["path", "low", "high"])

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for uri, low, high in batch.astype(object).where(batch.notna(), None).itertuples(index=False):
                bounds = [(f"{split} {sign} ?", int(x)) for sign, x in ((">=", low), ("<", high)) if x is not None]
                where = " AND ".join(b for b, _ in bounds) or "true"
                if low is None:
                    where = f"({where}) OR {split} IS NULL"
                with contextlib.closing(opened(uri)) as db:
                    found = db.execute(f"SELECT {', '.join(names)} FROM ({query}) q WHERE {where}", [x for _, x in bounds])
                    while some := found.fetchmany(20_000):
                        yield pd.DataFrame(some, columns=names, dtype=object)

    shards = spark.read.format("binaryFile").load(path, pathGlobFilter="*.db").select("path")
    cut = [(r["path"], *(None if r[x] is None else str(r[x]) for x in ("low", "high"))) for r in shards.mapInArrow(ranges, "path string, low long, high long").collect()]
    return spark.createDataFrame(cut, "path string, low string, high string").repartition(max(1, len(cut))).mapInPandas(read, schema)


def write_buckets(df: DataFrame, path: str, year: str = "year") -> None:
    """One Parquet folder a year, 'unknown' for undated rows."""
    df.withColumn(year, F.coalesce(F.col(year).cast("string"), F.lit("unknown"))).write.mode("overwrite").partitionBy(year).parquet(path)


def rewrite_buckets(df: DataFrame, path: str, bucket: str) -> None:
    """Replaces only the buckets that ``df`` holds."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(bucket).parquet(path)


def export_forms(df: DataFrame, path: str, kind: str = "class", raw: DataFrame | None = None) -> None:
    """A classified table in several forms: clean (valid rows), with unknown ones, all, as CSV with a header and as Parquet."""
    forms = {"clean": df.filter(F.col(kind) == "valid"), "with_unknown": df.filter(F.col(kind).isin("valid", "unknown")), "all": df}
    if raw is not None:
        forms["raw"] = raw
    for name, form in forms.items():
        form.write.mode("overwrite").option("header", True).csv(f"{path}/{name}_csv")
        form.write.mode("overwrite").parquet(f"{path}/{name}")


def pack_parallel(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """A small sorted table as parallel arrays, for the serving edge."""
    rows = df.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(*columns))).alias("_r"))
    return rows.select(*by, *[F.col(f"_r.{c}").alias(c) for c in columns])


def last_by_file(df: DataFrame, key: Sequence[str], batch: str = "batch") -> DataFrame:
    """Rows of the last file that holds their key."""
    w = Window.partitionBy(*key)
    return df.withColumn("_b", F.max(batch).over(w)).filter(F.col(batch) == F.col("_b")).drop("_b")
