"""Incremental jobs: each is a function of a batch and a table, and a foreachBatch writer around it.

Tables are Parquet folders partitioned by a bucket column. A writer replaces whole buckets, so a batch that is replayed
after a failure gives the same table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType

from recordscope.operators.quality import reconcile_sheets
from recordscope.sources.io import or_nothing, rewrite_buckets


def unseen(batch: DataFrame, known: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows of new keys only, the first of each key in the batch."""
    k = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return batch.join(known.select(*key), list(key), "left_anti").withColumn("_k", k).filter("_k = 1").drop("_k")


def fill_nulls(old: DataFrame, new: DataFrame, key: Sequence[str], fields: Sequence[str], wins: Sequence[str] = ()) -> DataFrame:
    """Upsert by key that fills what is null and never blanks a value; for ``wins`` fields a new value replaces the old one."""
    right = new.select(*key, *[F.col(f).alias(f"_{f}") for f in fields])
    take = lambda f: F.coalesce(f"_{f}", f) if f in wins else F.coalesce(f, f"_{f}")
    return old.join(right, list(key), "full").select(*key, *[take(f).alias(f) for f in fields])


def replace_trailing(old: DataFrame, new: DataFrame, date: str, days: int) -> DataFrame:
    """New rows replace all old ones of the last ``days`` days up to the newest new date; older new rows are ignored."""
    bound = new.agg(F.date_sub(F.max(date), days - 1).alias("_from"))
    keep = old.join(F.broadcast(bound), F.col("_from").isNull() | (F.col(date) < F.col("_from")), "inner").drop("_from")
    return keep.unionByName(new.join(F.broadcast(bound), F.col(date) >= F.col("_from"), "left_semi"))


def replace_keys(old: DataFrame, new: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """A key that comes again replaces its old rows; inside the batch the last one counts."""
    k = F.row_number().over(Window.partitionBy(*key).orderBy(*[F.col(c).desc() for c in order]))
    last = new.withColumn("_k", k).filter("_k = 1").drop("_k")
    return old.join(last.select(*key), list(key), "left_anti").unionByName(last)


def gate(cells: DataFrame, constraints: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(published, review): sheets are deduced, repaired, then judged. Clean ones (no hole, all constraints hold) are published with
    their final values; the others come out as they were read."""
    done = reconcile_sheets(cells, constraints)
    good = done.filter("clean").select("sheet", "row", "col", F.col("value").cast(dict(cells.dtypes)["value"]).alias("value"))
    return good, cells.join(done.filter("not clean").select("sheet").distinct(), "sheet", "left_semi")


def still_to_do(want: DataFrame, done: DataFrame, key: Sequence[str]) -> DataFrame:
    """Wanted keys that no finished record holds."""
    return want.join(done.select(*key).distinct(), list(key), "left_anti")


def settled_counts(events: DataFrame, at: str, delay: str) -> DataFrame:
    """(day, n) of days that the watermark has passed, for append mode."""
    return events.withWatermark(at, delay).groupBy(F.window(at, "1 day")).agg(F.count("*").alias("n")).select(F.to_date("window.start").alias("day"), "n")


def _aside(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to a folder that the next batch overwrites, and read again."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def merge_stream(stream: DataFrame, path: str, checkpoint: str, bucket: str, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> StreamingQuery:
    """Runs all available input through ``merge(table, batch)`` and replaces the buckets of the table that a batch touches.

    Two work tables lie beside the checkpoint and are overwritten by each batch, so they do not pile up.
    """

    def write(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        batch = _aside(batch, f"{checkpoint}-batch")
        touched = batch.select(bucket).distinct()
        old = or_nothing(lambda: spark.read.schema(batch.schema).parquet(path), spark, batch.schema).join(touched, bucket, "left_semi")
        # written aside first: the buckets that are read are the ones that are replaced
        rewrite_buckets(_aside(merge(old, batch).select(batch.columns), f"{checkpoint}-merged"), path, bucket)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def gate_stream(stream: DataFrame, constraints: DataFrame, published: str, review: str, checkpoint: str, manifest: str | None = None) -> StreamingQuery:
    """Clean sheets go to one table, the others to review, both committed by one line of a manifest.

    A batch writes its folder of each table, then its entry of the manifest (``published``-manifest where not given), which lists the
    files of both. Readers use ``read_gated`` and see a batch in both tables or in none. A batch that is replayed before its entry
    stands overwrites its folders; after that it is left alone, so failures of either table at any point give the same two tables.
    """
    manifest = manifest or f"{published}-manifest"

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if not committed(spark, manifest).filter(F.col("batch") == number).isEmpty():
            return
        good, bad = gate(_aside(batch, f"{checkpoint}-batch"), constraints)
        files = []
        for df, folder in ((good, published), (bad, review)):
            df.write.mode("overwrite").parquet(f"{folder}/batch={number}")
            files.append(spark.read.schema(df.schema).parquet(f"{folder}/batch={number}").inputFiles())
        spark.createDataFrame([(number, *files)], ENTRY).coalesce(1).write.mode("append").json(manifest)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


#: An entry of the manifest of a gate.
ENTRY = "batch long, published array<string>, review array<string>"


def committed(spark: SparkSession, manifest: str) -> DataFrame:
    """Entries of a manifest; none where there is no such folder yet."""
    return or_nothing(lambda: spark.read.schema(ENTRY).json(manifest), spark, ENTRY)


def read_gated(spark: SparkSession, manifest: str, table: str, schema: StructType) -> DataFrame:
    """Rows of ``published`` or ``review`` of the batches that the manifest holds."""
    files = [f for r in committed(spark, manifest).select(table).collect() for f in r[table]]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)


def first_seen_stream(stream: DataFrame, path: str, checkpoint: str, key: Sequence[str], at: str, keep: str, bucket: str | None = None) -> StreamingQuery:
    """Appends the first row of each key to a table; later rows of a known key, in whatever bucket, are dropped.

    Known keys are keyed state of the stream, kept until the watermark of ``at`` has passed their first row by ``keep``: a batch costs
    what its own rows cost, however large the table. Rows that come later than the watermark are dropped as too late.
    """
    first = stream.withWatermark(at, keep).dropDuplicatesWithinWatermark(list(key))
    writer = first.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return (writer.partitionBy(bucket) if bucket else writer).start()
