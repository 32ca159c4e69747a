"""Mixing sources to target weights by systematic sampling, in DataFrame functions only.

Each source has a target size; every document of a source has the same expected number of copies, target / source size.
Documents stand in a fixed order within their source (size class, then a hash), their expected copies are summed along it,
one offset per source is added, and a document is emitted once for each integer that its step crosses. As the order is by size
class, the words taken stay close to the target. The order is a range partitioning whose keys end with the row's number, so a hot
source and rows that are equal in all else are split like others; a row's rank is its place in its partition plus the rows of the
source in earlier partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordscope.llm.common import durable, row_key, words

#: Steps of the offset; a power of two, so that adding it to a rank is exact.
OFFSET_STEPS = 1 << 20
#: Bytes of kept columns, and rows, that a range should hold.
PART_BYTES, PART_ROWS = 64 << 20, 500_000


def _size_class(size: Column) -> Column:
    """Number of digits and first two digits of a size: classes about 10 % wide."""
    s = size.cast("string")
    return (F.length(s) * 100 + F.rpad(s, 2, "0").substr(1, 2).cast("int")).cast("int")


def source_targets(sized: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share_percent: int = 150, most: int = 2) -> DataFrame:
    """(source, number, source_size, target): shares by weight, cut at ``most`` times a source, the rest reshared.

    Sources go by code point, null last; their weights repeat. With sources ordered by how soon they reach their limit, the
    limited ones are a prefix, so the final level follows from running sums. The window over all sources sees one row per source.
    """
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.pmod(F.col("number") - 1, F.lit(len(weights))) + 1).cast("int")).cast("long")
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    per = per.withColumn("number", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))).withColumn("weight", w)
    # sizes in hundredths, so that all comparisons are of whole numbers
    by_limit = Window.orderBy(F.col("source_size") / F.col("weight"), "number")
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_limit.rowsBetween(0, Window.unboundedFollowing)
    limit = F.col("source_size") * (100 * most)
    per = (
        per.withColumn("all_size", F.sum("source_size").over(Window.partitionBy()))
        .withColumn("left", F.col("all_size") * share_percent - F.coalesce(F.sum(limit).over(before), F.lit(0)))
        .withColumn("open", F.sum("weight").over(onward))
        .withColumn("cut", limit * F.col("open") <= F.col("weight") * F.col("left"))
        .withColumn("level", F.min(F.when(~F.col("cut"), F.struct(F.col("source_size") / F.col("weight"), "number", "left", "open"))).over(Window.partitionBy()))
    )
    even = F.col("weight") * F.col("level.left") / (F.lit(100.0) * F.col("level.open"))
    target = F.when(F.col("cut"), (F.col("source_size") * most).cast("double")).otherwise(even)
    return per.select("source", "number", "source_size", target.alias("target"))


def mix_sources(docs: DataFrame, keep: tuple[str, ...] = (), weights: tuple[int, ...] = (3, 1, 2), share_percent: int = 150, most: int = 2, seed: int = 7) -> DataFrame:
    """One row per document: doc_id, ``keep`` columns, size, source_size, target, copies, taken = copies * size.

    Needs doc_id, text, source. A null text has size 0. A null source is a source of its own, a null doc_id sorts first. An
    empty table gives no rows. Repeated rows each count; equal rows may swap places, which leaves the result as it is. Runs agree
    with each other, however the input is parted.
    """
    kept = [F.col(c).alias(f"keep_{c}") for c in keep]
    # null ids share a hash, and repeated ids theirs: the text tells them apart, and what is left is equal rows
    told = [F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("mark"), F.xxhash64("text").alias("tie")]
    sized = durable(docs.select(*kept, F.col("doc_id").cast("long").alias("doc_id"), F.col("source"), F.size(words(F.col("text"))).cast("long").alias("size"), *told, F.monotonically_increasing_id().alias("row")))
    targets = durable(source_targets(sized, weights, share_percent, most))
    weight = F.octet_length("keep_text") if "text" in keep else F.lit(0)
    rows, size = sized.agg(F.count("*"), F.coalesce(F.sum(weight), F.lit(0))).first()
    order = ["number", "class", "mark", "doc_id", "size", "tie", "row"]
    placed = sized.join(targets, sized["source"].eqNullSafe(targets["source"])).drop("source").withColumn("class", _size_class(F.col("size")))
    ranged = placed.repartitionByRange(1 + max(rows // PART_ROWS, size // PART_BYTES), *order).sortWithinPartitions(*order)
    # the number of a row that Spark gives here is its partition in the upper bits and its place there in the lower 33
    laid = durable(ranged.withColumn("seat", F.monotonically_increasing_id()).drop("mark", "tie", "row", "class"))
    part = F.shiftright("seat", 33).alias("part")
    before = Window.partitionBy("number").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = laid.groupBy("number", part).agg(F.count("*").alias("rows"), F.min("seat").alias("first"))
    starts = durable(counts.select("number", "part", "first", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("earlier")))
    ranked = laid.withColumn("part", part).join(starts, ["number", "part"]).withColumn("rank", F.col("earlier") + F.col("seat") - F.col("first") + 1)
    start = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("number").cast("string"))), 1, 5), 16, 10).cast("double") / OFFSET_STEPS
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    crossed = F.floor(start + rate * F.col("rank")) - F.floor(start + rate * (F.col("rank") - 1))
    copies = F.least(crossed, F.ceil(rate)).cast("long")
    return ranked.select("doc_id", *[F.col(f"keep_{c}").alias(c) for c in keep], "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, all columns, each as often as the mix takes it; ``options`` go to ``mix_sources``.

    Copies are counted by a key of the rows' content, so texts meet their number in one join. Equal rows share a number, the sum
    of theirs.
    """
    keyed = docs.withColumn("_key", row_key(docs.columns))
    taken = mix_sources(keyed, keep=("_key",), **options).groupBy("_key").agg(F.sum("copies").cast("int").alias("_copies")).filter("_copies > 0")
    met = keyed.join(durable(taken), "_key").dropDuplicates(["_key"])
    return met.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(docs.columns)


def op3_source_mix(spark, sf_dir: str) -> DataFrame:
    """Query: the mix of all ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")
