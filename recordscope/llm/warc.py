"""WARC records and Merkle fixity audit of replicas.

Records are hashed one by one where they are read; what is numbered, shuffled and compared from there on are digests and lengths.
Every ``FANOUT`` neighbouring hashes of a file are hashed to a node that covers their offset range, level by level up to one root a
file. An audit compares roots and goes down only below nodes that differ, so the hashes that two intact replicas exchange are one
per file.
"""

from __future__ import annotations

import gzip
import io
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordscope.llm.common import durable

FANOUT = 16
RECORDS_PER_FILE = 1_000
#: Pages without an id are named by their content and dealt to this many files, whose numbers lie below those of ids.
NAMELESS_FILES = 4_096
NAMELESS = -(1 << 62)
END = b"\r\n\r\n"


def record_bytes(url: Column, payload: Column) -> Column:
    """A response record: header lines, an empty line, the payload and the closing two line ends."""
    body = F.encode(F.coalesce(payload, F.lit("")), "UTF-8")
    head = F.concat(F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")), F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(F.encode(head, "UTF-8"), body, F.lit(END))


def floor_div(c: str, by: int) -> Column:
    """``c`` divided by ``by``, rounded down, in whole numbers."""
    return F.expr(f"{c} div {by} - if({c} % {by} < 0, 1, 0)")


def to_records(pages: DataFrame, per_file: int = RECORDS_PER_FILE, payload: bool = True) -> DataFrame:
    """(file, record_no, offset, length, digest, record) of pages: ``per_file`` (4 or more) consecutive ids make a file.

    Without ``payload`` the record itself is left out, so only its digest is shuffled. Null urls and payloads are empty. Repeated
    ids follow one another by digest. Pages with a null id go to one of ``NAMELESS_FILES`` files by their digest. Records are numbered
    by sorted ranges, so a file of very many (a repeated id, pages without ids) is spread over many tasks.
    """
    if per_file < 4:
        raise ValueError("a file holds 4 ids or more")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), record_bytes(F.col("url"), F.col("html")).alias("record"))
    rows = rows.select("page_id", F.octet_length("record").cast("long").alias("length"), F.sha2("record", 256).alias("digest"), *(["record"] if payload else []))
    nameless = F.lit(NAMELESS) + F.pmod(F.xxhash64("digest"), F.lit(NAMELESS_FILES))
    rows = rows.withColumn("file", F.coalesce(floor_div("page_id", per_file), nameless))
    # equal records are told apart by where they were read, so that they too fall into several ranges
    order = ["file", "page_id", "digest", "_place"]
    placed = rows.withColumn("_place", F.monotonically_increasing_id())
    ranged = durable(placed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()))
    inside = Window.partitionBy("file", "_part").orderBy(*order[1:])
    sizes = ranged.groupBy("file", "_part").agg(F.count("*").alias("_n"), F.sum("length").alias("_bytes"))
    before = Window.partitionBy("file").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("file", "_part", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in ("_n", "_bytes")])
    told = ranged.withColumns({"_k": F.row_number().over(inside) - 1, "_at": F.coalesce(F.sum("length").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))}).join(sizes, ["file", "_part"])
    number, offset = (F.col("_n") + F.col("_k")).cast("long"), (F.col("_bytes") + F.col("_at")).cast("long")
    return told.select("file", number.alias("record_no"), offset.alias("offset"), "length", "digest", *(["record"] if payload else []))


def merkle_levels(records: DataFrame, fanout: int = FANOUT) -> list[DataFrame]:
    """Levels of (file, no, start, end, hash), leaves first; each level covers ``fanout`` nodes of the one below.

    A record's leaf hashes its offset with its digest, so a record that moved differs. Empty input gives an empty leaf level.
    """
    leaf = F.sha2(F.concat_ws(":", F.col("offset").cast("string"), "digest"), 256)
    level = durable(records.select("file", F.col("record_no").alias("no"), F.col("offset").alias("start"), (F.col("offset") + F.col("length")).alias("end"), leaf.alias("hash")))
    levels, top = [level], level.agg(F.max("no")).first()[0]
    while top:
        top //= fanout
        kids = F.array_sort(F.collect_list(F.struct("no", "hash")))
        up = level.groupBy("file", floor_div("no", fanout).alias("up")).agg(F.min("start").alias("start"), F.max("end").alias("end"), kids.alias("kids"))
        # a node stands for up to ``fanout`` nodes, at least one
        level = durable(up.select("file", F.col("up").alias("no"), "start", "end", F.sha2(F.array_join(F.col("kids.hash"), ""), 256).alias("hash")))
        levels.append(level)
    return levels


def audit(ours: list[DataFrame], theirs: list[DataFrame], fanout: int = FANOUT) -> DataFrame:
    """(file, record_no, start, end, status) of records that differ between two trees of ``merkle_levels``.

    ``status`` is changed, missing (only ours) or extra (only theirs). Each step joins the children of differing nodes only; the
    differing nodes of a level, which are few beside it, meet the level below by file and parent.
    """
    suspect = None
    for level in range(max(len(ours), len(theirs)) - 1, -1, -1):
        a, b = (t[level] if level < len(t) else t[0].limit(0) for t in (ours, theirs))
        a, b = (t.withColumn("up", floor_div("no", fanout)) for t in (a, b))
        if suspect is not None:
            a, b = (t.join(suspect, ["file", "up"], "left_semi") for t in (a, b))
        a, b = (t.select("file", "no", F.struct("start", "end", "hash").alias(name)) for t, name in ((a, "a"), (b, "b")))
        differ = durable(a.join(b, ["file", "no"], "full").filter(~F.col("a.hash").eqNullSafe(F.col("b.hash"))))
        suspect = differ.select("file", F.col("no").alias("up"))
    status = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "extra").otherwise("changed")
    return differ.select("file", F.col("no").alias("record_no"), F.coalesce("a.start", "b.start").alias("start"), F.coalesce("a.end", "b.end").alias("end"), status.alias("status"))


def stream_warc(data: io.BufferedIOBase) -> Iterator[tuple[int, int, str | None, bytes | None, str | None]]:
    """(offset, length, target, payload, error) of the records of an uncompressed stream, one record in memory at a time.

    A record without a usable length, or that ends early, is the last of its stream: its error says why (null for good records),
    its target and payload are null. Targets that are not UTF-8 get replacement characters.
    """
    at = 0
    while True:
        size, used, head, error = None, 0, {}, None
        try:
            line = data.readline()
            while line in (b"\r\n", b"\n"):  # spare line ends between records
                at += len(line)
                line = data.readline()
            if not line:
                return
            used = len(line)
            if not line.startswith(b"WARC/"):
                error = "no record begins here"
            while error is None:
                line = data.readline()
                used += len(line)
                if line in (b"\r\n", b"\n"):
                    break
                if not line:
                    error = "header ends early"
                name, _, value = line.partition(b":")
                head[name.strip().lower()] = value.strip()
            told = head.get(b"content-length", b"")
            size = int(told) if told.isdigit() else None
            if error is None and size is None:
                error = "no length"
            if error is None:
                payload = data.read(size)
                used += len(payload)
                if len(payload) < size:
                    error = "payload ends early"
            if error is None:
                closing = data.read(len(END))
                used += len(closing)
                if closing != END:
                    error = "no record end"
        except (EOFError, OSError, zlib.error) as e:
            error = f"broken compression: {type(e).__name__}"
        if error is not None:
            yield at, used, None, None, error
            return
        yield at, used, head.get(b"warc-target-uri", b"").decode("utf-8", "replace"), payload, None
        at += used


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(path, record_no, offset, length, url, payload, error) of all records of .warc and .warc.gz files.

    One task reads a file: its stored bytes are in memory, decompressed record by record. Damage gives a row with an error, as
    ``stream_warc`` says, and never ends the job.
    """
    names = ["path", "record_no", "offset", "length", "url", "payload", "error"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.string()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                stored = pa.BufferReader(raw.as_buffer())
                packed = raw.as_buffer()[:2].to_pybytes() == b"\x1f\x8b"
                data = gzip.GzipFile(fileobj=stored) if packed else io.BufferedReader(stored)
                part: list[tuple] = []
                held = 0
                for k, (at, length, url, payload, error) in enumerate(stream_warc(data)):
                    part.append((name, k, at, length, url, payload, error))
                    held += length
                    if len(part) == 500 or held > 8 << 20:
                        yield batch_of(part)
                        part, held = [], 0
                if part:
                    yield batch_of(part)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc*").load(path).select("path", "content")
    return files.mapInArrow(run, "path string, record_no long, offset long, length long, url string, payload binary, error string")


def op2_fixity_audit(spark, sf_dir: str) -> DataFrame:
    """Query: all ``pages`` as WARC files against a replica with damage.

    The replica's payload is altered where the id leaves 13 when divided by 97, and its files whose number leaves 1 when
    divided by 3 have lost the records after the first 900 of their ids.
    """
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    damaged = pages.withColumn("html", F.when(F.col("page_id") % 97 == 13, F.translate("html", "e", "3")).otherwise(F.col("html")))
    lost = (floor_div("page_id", RECORDS_PER_FILE) % 3 == 1) & (F.col("page_id") % RECORDS_PER_FILE >= 900)
    ours, theirs = (to_records(p, payload=False) for p in (pages, damaged.filter(F.coalesce(~lost, F.lit(True)))))
    return audit(merkle_levels(ours), merkle_levels(theirs))
