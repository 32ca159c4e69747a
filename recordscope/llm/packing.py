"""Packing documents into sequences along a space-filling curve.

A document's tokens are counted in hashed buckets, the counts are projected to a few dimensions and the point's Hilbert index
is the sort key. Token tables are written once, range-partitioned by (key, hash of the row) into partitions of a number that follows
from their bytes, and sorted; each partition lays its documents end to end and cuts every ``length`` ids, so a sequence holds
neighbours along the curve and only the last sequence of a partition needs padding. Sequence numbers follow from the partitions'
counts. Equal documents share a key, but the hash of their row numbers splits them over partitions. Bounds of ranges are sampled, so
the numbers of sequences may differ between runs; pieces always hold every id once.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordscope.llm.common import durable

LENGTH = 1024
BUCKETS = 256
DIMS = 4
BITS = 10
END_ID = 0
#: Bytes of token ids that a partition should hold, and partitions at most; beyond their product partitions grow.
PART_BYTES = 16 << 20
PARTS = 1 << 15
#: Characters in a row without a change between white space and other characters, from which the named tokenizer itself is used.
RUN = 10_000


def has_long_run(text: str, run: int = RUN) -> bool:
    """Whether a run of ``run`` characters, all white space or none, stands in a text; shorter ones of half that length may count.

    A run that long holds a whole block of half its length, and a block is told by its first change.
    """
    half = run // 2
    for at in range(0, len(text) - half + 1, half):
        block = text[at : at + half]
        if block.isspace() or len(block.split(None, 1)[0]) == half:
            return True
    return False


class Encoder:
    """Ids as the named tokenizer gives them without special tokens added: strings of its added tokens become their ids, the text
    between them is encoded by itself.

    The merges are done by a byte-level rank encoder with the same vocabulary, which is several times faster than the tokenizer
    but fails on very long runs of one kind of characters. Texts with such runs, and any on which it fails, go to the tokenizer.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            model = json.load(f)
        added = model.get("added_tokens") or []
        if any(t.get(flag) for t in added for flag in ("lstrip", "rstrip", "single_word")) or model.get("normalizer"):
            raise ValueError("added tokens that take their surroundings and normalizers are not supported")
        self.added = {t["content"]: t["id"] for t in added}
        # printable stand-ins of bytes in byte-level vocabularies: printable characters stand for themselves, the others follow from 256 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(plain))}
        ranks = {bytes(byte[c] for c in w): i for w, i in model["model"]["vocab"].items() if w not in self.added}
        self._plain = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self._path, self._named = path, None
        self._split = re.compile("(" + "|".join(re.escape(w) for w in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None

    def named(self, text: str) -> list[int]:
        if self._named is None:
            from tokenizers import Tokenizer

            self._named = Tokenizer.from_file(self._path)
        return self._named.encode(text, add_special_tokens=False).ids

    def encode(self, text: str) -> list[int]:
        if has_long_run(text):
            return self.named(text)
        try:
            return self._fast(text)
        except BaseException as e:
            # the encoder's panics are no Exceptions
            if not isinstance(e, Exception) and type(e).__name__ != "PanicException":
                raise
            return self.named(text)

    def _fast(self, text: str) -> list[int]:
        if self._split is None or not any(w in text for w in self.added):
            return self._plain(text)
        out: list[int] = []
        for k, part in enumerate(self._split.split(text)):
            if k % 2:
                out.append(self.added[part])
            elif part:
                out += self._plain(part)
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@lru_cache(maxsize=1)
def _projection() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(11)
    return rng.integers(0, BUCKETS, 1 << 16), rng.standard_normal((BUCKETS, DIMS))


def hilbert_index(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Index along the Hilbert curve of integer points (rows) of ``bits`` bits a coordinate."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    # from the top bit down, undo the turn and mirror that each level of the curve applies to the levels below it
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for i in range(n):
            high = (x[i] >> level) & 1 == 1
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
    # Gray code to binary over the bits in curve order
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((x[n - 1] >> level) & 1 == 1, (1 << level) - 1, 0)
    x ^= flip
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> level) & 1)
    return key


def curve_keys(documents: list[np.ndarray]) -> np.ndarray:
    """Hilbert key of each list of token ids; lists without ids count as the origin."""
    bucket, project = _projection()
    counts = np.zeros((len(documents), BUCKETS))
    for row, ids in zip(counts, documents, strict=True):
        row += np.bincount(bucket[ids], minlength=BUCKETS)
    vector = np.sqrt(counts)
    vector /= np.maximum(np.linalg.norm(vector, axis=1, keepdims=True), 1e-12)
    point = np.floor((1 << BITS) * (0.5 + 0.5 * np.tanh(vector @ project / 1.5)))
    return hilbert_index(np.clip(point, 0, (1 << BITS) - 1).astype(np.int64))


def _tokenise(vocabulary: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                ids = [np.array(encode(t or "") + [END_ID], dtype="<u2") for t in part.column(1).to_pylist()]
                key = curve_keys([x[:-1] for x in ids])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([x.tobytes() for x in ids], pa.binary()), pa.array(key, pa.int64())], names=["doc_id", "ids", "key"])

    return run


def _lay(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, part = 0, TaskContext.get().partitionId()
        for batch in batches:
            doc, start, size, crc, total, seq, offset = [], [], [], [], [], [], []
            for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.frombuffer(raw, dtype="<u2").astype("<u4").tobytes()
                n, s = len(ids) // 4, 0
                while s < n:
                    take = min(n - s, length - at % length)
                    doc.append(doc_id)
                    start.append(s)
                    size.append(take)
                    crc.append(zlib.crc32(ids[4 * s : 4 * (s + take)]))
                    total.append(n)
                    seq.append(at // length)
                    offset.append(at % length)
                    at += take
                    s += take
            columns = (doc, start, size, crc, total, seq, offset, [part] * len(doc))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "local", "offset", "part"])

    return run


def pack_along_curve(docs: DataFrame, length: int = LENGTH, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) that hold every id of every document once.

    A document is its ids and an end id; a null or empty text is the end id alone. Repeated rows are packed as often as they
    come; a null id stays null. An empty table gives no pieces. Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    tokens = durable(rows.mapInArrow(_tokenise(vocabulary or default_vocabulary()), "doc_id long, ids binary, key long"))
    order = ["key", "tie"]
    size = tokens.agg(F.sum(F.octet_length("ids"))).first()[0] or 0
    tied = tokens.withColumn("tie", F.xxhash64("doc_id", F.monotonically_increasing_id()))
    parts = min(PARTS, 1 + size // PART_BYTES)
    ranged = tied.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "ids")
    pieces = durable(ranged.mapInArrow(_lay(length), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, local long, offset long, part long"))
    counts = pieces.groupBy("part").agg((F.max("local") + 1).alias("sequences"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = durable(counts.select("part", F.coalesce(F.sum("sequences").over(before), F.lit(0)).alias("base")))
    return pieces.join(base, "part").select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("base") + F.col("local")).alias("sequence_id"), "offset")


def op8_curve_packing(spark, sf_dir: str) -> DataFrame:
    """Query: all ``documents`` packed into sequences of at most 1024 ids."""
    return pack_along_curve(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
