"""Phrase collocations from a weighted de Bruijn graph of words.

Nodes are overlapping runs of words, edges the longest grams (five words), weighted by their occurrences; an occurrence that a piece's
end cuts short is a shorter edge, the correction of that end. The flow of a node, which is the count of its phrase, is the weight of
all edges that begin with it. A node whose whole flow runs through one neighbour lies on a unary path and is compacted into that
longer phrase.

Edges are only needed where every two neighbouring words are frequent, as no phrase that is frequent holds a rarer pair. A first pass
adds up pairs in hashed counters; a pair whose counter stays under the least count is rare for certain, and edges end before it, as
at a piece's end. Counters are ``2**BITS`` whatever the input; where they are crowded fewer edges are cut short, with equal counts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordscope.llm.common import durable
from recordscope.llm.tokens import BREAK, WordHashes, slices

ORDER = 5
LEAST = 100
TOP = 2000
#: Counters of word pairs; their bitmap is of 32 MB.
BITS = 28
#: Counters of a block (one row of the bitmap).
BLOCK_BITS = 16
#: Distinct edges that a task gathers before it hands them on.
HELD = 200_000
#: Word pairs that a task gathers before it counts them.
PAIRS = 1 << 22
# Ends of pieces.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans(PIECE_ENDS + b"\t", BREAK * len(PIECE_ENDS) + b" ")
_U = np.uint64
_FIRST, _SECOND = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Iterator[list[bytes]]]]:
    """(language, lists of words) of batches of (lang, text); ``BREAK`` stands between pieces and texts, lists of a language follow each other."""

    def lists(texts: list[str]) -> Iterator[list[bytes]]:
        for text in texts:
            data = text.encode("utf-8", "replace").lower().translate(_TABLE).replace(BREAK, b" \xff ")
            for part in slices(data):
                yield part.split()
            yield [BREAK]

    def together(texts: list[str], size: int = 1 << 18) -> Iterator[str]:
        """Short texts joined, as a piece's end stands for a text's."""
        held: list[str] = []
        chars = 0
        for t in texts:
            held.append(t)
            chars += len(t)
            if chars >= size:
                yield "\n".join(held)
                held, chars = [], 0
        if held:
            yield "\n".join(held)

    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lang in dict.fromkeys(langs):
            yield lang, lists(list(together([t for x, t in zip(langs, texts, strict=True) if x == lang])))


def _pair_counters(lang: str, hashes: np.ndarray, bits: int) -> np.ndarray:
    """Counter of each word with the one after it."""
    seed = _U(int.from_bytes(lang.encode()[:8], "little") * int(_FIRST) % (1 << 64))
    return (_mix(hashes[:-1] * _FIRST + hashes[1:] * _SECOND + seed) >> _U(64 - bits)).astype(np.int64)


def _count_pairs(bits: int):
    """(block, slots, counts) of batches of (lang, text): counters that were met, and how often, as packed numbers (counts up to 255)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        held: list[np.ndarray] = []
        size = 0

        def rows() -> pa.RecordBatch:
            slot, n = np.unique(np.concatenate(held), return_counts=True)
            block, first = np.unique(slot >> BLOCK_BITS, return_index=True)
            low, n = (slot & ((1 << BLOCK_BITS) - 1)).astype("<u2"), np.minimum(n, 255).astype(np.uint8)
            ends = np.append(first, len(slot))
            cut = [(low[a:b].tobytes(), n[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(block, pa.int32()), pa.array([c[0] for c in cut], pa.binary()), pa.array([c[1] for c in cut], pa.binary())], names=["block", "slots", "counts"])

        for lang, lists in _streams(batches):
            last: list[bytes] = []
            for words in lists:
                words = last + words
                last = words[-1:]
                hashes = known.of(words)
                stop = hashes == 0
                pair = ~(stop[:-1] | stop[1:])
                held.append(_pair_counters(lang, hashes, bits)[pair])
                size += len(held[-1])
                if size >= PAIRS:
                    yield rows()
                    held, size = [], 0
        if size:
            yield rows()

    return run


def _frequent_slots(least: int):
    """(block, bitmap) of rows of (block, slots, counts): counters that reach ``least``. Rows stream through; a block has 64 KB of sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, slots, counts in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                own = sums.setdefault(block, np.zeros(1 << BLOCK_BITS, dtype=np.uint16))
                at = np.frombuffer(slots, dtype="<u2")
                # slots of a row are distinct; sums stay where they are once large enough
                own[at] = np.minimum(own[at] + np.frombuffer(counts, dtype=np.uint8), 60_000)
        some = [(block, np.packbits(own >= least).tobytes()) for block, own in sums.items() if (own >= least).any()]
        yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in some], pa.int32()), pa.array([m for _, m in some], pa.binary())], names=["block", "bitmap"])

    return run


def _edges(order: int, bits: int, bitmap):
    """(lang, gram, n) of batches of (lang, text): from each word the longest run of frequent pairs, of ``order`` words at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        flags = bitmap.value
        held: Counter = Counter()

        def rows() -> pa.RecordBatch:
            grams = pa.array([g for _, g in held], pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in held], pa.string()), grams, pa.array(list(held.values()), pa.int64())], names=["lang", "gram", "n"])

        def settle(lang: str, words: list[bytes], whole: bool) -> list[bytes]:
            """Counts the edges that begin at ``words``, but for the last few if more words follow, which are returned."""
            if len(words) < 2 and not whole:
                return words
            hashes = known.of(words)
            stop = hashes == 0
            on = np.zeros(len(words), dtype=bool)
            slot = _pair_counters(lang, hashes, bits)
            on[:-1] = ~(stop[:-1] | stop[1:]) & ((flags[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1).astype(bool)
            size = (~stop).astype(np.int64)
            run = on.copy()
            for k in range(1, order):
                size += run
                run[:-k] &= on[k:]
                run[len(run) - k :] = False
            rest = 0 if whole else min(order - 1, len(words))
            size = size[: len(words) - rest]
            for k in range(1, order + 1):
                at = np.flatnonzero(size == k).tolist()
                held.update((lang, words[i] if k == 1 else b" ".join(words[i : i + k])) for i in at)
            return words[len(words) - rest :]

        for lang, lists in _streams(batches):
            last: list[bytes] = []
            for words in lists:
                last = settle(lang, last + words, False)
                if len(held) >= HELD:
                    yield rows()
                    held.clear()
            settle(lang, last, True)
        if held:
            yield rows()

    return run


def frequent_pairs(docs: DataFrame, least: int, bits: int = BITS) -> np.ndarray:
    """Bitmap of the ``2**bits`` counters of word pairs (first bit of a byte first): those that reach ``least``, at most 32 MB."""
    counted = docs.mapInArrow(_count_pairs(bits), "block int, slots binary, counts binary")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = counted.repartition(parts, "block").mapInArrow(_frequent_slots(least), "block int, bitmap binary").collect()
    out = np.zeros(1 << max(0, bits - 3), dtype=np.uint8)
    width = 1 << (BLOCK_BITS - 3)
    for r in rows:
        own = np.frombuffer(r["bitmap"], dtype=np.uint8)
        out[r["block"] * width : (r["block"] + 1) * width] = own[: len(out) - r["block"] * width]
    return out


def _words(phrase: Column, k: Column) -> Column:
    """The first ``k`` words of a phrase, or the last if ``k`` is negative."""
    return F.call_function("substring_index", phrase, F.lit(" "), k.cast("int"))


def phrase_flows(docs: DataFrame, least: int = LEAST, order: int = ORDER, bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, k, f) of the phrases of 1 to ``order`` words that occur ``least`` times; (lang, n) words of each language).

    ``docs`` has (lang, text), neither of them null.
    """
    bitmap = docs.sparkSession.sparkContext.broadcast(frequent_pairs(docs, least, bits))
    edges = durable(docs.mapInArrow(_edges(order, bits, bitmap), "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    bitmap.unpersist()
    nodes = F.transform(F.sequence(F.lit(1), F.size(F.split("gram", " "))), lambda k: F.struct(k.alias("k"), _words(F.col("gram"), k).alias("phrase")))
    flows = edges.select("lang", "n", F.explode(nodes).alias("v")).groupBy("lang", "v.phrase", "v.k").agg(F.sum("n").alias("f"))
    return durable(flows.filter(F.col("f") >= least)), edges.groupBy("lang").agg(F.sum("n").alias("n"))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, order: int = ORDER, lang_col: str = "lang", text_col: str = "text", bits: int = BITS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of each language.

    Words are lower-cased in A-Z; a null language is ``und``, a null or empty text has no words, repeated rows count as often as they
    come, texts of any length are read in slices. Phrases of 2 to ``order`` words that occur ``least`` times are scored by the cut into
    two parts that explains them best; ties go to the shorter first part, equal scores to more occurrences, then to the phrase in
    byte order. Other columns are ignored; no rows, or no frequent phrases, give no rows.
    """
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text")).filter("text is not null")
    flows, totals = phrase_flows(texts, least, order, bits)
    longer = flows.filter("k > 1")
    # a node keeps its flow along one edge: it is compacted into the phrase that is a word longer
    begin, end = _words(F.col("phrase"), F.col("k") - 1), _words(F.col("phrase"), 1 - F.col("k"))
    through = longer.select("lang", "f", F.explode(F.array(begin, end)).alias("phrase")).groupBy("lang", "phrase").agg(F.max("f").alias("through"))
    kept = longer.join(through, ["lang", "phrase"], "left").filter(F.coalesce("through", F.lit(0)) < F.col("f"))
    cut = F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")
    parts = kept.select("lang", "phrase", "k", F.col("f").alias("a"), cut)
    parts = parts.withColumns({"first": _words(F.col("phrase"), F.col("cut")), "rest": _words(F.col("phrase"), F.col("cut") - F.col("k"))})
    count = lambda part, name: flows.select("lang", F.col("phrase").alias(part), F.col("f").alias(name))
    scored = parts.join(count("first", "l"), ["lang", "first"]).join(count("rest", "r"), ["lang", "rest"]).join(totals, "lang")
    score = F.expr("(1000 * cast(a as decimal(16, 0)) * cast(n as decimal(16, 0))) div (cast(l as decimal(16, 0)) * cast(r as decimal(16, 0)))")
    best = scored.withColumn("score", score).groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("b"))
    rows = best.select("lang", "phrase", "a", "b.l", "b.r", "n", "b.score")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase"))
    return rows.withColumn("rank", place.cast("long")).filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark, sf_dir: str) -> DataFrame:
    """Query: the first 2000 phrases of each language of all ``documents``."""
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "text"))
