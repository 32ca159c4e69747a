"""Hard-negative mining by exact integer products of anchor and candidate tiles.

Components become integers, so scores are exact and ties are true ties. Anchors and candidates are dealt to blocks by a hash of their
ids, and each pair of an anchor block and a candidate block is a cell of its own: its scores come tile by tile from Strassen's
recursion on int64 matrices padded with zeros, whose sums wrap modulo 2^64 and are therefore exact wherever the score fits a
long. A cell keeps a heap of the first few rows of each anchor; heaps of all cells are merged by Spark. Positives come from cells
of equal labels. Their scores then open windows, and the heaps of the second pass hold the first rows of other labels in each window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordscope.llm.common import durable

#: Rows of an anchor block and of a candidate block.
ANCHORS = 2048
ROWS = 8192
#: Sides of the tiles that are multiplied at once inside a cell.
TILE = (256, 2048)
#: A side up to which matrices are multiplied directly.
LEAF = 32
#: Squared length of an integer vector below which every score fits a long.
MOST = 2.0**62
LOWEST = np.iinfo(np.int64).min


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """Product of two int64 matrices modulo 2^64, by seven products of halves; odd sides are padded with zeros."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        return a @ b
    if m % 2 or k % 2 or n % 2:
        a, b = np.pad(a, ((0, m % 2), (0, k % 2))), np.pad(b, ((0, k % 2), (0, n % 2)))
    r, s, t = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:r, :s], a[:r, s:], a[r:, :s], a[r:, s:]
    b11, b12, b21, b22 = b[:s, :t], b[:s, t:], b[s:, :t], b[s:, t:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * r, 2 * t), dtype=np.int64)
    out[:r, :t] = p1 + p4 - p5 + p7
    out[:r, t:] = p3 + p5
    out[r:, :t] = p2 + p4
    out[r:, t:] = p1 - p2 + p3 + p6
    return out[:m, :n]


def first_of(scores: np.ndarray, ok: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the first ``k`` columns of each row by score descending, then id, among those that are ``ok``."""
    held = np.where(ok, scores, LOWEST)
    if held.shape[1] > k:
        least = np.partition(held, held.shape[1] - k, axis=1)[:, held.shape[1] - k]
        ok = ok & (held >= least[:, None])
    row, col = np.nonzero(ok)
    order = np.lexsort((ids[col], -held[row, col], row))
    row, col = row[order], col[order]
    near = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[near], col[near]


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Lists of longs as rows of a matrix, padded with zeros."""
    lists = column.combine_chunks()
    lists = pa.concat_arrays(lists.chunks) if isinstance(lists, pa.ChunkedArray) else lists
    size = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    if len(size) and (size == width).all():
        return flat.reshape(len(size), width)
    out = np.zeros((len(size), width), dtype=np.int64)
    out[np.arange(width) < size[:, None]] = flat
    return out


def _width(*columns: pa.ChunkedArray) -> int:
    return max(int(max((len(x) for x in c), default=0)) for c in columns)


def _tiles(left: pa.Table, right: pa.Table) -> Iterator[tuple[slice, slice, np.ndarray]]:
    """(anchor rows, candidate rows, scores) of a cell."""
    width = _width(left["anchor_q"], right["q"])
    a, b = _matrix(left["anchor_q"], width), _matrix(right["q"], width)
    for i in range(0, len(a), TILE[0]):
        for j in range(0, len(b), TILE[1]):
            yield slice(i, i + TILE[0]), slice(j, j + TILE[1]), strassen(a[i : i + TILE[0]], b[j : j + TILE[1]].T)


def _merged(parts: list[tuple[np.ndarray, ...]], k: int, names: list[str]) -> pa.Table:
    """The first ``k`` of each key (all columns but the last two, which are id and score) from a cell's heaps."""
    columns = [np.concatenate(c) if c else np.empty(0, dtype=np.int64) for c in (zip(*parts, strict=True) if parts else [[]] * len(names))]
    order = np.lexsort((columns[-2], -columns[-1], *columns[-3::-1]))
    columns = [c[order] for c in columns]
    new = np.ones(len(order), dtype=bool)
    if len(order):
        new[1:] = np.any([c[1:] != c[:-1] for c in columns[:-2]], axis=0)
    start = np.flatnonzero(new)
    keep = np.arange(len(order)) - start[np.cumsum(new) - 1] < k if len(order) else new
    return pa.table([pa.array(c[keep], pa.int64()) for c in columns], names=names)


def _positive_cell(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        anchor, other = left["anchor_id"].to_numpy(), right["vec_id"].to_numpy()
        parts = []
        for i, j, scores in _tiles(left, right):
            row, col = first_of(scores, anchor[i][:, None] != other[j][None, :], other[j], k)
            parts.append((anchor[i][row], other[j][col], scores[row, col]))
        return _merged(parts, k, ["anchor_id", "positive_id", "positive_score"])

    return run


def _share(p: np.ndarray, percent: int, up: bool) -> np.ndarray:
    """``percent`` of each whole number of ``p``, rounded up or down, without products beyond a long."""
    rest = (p % 100) * percent
    return p // 100 * percent + (-(-rest // 100) if up else rest // 100)


def _window_cell(k: int, low: int, high: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        anchor, other = left["anchor_id"].to_numpy(), right["vec_id"].to_numpy()
        label, labels = left["anchor_label"].to_numpy(), right["label"].to_numpy()
        most = max((len(x) for x in left["scores"]), default=0)
        opened = _matrix(left["scores"], most)
        some = np.arange(most) < np.array([len(x) for x in left["scores"]])[:, None]
        parts = []
        for i, j, scores in _tiles(left, right):
            differ = label[i][:, None] != labels[j][None, :]
            for slot in range(most):
                p = opened[i, slot]
                floor, ceiling = _share(p, low, True)[:, None], _share(p, high, False)[:, None]
                ok = differ & some[i, slot][:, None] & (scores >= floor) & (scores <= ceiling)
                if ok.any():
                    row, col = first_of(scores, ok, other[j], k)
                    parts.append((anchor[i][row], p[row], other[j][col], scores[row, col]))
        return _merged(parts, k, ["anchor_id", "positive_score", "negative_id", "negative_score"])

    return run


def _dealt(blocks: Column | int) -> Column:
    return F.pmod(F.xxhash64("vec_id"), F.lit(blocks) if isinstance(blocks, int) else blocks).cast("int")


def _all_blocks(blocks: Column | int) -> Column:
    return F.explode(F.sequence(F.lit(0), (F.lit(blocks) if isinstance(blocks, int) else blocks).cast("int") - 1))


def _blocks(rows: str, size: int) -> Column:
    return F.ceil(F.col(rows) / F.lit(size)).cast("long")


def integer_vectors(vectors: DataFrame, anchor: Column, label: Column, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, label, q, anchor): rows that take part, their components times ``scale`` rounded down."""
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"), v.alias("v"), F.coalesce(anchor, F.lit(False)).alias("anchor"))
    usable = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    length = F.aggregate("v", F.lit(0.0), lambda s, x: s + F.pow(F.abs(x * scale) + 1, F.lit(2)))
    rows = rows.dropna(subset=["vec_id", "label", "v"]).filter(usable).filter(length < MOST)
    one = rows.select("vec_id", F.struct("label", F.transform("v", lambda x: F.floor(x * scale)).alias("q"), "anchor").alias("r"))
    return one.groupBy("vec_id").agg(F.min("r").alias("r")).select("vec_id", "r.*")


def hard_negatives(
    vectors: DataFrame, anchor: Column, label: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows that ``anchor`` marks.

    An anchor's positives are its first ``positives`` other rows of the same label, its negatives for a positive the first
    ``negatives`` rows of other labels whose score is ``low`` to ``high`` percent of the positive's; first by score, then by smaller
    id. Rows with a null id, label or vector, or with a null or non-finite component, take no part, nor do vectors so long that a
    score could leave a long (length of 2^31 after scaling). Repeated rows count once; of rows that share an id the one of least
    label, then vector, counts. Vectors of different lengths are compared as if padded with zeros, an empty one scores 0.
    A positive of negative score opens no window. Other columns are ignored; an empty table gives no rows.
    """
    if not 0 <= low < high:
        raise ValueError("low must be at least 0 and under high")
    rows = durable(integer_vectors(vectors, anchor, label, scale, id_col, vector_col))
    # cells of equal labels: each label has blocks by its own size, so a hot label is many cells
    sizes = durable(rows.groupBy("label").agg(F.count("*").alias("n"), F.count_if("anchor").alias("a")).filter("a > 0"))
    sized = rows.join(sizes.select("label", _blocks("n", ROWS).alias("nb"), _blocks("a", ANCHORS).alias("ab")), "label")
    as_anchor = [F.col("vec_id").alias("anchor_id"), F.col("q").alias("anchor_q"), F.col("label").alias("anchor_label")]
    left = sized.filter("anchor").select(*as_anchor, _dealt(F.col("ab")).alias("i"), _all_blocks(F.col("nb")).alias("j"))
    right = sized.select("vec_id", "q", "label", _dealt(F.col("nb")).alias("j"), _all_blocks(F.col("ab")).alias("i"))
    met = left.groupBy("anchor_label", "i", "j").cogroup(right.groupBy("label", "i", "j")).applyInArrow(_positive_cell(positives), "anchor_id long, positive_id long, positive_score long")
    place = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.col("positive_score").desc(), "positive_id"))
    chosen = durable(met.withColumn("k", place).filter(F.col("k") <= positives).drop("k"))
    opened = chosen.filter("positive_score >= 0").groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_set("positive_score").alias("scores"))
    total = sizes.agg(F.sum("a").alias("a")).first()["a"] or 0
    count = rows.count()
    ab, nb = max(1, -(-total // ANCHORS)), max(1, -(-count // ROWS))
    left = rows.join(opened, "vec_id").select(*as_anchor, "scores", _dealt(ab).alias("i"), _all_blocks(nb).alias("j"))
    right = rows.select("vec_id", "label", "q", _dealt(nb).alias("j"), _all_blocks(ab).alias("i"))
    found = left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInArrow(_window_cell(negatives, low, high), "anchor_id long, positive_score long, negative_id long, negative_score long")
    place = F.row_number().over(Window.partitionBy("anchor_id", "positive_score").orderBy(F.col("negative_score").desc(), "negative_id"))
    window = found.withColumn("rank", place).filter(F.col("rank") <= negatives)
    return window.join(chosen, ["anchor_id", "positive_score"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op11_hard_negatives(spark, sf_dir: str) -> DataFrame:
    """Query: hard negatives of all ``embeddings``; anchors have ids divisible by 100, ids divisible by 7 the next label."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label"), F.col("vec_id") % 100 == 0, label)
