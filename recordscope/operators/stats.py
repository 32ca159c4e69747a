"""Quantiles, concentration, histograms, correlation, rolling means, bins."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordscope.sources.io import durable

#: 0-based rank of each definition among n sorted values; the interpolated one lies between two ranks.
RANKS = {
    "floor": lambda n, q: F.floor(F.lit(q) * (n - 1)),
    "index": lambda n, q: F.least(F.floor(n * F.lit(q)), n - 1),
    "upper": lambda n, q: F.floor(n / F.lit(2)),
}
KINDS = (*RANKS, "interpolated")
#: Rows up to which a quantile ranks all values of a group; above, only those near it. The sketch errs by at most 1 / SKETCH of
#: the rows, the margin on both sides is five times that.
SMALL_ROWS, SKETCH = 10_000, 10_000


def rounded(c: Column, places: int) -> Column:
    """A double rounded half away from zero by its decimal digits, after six places are made exact.

    Sums that differ in their last bits, and engines that round binary fractions differently, then agree on ties.
    """
    return F.round(c.cast("decimal(38,6)"), places).cast("double")


def _near(df: DataFrame, by: Sequence[str], value: str, shares: Sequence[float]) -> DataFrame:
    """(by, value, _far, _n, _all): counts of a group's values near some quantiles, and of all others between them.

    Bounds come from a mergeable sketch of each group, so that the window that follows sees a thousandth of a large group instead of
    all its values. A far value stands for all up to the next bound; it carries the last bound below it and sorts after that one.
    """
    margin = 5 / SKETCH
    ends = [min(1.0, max(0.0, q + d)) for q in shares for d in (-margin, margin)]
    rows = df.select(*by, value)
    keys = [F.col(c).alias(f"_by{k}") for k, c in enumerate(by)]
    bounds = rows.groupBy(*keys).agg(F.count(value).alias("_all"), F.percentile_approx(value, F.array(*[F.lit(e) for e in ends]), SKETCH).alias("_b"))
    if by:
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_by{k}")) for k, c in enumerate(by)])
        rows = rows.join(bounds, same)
    else:
        rows = rows.filter(F.col(value).isNotNull()).crossJoin(F.broadcast(bounds))
    low, high = (lambda k: F.get("_b", F.lit(2 * k))), (lambda k: F.get("_b", F.lit(2 * k + 1)))
    near = (F.col("_all") <= SMALL_ROWS) | F.col(value).isNull()
    for k in range(len(shares)):
        near = near | F.col(value).between(low(k), high(k))
    below = F.array_max(F.filter(F.array(*[high(k) for k in range(len(shares))]), lambda h: h < F.col(value)))
    placed = rows.select(*by, F.when(near, F.col(value)).otherwise(below).alias(value), (~near).alias("_far"), "_all")
    return placed.groupBy(*by, value, "_far", "_all").agg(F.sum(F.when(F.col("_far") | F.col(value).isNotNull(), 1).otherwise(0)).alias("_n"))


def at_ranks(df: DataFrame, by: Sequence[str], value: str, ranks: Sequence[tuple[float, Callable[[Column], Column]]]) -> DataFrame:
    """(by, _all, _v0, _v1, ...): exact values at 0-based ranks among a group's non-null values.

    A rank is (share of the rows near which it lies, function of their number). Values are first counted, those far from the ranks of
    a large group between its bounds, so that a window sees few rows of each group, however hot it is.
    """
    counts = _near(df, by, value, [q for q, _ in ranks])
    part = Window.partitionBy(*by) if by else Window
    upto = part.orderBy(F.col(value).asc_nulls_first(), "_far").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.withColumn("_upto", F.sum("_n").over(upto))
    # the value at a rank is the least one whose running count passes it
    hit = lambda rank: F.min(F.when((F.col("_n") > 0) & ~F.col("_far") & (F.col("_upto") > rank(F.col("_all"))), F.col(value)))
    return ranked.groupBy(*by).agg(F.max("_all").alias("_all"), *[hit(rank).alias(f"_v{k}") for k, (_, rank) in enumerate(ranks)])


def quantiles(df: DataFrame, by: Sequence[str], value: str, shares: Sequence[float], kind: str) -> DataFrame:
    """(by, q, quantile): several quantiles of one definition in one pass; groups of nulls give null.

    Kinds are floor, index, upper and interpolated (linear between the two ranks around q * (n - 1)).
    """
    if kind not in KINDS:
        raise ValueError(f"kind is one of {KINDS}")
    spot = lambda n, q: F.lit(q) * (n - 1)
    if kind == "interpolated":
        ranks = [(q, (lambda n, q=q, f=f: f(spot(n, q)))) for q in shares for f in (F.floor, F.ceil)]
    else:
        ranks = [((0.5 if kind == "upper" else q), (lambda n, q=q: RANKS[kind](n, q))) for q in shares]
    at = at_ranks(df, by, value, ranks)

    def one(k: int, q: float) -> Column:
        if kind != "interpolated":
            return F.col(f"_v{k}")
        low, high = F.col(f"_v{2 * k}"), F.col(f"_v{2 * k + 1}")
        return low + (high - low) * (spot(F.col("_all"), q) - F.floor(spot(F.col("_all"), q)))

    each = F.explode(F.array(*[F.struct(F.lit(q).alias("q"), one(k, q).alias("quantile")) for k, q in enumerate(shares)])).alias("x")
    return at.select(*by, each).select(*by, "x.q", "x.quantile")


def quantile(df: DataFrame, by: Sequence[str], value: str, q: float, kind: str, name: str = "quantile") -> DataFrame:
    """One row a group: the ``kind`` quantile of non-null values; groups of nulls, and an empty table, give null."""
    return quantiles(df, by, value, [q], kind).select(*by, F.col("quantile").alias(name))


def small_quantile(c: Column, q: float, kind: str) -> Column:
    """Aggregate: a quantile of groups whose rows are few by nature, such as the days of a month or year; a larger group needs ``quantile``.

    It shares one aggregation with other measures, where ``quantile`` reads its input once more.
    """
    values = F.array_sort(F.collect_list(c))
    n = F.size(values)
    if kind == "interpolated":
        spot = F.lit(q) * (n - 1)
        low, high = (F.get(values, f(spot).cast("int")) for f in (F.floor, F.ceil))
        return F.when(n > 0, low + (high - low) * (spot - F.floor(spot)))
    return F.when(n > 0, F.get(values, RANKS[kind](n, q).cast("int")))


def medians(df: DataFrame, by: Sequence[str], values: Sequence[str], places: int = 4, small: bool = False) -> DataFrame:
    """(by, n, one column a value): rows and rounded medians of each group; ``small`` groups are done in one aggregation."""
    if small:
        return df.groupBy(*by).agg(F.count("*").alias("n"), *[rounded(small_quantile(F.col(v), 0.5, "interpolated"), places).alias(v) for v in values])
    out = df.groupBy(*by).agg(F.count("*").alias("n"))
    for v in values:
        out = out.join(quantile(df, by, v, 0.5, "interpolated", v), list(by))
    return out.select(*by, "n", *[rounded(F.col(v), places).alias(v) for v in values])


def concentration(df: DataFrame, by: Sequence[str], key: str, value: str, top: int = 10, groups: int | None = None) -> DataFrame:
    """Per group, or of the whole table without ``by``: total, number of keys, HHI on the 0 to 10,000 scale and the share of the ``top`` keys.

    ``groups`` keeps that many groups of largest total.
    """
    per = df.groupBy(*by, key).agg(F.sum(value).alias("_v"))
    if by:
        few = per.withColumn("_k", F.row_number().over(Window.partitionBy(*by).orderBy(F.col("_v").desc(), key)))
        most = few.filter(F.col("_k") <= top).groupBy(*by).agg(F.sum("_v").alias("_t"))
    else:
        most = per.orderBy(F.col("_v").desc(), key).limit(top).agg(F.sum("_v").alias("_t"))
    sums = per.groupBy(*by).agg(F.sum("_v").alias("total"), F.count("*").alias("n_keys"), F.sum(F.col("_v") * F.col("_v")).alias("_s"))
    both = sums.join(most, list(by)) if by else sums.crossJoin(most)
    out = both.select(*by, F.round("total", 2).alias("total"), "n_keys", F.round(F.try_divide(F.col("_s"), F.col("total") * F.col("total")) * 10000, 4).alias("hhi"), F.round(F.try_divide("_t", "total"), 6).alias("top_share"))
    return out.orderBy(F.col("total").desc(), *by).limit(groups) if groups else out


def histogram(df: DataFrame, value: str, width: float, below: float) -> DataFrame:
    """Counts of values in [0, below) in bins of ``width``: (bin, lower, n)."""
    bins = df.filter((F.col(value) >= 0) & (F.col(value) < below)).select(F.floor(F.col(value) / width).alias("bin"))
    return bins.groupBy("bin").agg(F.count("*").alias("n")).select("bin", (F.col("bin") * width).alias("lower"), "n")


def pearson(x: Column, y: Column, least: int = 10) -> Column:
    """Aggregate: correlation of complete pairs; null under ``least`` pairs or without spread."""
    a, b = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    r = F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))
    return F.when(F.count(F.when(x.isNotNull() & y.isNotNull(), 1)) >= least, r)


#: Rows of a series that one window sees, beside those it borrows from its neighbours.
SERIES_ROWS = 100_000
_PART = (1 << 33) - 1


def numbered(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``df`` with ``name``: 0-based number of each row by ``order``, from ranges that are sorted and counted apart.

    Ranges are written once, so numbers stay the same; only the counts of the ranges meet in one task.
    """
    rows = durable(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright("_id", 33)
    sizes = rows.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = sizes.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    out = rows.withColumn("_part", part).join(before, "_part")
    return out.withColumn(name, F.col("_before") + F.col("_id").bitwiseAND(F.lit(_PART))).drop("_id", "_part", "_before")


def centred_mean(df: DataFrame, by: Sequence[str], order: str, value: str, half: int, name: str, nulls_as_zero: bool = False) -> DataFrame:
    """Mean over ``half`` rows on both sides, shorter at the edges; nulls skipped or taken as 0.

    Groups are windows of their own. A series without groups is cut into blocks of numbered rows, each with ``half`` rows of its
    neighbours on both sides, so it runs in many tasks and every frame is whole. Rows of equal ``order`` come in any order.
    """
    v = F.coalesce(F.col(value), F.lit(0.0)) if nulls_as_zero else F.col(value)
    frame = lambda w: F.avg(v).over(w.rowsBetween(-half, half))
    if by:
        return df.withColumn(name, frame(Window.partitionBy(*by).orderBy(order)))
    size = max(SERIES_ROWS, 2 * half)
    at = lambda c: F.floor(c / F.lit(size))
    rows = numbered(df, [order], "_k")
    shared = rows.withColumn("_block", F.explode(F.sequence(at(F.greatest(F.col("_k") - half, F.lit(0))), at(F.col("_k") + half))))
    out = shared.withColumn(name, frame(Window.partitionBy("_block").orderBy("_k")))
    return out.filter(F.col("_block") == at(F.col("_k"))).drop("_k", "_block")


def tercile_bands(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows with ``band`` low, middle, high; cut points are the values of ranks n//3 and 2n//3, ties fall in the edge bands. Nulls go."""
    cut = at_ranks(df, by, value, [(k / 3, lambda n, k=k: F.floor(n * k / 3)) for k in (1, 2)]).select(*by, F.col("_v0").alias("_lo"), F.col("_v1").alias("_hi"))
    rows = df.filter(F.col(value).isNotNull())
    cut_rows = rows.join(cut, list(by)) if by else rows.crossJoin(F.broadcast(cut))
    band = F.when(F.col(value) <= F.col("_lo"), "low").when(F.col(value) >= F.col("_hi"), "high").otherwise("middle")
    return cut_rows.withColumn("band", band).drop("_lo", "_hi")


def band_medians(df: DataFrame, value: str, measures: Sequence[str], months: Sequence[int] | None = None, least: int = 60, date: str = "date", places: int = 4) -> DataFrame:
    """(band, n, medians of ``value`` and the measures) of terciles over the days of some months; no rows with under ``least`` such days."""
    rows = df.filter(F.col(value).isNotNull()) if months is None else df.filter(F.col(value).isNotNull() & F.month(date).isin(*months))
    enough = rows.agg((F.count("*") >= least).alias("_ok"))
    return medians(tercile_bands(rows, value).join(F.broadcast(enough)).filter("_ok"), ["band"], [value, *measures], places)


def half_trend(df: DataFrame, by: Sequence[str], order: str, value: str, least: int = 6, base: float = 0.0) -> DataFrame:
    """Per group: second half over first half of a series; null when short or when the first half is not over ``base``."""
    w = Window.partitionBy(*by)
    rows = df.withColumn("_k", F.row_number().over(w.orderBy(order))).withColumn("_n", F.count("*").over(w))
    half = F.floor(F.col("_n") / 2)
    sums = rows.groupBy(*by).agg(F.sum(F.when(F.col("_k") <= half, F.col(value))).alias("first"), F.sum(F.when(F.col("_k") > F.col("_n") - half, F.col(value))).alias("second"), F.max("_n").alias("n"))
    return sums.select(*by, "n", F.round("first", 4).alias("first"), F.round("second", 4).alias("second"), F.when((F.col("n") >= least) & (F.col("first") > base), F.round(F.try_divide("second", "first") - 1, 6)).alias("trend"))


def quantile_bins(df: DataFrame, value: str, steps: int) -> DataFrame:
    """Rows with ``bin``: number of interpolated quantile breaks that the value is strictly above."""
    breaks = quantiles(df, [], value, [k / steps for k in range(1, steps)], "interpolated").agg(F.array_sort(F.collect_list("quantile")).alias("_b"))
    return df.crossJoin(F.broadcast(breaks)).withColumn("bin", F.size(F.filter("_b", lambda b: F.col(value) > b))).drop("_b")


def rank_bins(df: DataFrame, value: str, steps: int) -> DataFrame:
    """Rows with ``bin`` 0 for zero or null and 1.. by rank among the positive values.

    A value with r values before it falls in bin 1 + floor(r * (steps - 1) / n): it is above the value at rank ceil(k * n / (steps - 1)) - 1
    for each earlier bin k, so a few cut points decide.
    """
    pos = df.filter(F.col(value) > 0)
    ranks = [(k / (steps - 1), lambda n, k=k: F.ceil(n * k / F.lit(steps - 1)) - 1) for k in range(1, steps - 1)]
    cut = at_ranks(pos, [], value, ranks or [(0.0, lambda n: F.lit(0))])
    cuts = F.array(*[F.col(f"_v{k}") for k in range(len(ranks))]).cast("array<double>").alias("_b")
    inside = F.when(F.col(value) > 0, 1 + F.size(F.filter("_b", lambda b: F.col(value) > b))).otherwise(0)
    return df.crossJoin(F.broadcast(cut.select(cuts))).withColumn("bin", F.coalesce(inside, F.lit(0)).cast("int")).drop("_b")
