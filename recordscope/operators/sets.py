"""Orders, samples, ranks, and unions and intersections of tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_rows(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    """The first ``n`` rows of an order that must be total; Spark keeps only ``n`` rows of each partition."""
    return df.orderBy(*order).limit(n)


def random_keys(df: DataFrame, key: str, n: int, seed: int = 7) -> DataFrame:
    """A uniform sample of ``n`` distinct keys, the same on every cluster: the first in the order of a seeded hash."""
    keys = df.select(key).filter(F.col(key).isNotNull()).distinct()
    return keys.orderBy(F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed)))), key).limit(n)


def trailing(df: DataFrame, date: str, n: int) -> DataFrame:
    """The rows of the ``n`` newest dates that occur."""
    dates = df.select(date).filter(F.col(date).isNotNull()).distinct().orderBy(F.col(date).desc()).limit(n)
    return df.join(dates, date, "left_semi")


def ranked(totals: DataFrame, name: str, value: str, places: int = 6) -> DataFrame:
    """Adds place (equal values share one), share of the sum and step (difference from the previous name) to a table of few totals."""
    whole = Window.partitionBy()
    columns = {
        "place": F.rank().over(Window.orderBy(F.col(value).desc())),
        "share": F.round(F.try_divide(F.col(value), F.sum(value).over(whole)), places),
        "step": F.col(value) - F.lag(value).over(Window.orderBy(name)),
    }
    return totals.withColumns(columns)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of several sources by column name, null where a source lacks a column."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def common_keys(a: DataFrame, b: DataFrame, key: Sequence[str]) -> DataFrame:
    """Distinct keys that both tables hold."""
    return a.select(*key).intersect(b.select(*key))
