"""Shared helpers of the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordscope.sources.io import durable

__all__ = ["SPACES", "connected_components", "durable", "row_key", "words"]

#: Word separators of every contract: space and the five ASCII controls tab..CR.
SPACES = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+`` of a text; null gives an empty array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def row_key(columns: list[str]) -> Column:
    """A 128-bit key of a row's content, equal for equal rows alone; it is the same however often and wherever it is computed."""
    told = [F.md5(F.coalesce(F.concat(F.lit("v"), F.col(f"`{c}`").cast("string")), F.lit("n")).cast("binary")) for c in columns]
    return F.md5(F.concat(*told).cast("binary"))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) over undirected ``edges``, only nodes with an edge; ``component`` is one of the component's nodes.

    Contraction: each node moves to the node of the least mark in its neighbourhood, edges are rewritten to where their ends
    moved and self-loops dropped. Marks are hashes of the nodes, so a long path of ascending ids shrinks by a constant share a round
    in expectation, like any other graph, and a star is done in two rounds, as its least node stays the least. Hot nodes are met
    only in partial minimum aggregates and skew-splittable joins; each round is written to the shared folder. Null ends and
    self-loops are ignored; no edges give no rows.
    """
    live = durable(edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).filter("a is not null and b is not null and a <> b").distinct())
    label = None
    marked = lambda c: F.struct(F.xxhash64(c).alias("mark"), F.col(c).alias("to"))
    while not live.isEmpty():
        both = live.select(F.col("a").alias("node"), F.col("b").alias("near")).unionByName(live.select(F.col("b").alias("node"), F.col("a").alias("near")))
        least = both.groupBy("node").agg(F.min(marked("near")).alias("near"))
        step = durable(least.select("node", F.least("near", marked("node"))["to"].alias("to")))
        if label is None:
            label = step.select("node", F.col("to").alias("component"))
        else:
            moved = step.select(F.col("node").alias("component"), "to")
            label = durable(label.join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component")))
        ends = live.join(step.select(F.col("node").alias("a"), F.col("to").alias("ta")), "a").join(step.select(F.col("node").alias("b"), F.col("to").alias("tb")), "b")
        live = durable(ends.filter("ta <> tb").select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct())
    if label is None:
        return live.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return label
