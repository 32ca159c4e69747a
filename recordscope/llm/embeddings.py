"""Near-duplicate vectors by sorted projection passes with windows of equal key prefix.

A pass orders the vectors of a label lexicographically by the concatenated sign hashes of fresh random projections. A window is a
run of that order with an equal prefix, whose length in bits is the depth. (Windows of a fixed number of neighbours lose links
where many vectors share a direction, so runs are taken whole.) A pair at the threshold shares a prefix with a known chance, from
which the number of passes for a depth follows, however the vectors lie. The depth of a group is the cheapest one by the run lengths
measured in one pass; at depth 0 the whole group is one run and nothing is left to chance. All pairs of a run are compared in double
precision, long runs block by block, so groups that share a direction are slower but not thinner. Links of all passes are united
into components; a pair is counted in the first pass that brings it together.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordscope.llm.common import connected_components, durable

#: Rows up to which a bucket costs no more than a smaller one.
WINDOW = 64
KEY_BITS = 32
#: Depths a group can have.
DEPTHS = range(0, KEY_BITS + 1, 2)
#: Rows of a comparison block.
ROWS = 1024
#: Comparisons that cost as much as a row of a block.
ROW_COST = 1000
#: Chance to miss a pair at the threshold in all passes.
MISS = 1e-7


def passes_at(depth: float, threshold: float, miss: float = MISS) -> float:
    """Passes after which a pair at the threshold has shared ``depth`` signs but for the chance ``miss``; infinite if it never can."""
    agree = 1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi
    once = agree**depth
    if depth <= 0:
        return 1
    if once >= 1:
        return 2
    return max(2, math.ceil(math.log(miss) / math.log1p(-once))) if once > 1e-12 else math.inf


def passes_for(rows: int, threshold: float, window: int = WINDOW, miss: float = MISS) -> float:
    """Passes for ``rows`` vectors that lie evenly, in buckets of about half of ``window``."""
    return passes_at(max(0.0, math.log2(max(rows, 1) / window) + 1), threshold, miss)


def _prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, groups, nodes, units = [], [], [], []
        for i, v, label in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            if i is None or v is None or label is None or not v or any(x is None for x in v):
                continue
            x = np.array(v, dtype=np.float64)
            scale = np.abs(x).max()
            if not np.isfinite(x).all() or scale == 0:
                continue
            x = x / scale
            group = f"{label}:{len(x)}"
            ids.append(i)
            groups.append(group)
            nodes.append(hashlib.blake2b(group.encode() + b":" + np.array(v, dtype=np.float64).tobytes(), digest_size=16).digest())
            units.append(x / np.sqrt(x @ x))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(groups, pa.string()), pa.array(nodes, pa.binary()), pa.array(units, pa.list_(pa.float64()))], names=["vec_id", "group", "node", "unit"])


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, group, keys: the prefix in each pass) of rows of (node, group, unit, depth, passes)."""
    directions: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        units = [np.array(u) for u in batch.column(2).to_pylist()]
        depth, passes = (np.array(batch.column(k).to_pylist(), dtype=np.int64) for k in (3, 4))
        keys: list[np.ndarray] = [np.empty(0, dtype=np.int64)] * len(units)
        for dims, most in sorted({(len(u), int(n)) for u, n in zip(units, passes, strict=True)}):
            own = np.array([k for k, u in enumerate(units) if len(u) == dims and passes[k] == most])
            x = np.stack([units[k] for k in own])
            found = np.empty((len(own), most), dtype=np.int64)
            for p in range(most):
                if (p, dims) not in directions:
                    directions[p, dims] = np.random.default_rng([p, dims, 5]).standard_normal((dims, KEY_BITS))
                found[:, p] = ((x @ directions[p, dims]) > 0) @ (np.int64(1) << np.arange(KEY_BITS - 1, -1, -1, dtype=np.int64)) >> (KEY_BITS - depth[own])
            for k, row in zip(own, found, strict=True):
                keys[k] = row
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keys, pa.list_(pa.int64()))], names=["node", "group", "keys"])


KEYED = "node binary, group string, keys array<long>"


def _cost(n: Column, window: int) -> Column:
    """Comparisons of a bucket of ``n`` vectors, with the cost of moving its rows."""
    return F.pow(F.greatest(n, F.lit(window)).cast("double"), 2) + n * ROW_COST * F.ceil(n / F.lit(ROWS))


def _plan(classes: DataFrame, threshold: float, window: int) -> DataFrame:
    """(group, depth, passes): the cheapest depth of each group by the bucket sizes of one pass."""
    costs = {d: passes_at(d, threshold) for d in DEPTHS}
    sizes = durable(classes.groupBy("group").agg(F.count("*").alias("n")))
    # a group of one block is compared whole
    large = sizes.filter(F.col("n") > ROWS).select("group")
    first = classes.join(large, "group").select("node", "group", "unit", F.lit(KEY_BITS).alias("depth"), F.lit(1).alias("passes"))
    keys = first.mapInArrow(_keys, KEYED).groupBy("group", F.get("keys", F.lit(0)).alias("bucket")).agg(F.count("*").alias("n"))
    depths = F.array(*[F.struct(F.lit(d).alias("depth"), F.lit(int(n)).alias("passes")) for d, n in costs.items() if n < 10_000])
    cut = keys.select("group", "bucket", "n", F.explode(depths).alias("d")).select("group", "d", "n", F.call_function("shiftright", "bucket", F.lit(KEY_BITS) - F.col("d.depth")).alias("bucket"))
    each = cut.groupBy("group", "d", "bucket").agg(F.sum("n").alias("n")).groupBy("group", "d").agg((F.sum(_cost(F.col("n"), window)) * F.first("d.passes")).alias("cost"))
    best = each.groupBy("group").agg(F.min_by("d", F.struct("cost", "d.depth")).alias("d"))
    return sizes.select("group").join(best, "group", "left").select("group", F.coalesce("d.depth", F.lit(0)).alias("depth"), F.coalesce("d.passes", F.lit(1)).alias("passes"))


def _forest(near: np.ndarray) -> list[tuple[int, int]]:
    """Spanning forest of a symmetric matrix of links."""
    seen = np.zeros(len(near), dtype=bool)
    out = []
    for start in np.flatnonzero(near.any(axis=1)):
        if seen[start]:
            continue
        seen[start] = True
        todo = [int(start)]
        while todo:
            at = todo.pop()
            new = np.flatnonzero(near[at] & ~seen)
            seen[new] = True
            out += [(at, int(k)) for k in new]
            todo += new.tolist()
    return out


def _compare_runs(pdf: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links (a, b) of whole runs, or between two blocks of one, as spanning forests, and (a, null, n) with each vector's new links.

    A pair is new in the first pass in which it shares a run; copies of a vector count as often as they come.
    """
    mark = pdf.groupby(["group", "pass", "bucket"], sort=False).ngroup().to_numpy()
    order = np.argsort(mark, kind="stable")
    nodes, units, keys = pdf["node"].tolist(), pdf["unit"].tolist(), pdf["keys"].tolist()
    side, copies, number = pdf["side"].to_numpy(), pdf["copies"].to_numpy(), pdf["pass"].to_numpy()
    out: list[tuple] = []
    for own in np.split(order, np.flatnonzero(np.diff(mark[order])) + 1):
        if len(own) < 2:
            continue
        x = np.stack([units[k] for k in own])
        second = side[own] == 1
        near = x @ x.T >= threshold
        if second.any():
            near &= second[:, None] != second[None, :]
        near |= near.T
        np.fill_diagonal(near, False)
        if number[own[0]] and near.any():
            earlier = np.stack([keys[k][: number[own[0]]] for k in own])
            for row in np.flatnonzero(near.any(axis=1)):
                hit = np.flatnonzero(near[row])
                near[row, hit[(earlier[hit] == earlier[row]).any(axis=1)]] = False
        count = near @ copies[own]
        out += [(nodes[own[a]], nodes[own[b]], None) for a, b in _forest(near)]
        out += [(nodes[own[a]], None, int(count[a])) for a in np.flatnonzero(count)]
    return pd.DataFrame(out, columns=["a", "b", "n"]).astype({"n": "Int64"})


def _block_pairs() -> Column:
    """Pairs of blocks that a row of block ``own`` of ``blocks`` belongs to, and its side in each."""
    return F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.least("own", j).alias("i"), F.greatest("own", j).alias("j"), F.when(F.col("own") <= j, 0).otherwise(1).alias("side")))


def near_vectors(vectors: DataFrame, threshold: float = 0.98, window: int = WINDOW, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of ``vectors``.

    Only vectors of equal, non-null label (and equal length) are compared. Null, empty, zero or non-finite vectors and rows with
    a null id link with nothing; a null id has a null component and is not kept. Copies of a vector are linked with each other and
    with all its links; repeated ids count once. Other columns are ignored.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("embedding"), F.col(label_col).cast("string").alias("label"))
    usable = durable(rows.mapInArrow(_prepare, "vec_id long, group string, node binary, unit array<double>"))
    sizes = usable.groupBy("node").agg(F.min("vec_id").alias("rep"), F.count_distinct("vec_id").alias("copies"))
    members = usable.select("node", "vec_id").distinct()
    classes = durable(usable.join(sizes.select("node", F.col("rep").alias("vec_id"), "copies"), ["node", "vec_id"]).dropDuplicates(["node"]).select("node", "group", "unit", F.col("vec_id").alias("rep"), "copies"))
    plan = durable(_plan(classes, threshold, window))
    planned = classes.join(plan, "group").select("node", "group", "unit", "depth", "passes")
    keyed = durable(planned.mapInArrow(_keys, KEYED))
    key = ["group", "pass", "bucket"]
    placed = keyed.select("node", "group", F.posexplode("keys").alias("pass", "bucket"))
    sized = durable(placed.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1"))
    tasks = max(1, (sized.filter(F.col("n") <= ROWS).agg(F.sum("n")).first()[0] or 0) // ROWS)
    blocks = F.ceil(F.col("n") / F.lit(ROWS)).cast("int")
    # short runs share a task's call, longer ones are dealt to blocks that meet in pairs
    met = placed.join(sized, key).withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks").cast("long")).cast("int"))
    call = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64(*key), F.lit(tasks))).otherwise(F.xxhash64(*key))
    found = durable(
        met.select("node", *key, call.alias("call"), "blocks", F.explode(_block_pairs()).alias("g"))
        .select("node", *key, "call", "blocks", "g.*")
        .join(classes.select("node", "unit", "copies").join(keyed.select("node", "keys"), "node"), "node")
        .groupBy("call", "blocks", "i", "j")
        .applyInPandas(lambda pdf: _compare_runs(pdf, threshold), "a binary, b binary, n long")
    )
    counted = found.filter("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    parts = durable(connected_components(found.filter("b is not null").select("a", "b")).join(classes.select("node", "rep"), "node"))
    per = durable(parts.groupBy("component").agg(F.min("rep").alias("component_id")))
    named = parts.join(per, "component").select("node", "component_id").join(counted, "node", "left")
    by_class = classes.select("node", "rep", "copies").join(named, "node", "left")
    by_class = by_class.select("node", F.coalesce("component_id", "rep").alias("component_id"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    by_id = members.join(by_class, "node").groupBy("vec_id").agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    out = rows.select("vec_id").join(by_id, "vec_id", "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op10_near_vectors(spark, sf_dir: str) -> DataFrame:
    """Query: links and components of all ``embeddings``."""
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
