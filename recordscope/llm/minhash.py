"""MinHash near-duplicate detection by a signature-coordinate inverted join.

Documents are sets of distinct 5-word shingles, each known by 64 bits that are mixed from digests of its words; texts cannot be made
to share them, and two different shingles do with a chance of 5e-20. Each distinct set gets a signature of ``K`` minima. Documents are posted
under (coordinate, value) tokens of the first ``POSTED`` coordinates. A pair with Jaccard 0.75 agrees on at least
``POSTED_MIN`` of those but for a chance of 2.4e-7, so with one global token order (rare first) it shares a token among the
first ``POSTED - POSTED_MIN + 1`` of both documents: only these prefixes are merged, the other coordinates are skipped and
probed on the signatures of the pairs found, which stay when ``MATCH`` of all ``K`` coordinates agree (a pair at 0.75 fails this
with a chance of 3.8e-7). Every pair that stays is confirmed on the full sets.

Long posting lists (over ``HEAVY`` documents) are never paired off in a join. If a pair shares no token of a short list in its
prefixes, all the tokens it shares are of long lists, so both documents have ``POSTED_MIN`` such tokens. These documents meet on
``HEAVY_COORDS`` coordinates (all of them differ with a chance of 6e-8). First each is compared with the leaders of its lists and
confirmed with the likest of them, which joins a group of near copies into one component by about as many pairs as it has members. Then
only what is still apart is compared: in each list the documents outside its largest component, with each other and with that
component, in blocks of bounded size. A task returns a spanning forest of confirmed links between components.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordscope.llm.common import connected_components, durable, row_key
from recordscope.llm.tokens import WordHashes, slices

SHINGLE = 5
K = 64
POSTED = 32
POSTED_MIN = 12
MATCH = 31
HEAVY = 100
HEAVY_COORDS = 12
#: Leaders that a document of long lists is confirmed with.
LEADERS = 3
BLOCK = 1024
#: Shingles of a block, so that blocks of long documents hold fewer of them.
BLOCK_SHINGLES = 1_000_000
#: Bytes of text hashed at a time in a task.
CHUNK = 1 << 18

_U = np.uint64
_SEED = np.random.default_rng(20240229)
_MUL = _SEED.integers(1, 2**63, K, dtype=np.uint64) * _U(2) + _U(1)
_ADD = _SEED.integers(0, 2**63, K, dtype=np.uint64)
_PLACE = _SEED.integers(1, 2**63, SHINGLE, dtype=np.uint64) * _U(2) + _U(1)


def _mix(x: np.ndarray) -> np.ndarray:
    """64-bit finalizer: every input bit reaches every output bit."""
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


#: Hashes of words that this process has met.
_KNOWN = WordHashes()


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts, in order, and each text's first word position (with the end appended); long texts go slice by slice."""
    parts, first = [np.empty(0, dtype=np.uint64)], [0]
    for text in texts:
        n = first[-1]
        for part in slices(text):
            parts.append(_KNOWN.of(part.split()))
            n += len(parts[-1])
        first.append(n)
    return np.concatenate(parts), np.array(first)


def shingle_sets(texts: list[str | None]) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a text of 1 to 4 words is one shingle, without words none."""
    chunk: list[bytes] = []
    size = 0
    for text in texts:
        chunk.append((text or "").encode("utf-8", "replace").lower())
        size += len(chunk[-1]) + 1
        if size >= CHUNK:
            yield from _chunk_sets(chunk)
            chunk, size = [], 0
    if chunk:
        yield from _chunk_sets(chunk)


def _chunk_sets(texts: list[bytes]) -> Iterator[np.ndarray]:
    word, first = word_hashes(texts)
    m = max(0, len(word) - SHINGLE + 1)
    rolled = np.zeros(m, dtype=np.uint64)
    for j in range(SHINGLE):
        rolled += word[j : j + m] * _PLACE[j]
    rolled = _mix(rolled)
    for lo, hi in zip(first[:-1], first[1:], strict=True):
        if hi - lo >= SHINGLE:
            yield np.unique(rolled[lo : hi - SHINGLE + 1])
        elif hi > lo:
            yield _mix(np.array([(word[lo:hi] * _PLACE[: hi - lo]).sum(dtype=np.uint64) + _U(hi - lo)], dtype=np.uint64))
        else:
            yield np.empty(0, dtype=np.uint64)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """A row of ``K`` 32-bit minima for each set; rows of empty sets are zero."""
    out = np.zeros((len(sets), K), dtype=np.uint32)
    full = [i for i, s in enumerate(sets) if len(s)]
    if not full:
        return out
    cut = np.concatenate(([0], np.cumsum([len(sets[i]) for i in full])))[:-1]
    every = np.concatenate([sets[i] for i in full])
    for k in range(K):
        out[full, k] = np.minimum.reduceat((every * _MUL[k] + _ADD[k]) >> _U(32), cut).astype(np.uint32)
    return out


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256)
            sets = list(shingle_sets(part.column(1).to_pylist()))
            sig = signatures(sets).view(np.int32)
            node = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            flat = pa.ListArray.from_arrays(np.arange(0, (len(sets) + 1) * K, K, dtype=np.int32), pa.array(sig.ravel()))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(node, pa.binary()), flat], names=["doc_id", "n_shingles", "node", "sig"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            sets = list(shingle_sets(batch.column(0).slice(lo, 256).to_pylist()))
            node = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            ends = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
            values = pa.array(np.concatenate(sets).view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.binary()), pa.ListArray.from_arrays(ends, values)], names=["node", "shingles"])


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def _compare_blocks(key: tuple, pdf: pd.DataFrame, similarity: int = 75) -> pd.DataFrame:
    """Confirmed links between the components of two blocks (or of one) of a long list, as a spanning forest."""
    coord, left, right = key[0], pdf[pdf["side"] == 0], pdf[pdf["side"] == 1]
    same = right.empty
    right = left if same else right
    sig_l, sig_r = (np.array(x["sig"].tolist(), dtype=np.int32).reshape(-1, K) for x in (left, right))
    sets_l, sets_r = ([np.sort(np.asarray(s, dtype=np.int64)) for s in x["shingles"]] for x in (left, right))
    size_l, size_r = (np.array([len(s) for s in x], dtype=np.int64) for x in (sets_l, sets_r))
    names = list(dict.fromkeys(pdf["component"]))
    number = {c: k for k, c in enumerate(names)}
    part_l, part_r = (np.array([number[c] for c in x["component"]], dtype=np.int64) for x in (left, right))
    parent = list(range(len(names)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links = []
    for i in range(len(left)):
        agree = sig_r == sig_l[i]
        ok = (agree.sum(axis=1) >= MATCH) & agree[:, coord] & ~agree[:, :coord].any(axis=1) & (part_r != part_l[i])
        ok &= 100 * np.minimum(size_l[i], size_r) >= similarity * np.maximum(size_l[i], size_r)
        if same:
            ok[: i + 1] = False
        for j in np.flatnonzero(ok):
            a, b = root(int(part_l[i])), root(int(part_r[j]))
            if a == b:
                continue
            x = _common(sets_l[i], sets_r[j])
            if 100 * x >= similarity * (size_l[i] + size_r[j] - x):
                parent[max(a, b)] = min(a, b)
                links.append((names[a], names[b]))
    return pd.DataFrame(links, columns=["a", "b"])


def _tokens(sig: Column) -> Column:
    """Longs that name (coordinate, value) of the posted coordinates."""
    return F.transform(F.slice(sig, 1, POSTED), lambda v, i: F.shiftleft(i.cast("long"), 32) + F.pmod(v.cast("long"), F.lit(1 << 32)))


def _confirmed(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a").join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b")
    both = both.withColumn("x", F.size(F.array_intersect("sa", "sb")))
    return both.filter(100 * F.col("x") >= similarity * (F.size("sa") + F.size("sb") - F.col("x"))).select("a", "b")


def _fits(a: str, b: str, similarity: int) -> Column:
    """Whether two set sizes allow the similarity."""
    return 100 * F.least(a, b) >= similarity * F.greatest(a, b)


def near_components(docs: DataFrame, classes: DataFrame, similarity: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(node, component) of the classes that have a link, by the closure of all links.

    ``classes`` has (node, rep, n_shingles, sig), one row per distinct non-empty set; ``rep`` is a document with that set.
    """
    posted = classes.select("node", "n_shingles", F.explode(_tokens(F.col("sig"))).alias("token"))
    often = posted.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1")
    shared = durable(
        posted.join(often, "token")
        .groupBy("node", "n_shingles")
        .agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("shared"), F.count_if(F.col("df") > HEAVY).alias("n_heavy"))
    )
    # tokens of one document only come first in the order and take their places in the prefix
    room = F.greatest(F.size("shared") - F.lit(POSTED_MIN - 1), F.lit(0))
    prefix = (
        shared.select("node", "n_shingles", F.explode(F.slice("shared", 1, room)).alias("s"))
        .filter(F.col("s.df") <= HEAVY)
        .select("node", "n_shingles", F.col("s.token").alias("token"))
    )
    a, b = prefix.alias("a"), prefix.alias("b")
    fits = _fits("a.n_shingles", "b.n_shingles", similarity) & (F.col("a.node") < F.col("b.node"))
    met = a.join(b, (F.col("a.token") == F.col("b.token")) & fits).groupBy(F.col("a.node").alias("a"), F.col("b.node").alias("b")).agg(F.count("*").alias("collisions"))
    agree = F.size(F.filter(F.zip_with("sig_a", "sig_b", lambda x, y: x == y), lambda x: x))

    def likened(df: DataFrame) -> DataFrame:
        """Pairs with the number of coordinates on which their signatures agree, if enough."""
        both = df.join(classes.select(F.col("node").alias("a"), F.col("sig").alias("sig_a")), "a").join(classes.select(F.col("node").alias("b"), F.col("sig").alias("sig_b")), "b")
        return both.withColumn("agree", agree).filter(F.col("agree") >= MATCH).drop("sig_a", "sig_b")

    pairs = likened(met).select("a", "b")
    heavy = durable(classes.join(shared.filter(F.col("n_heavy") >= POSTED_MIN).select("node"), "node", "left_semi").select("node", "n_shingles", "sig"))
    crowded = not heavy.isEmpty()
    if crowded:
        pairs = pairs.unionByName(_led(heavy, likened, similarity)).distinct()
    pairs = durable(pairs)
    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).unionByName(heavy.select("node")).distinct()
    reps = classes.select("node", "rep").join(wanted, "node", "left_semi").select(F.col("rep").alias(id_col)).distinct()
    sets = durable(docs.select(id_col, text_col).join(reps, id_col, "left_semi").select(text_col).mapInArrow(_sets, "node binary, shingles array<long>"))
    # ids that stand for several texts bring in sets that nobody asked for
    once = sets.join(wanted, "node", "left_semi").groupBy("node").agg(F.first("shingles").alias("shingles"))
    parts = durable(connected_components(_confirmed(pairs, once, similarity)))
    if not crowded:
        return parts
    joined = connected_components(_apart(heavy, parts, once, similarity))
    moved = joined.select(F.col("node").alias("component"), F.col("component").alias("to"))
    named = parts.join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    return durable(named.unionByName(joined.join(parts.select("node"), "node", "left_anti")))


def _lists(heavy: DataFrame, similarity: int) -> DataFrame:
    """(node, n_shingles, step, coord, value): the lists of each document; linked sets are at most one size step apart."""
    step = F.floor(F.log("n_shingles") / F.log(F.lit(100.0 / similarity)) + 1e-9).cast("int") if similarity < 100 else F.col("n_shingles").cast("int")
    return heavy.select("node", "n_shingles", step.alias("step"), F.posexplode(F.slice("sig", 1, HEAVY_COORDS)).alias("coord", "value"))


def _led(heavy: DataFrame, likened, similarity: int) -> DataFrame:
    """Pairs of each document with the likest leaders of its lists; each list and size step has one leader, drawn by hash."""
    lists = _lists(heavy, similarity)
    leaders = lists.groupBy("coord", "value", "step").agg(F.min(F.struct(F.xxhash64("node", "coord"), "node", "n_shingles")).alias("l"))
    near = F.explode(F.array(F.col("step"), F.col("step") + 1)).alias("step")
    led = leaders.select("coord", "value", near, F.col("l.node").alias("b"), F.col("l.n_shingles").alias("size_b"))
    met = lists.withColumnRenamed("node", "a").join(led, ["coord", "value", "step"]).filter((F.col("a") != F.col("b")) & _fits("n_shingles", "size_b", similarity)).select("a", "b").distinct()
    place = F.row_number().over(Window.partitionBy("a").orderBy(F.col("agree").desc(), "b"))
    return likened(met).withColumn("k", place).filter(F.col("k") <= LEADERS).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _apart(heavy: DataFrame, parts: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """Links between components that share a list: documents outside the list's largest component against all of the list.

    A list falls into cells by size step and by side (0: the largest component, 1: the rest), cells into blocks by hash; two blocks
    meet if their steps are neighbours and not both of side 0. Lists of one component are left out.
    """
    placed = _lists(heavy, similarity).join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    per = durable(placed.groupBy("coord", "value", "step", "component").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("shingles")))
    main = per.groupBy("coord", "value", "component").agg(F.sum("n").alias("n")).groupBy("coord", "value").agg(F.max(F.struct("n", "component"))["component"].alias("main"), F.count("*").alias("components"))
    main = durable(main.filter("components > 1").drop("components"))
    cell = (2 * F.col("step") + F.when(F.col("component") == F.col("main"), 0).otherwise(1)).alias("cell")
    blocks = F.ceil(F.greatest(F.sum("n") / F.lit(BLOCK), F.sum("shingles") / F.lit(BLOCK_SHINGLES))).cast("int").alias("blocks")
    cells = per.join(main, ["coord", "value"]).groupBy("coord", "value", cell).agg(blocks)
    # a list has a few dozen size steps, so its cells are a short array
    plan = cells.groupBy("coord", "value").agg(F.map_from_entries(F.collect_list(F.struct("cell", "blocks"))).alias("plan"))
    dealt = placed.join(durable(plan.join(main, ["coord", "value"])), ["coord", "value"]).withColumn("cell", cell)
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("node", "coord"), F.element_at("plan", F.col("cell")).cast("long")).cast("int"))
    mine = F.struct(F.col("cell").alias("cell"), F.col("own").alias("block"))
    around = F.filter(F.sequence(2 * F.col("step") - 2, 2 * F.col("step") + 3), lambda c: F.map_contains_key("plan", c) & ((F.pmod(c, F.lit(2)) == 1) | (F.pmod(F.col("cell"), F.lit(2)) == 1)))
    others = F.flatten(F.transform(around, lambda c: F.transform(F.sequence(F.lit(0), F.element_at("plan", c) - 1), lambda k: F.struct(c.alias("cell"), k.alias("block")))))
    meet = F.transform(others, lambda o: F.struct(F.least(mine, o).alias("lo"), F.greatest(mine, o).alias("hi"), F.when(mine <= o, 0).otherwise(1).alias("side")))
    rows = dealt.select("node", "component", "coord", "value", F.explode(meet).alias("g")).select("node", "component", "coord", "value", "g.*")
    return (
        rows.join(heavy.select("node", "sig"), "node")
        .join(sets, "node")
        .groupBy("coord", "value", "lo", "hi")
        .applyInPandas(lambda key, pdf: _compare_blocks(key, pdf, similarity), "a binary, b binary")
    )


def minhash_dedup(docs: DataFrame, similarity: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs``.

    ``component_id`` is the smallest id reachable over links of ``100 * intersection >= similarity * union`` (similarity 75
    to 100), ``kept`` marks it. Null and empty texts have an empty set and no links. Repeated rows come out once each; rows that
    share an id but not a text are linked by their own texts. A null id takes no part: its component is null, kept false.
    Other columns are ignored. Ids are longs, or strings where the column is one. The threshold must be 75 or more, for which the
    match bounds above are set.
    """
    if not 75 <= similarity <= 100:
        raise ValueError("similarity must be 75 to 100")
    kind = "string" if dict(docs.dtypes)[id_col] == "string" else "long"
    docs = docs.select(F.col(id_col).cast(kind).alias("doc_id"), F.col(text_col).alias("text"))
    signed = durable(docs.mapInArrow(_sign, f"doc_id {kind}, n_shingles long, node binary, sig array<int>"))
    usable = signed.filter("n_shingles > 0 and doc_id is not null")
    first = usable.groupBy("node").agg(F.min("doc_id").alias("rep"))
    # the signature is fetched from one row of the class rather than aggregated, which would ship it for every copy
    classes = durable(
        usable.join(first.withColumnRenamed("rep", "doc_id"), ["node", "doc_id"], "left_semi").dropDuplicates(["node"]).select("node", F.col("doc_id").alias("rep"), "n_shingles", "sig")
    )
    found = near_components(docs, classes, similarity, "doc_id", "text").join(classes.select("node", "rep"), "node")
    least = found.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = durable(found.join(least, "component").select("node", "component_id"))
    by_class = classes.select("node", "rep").join(named, "node", "left").select("node", F.coalesce("component_id", "rep").alias("component_id"))
    out = signed.select("doc_id", "n_shingles", "node").join(by_class, "node", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), component).alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    )


def drop_near_copies(docs: DataFrame, similarity: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, without near copies: one row of each component stays, that of the smallest id, null ids last.

    Rows are told apart by a key of their content, which needs no table of its own: of repeated rows one stays, rows that share
    an id but not a text are judged by their texts, and rows with a null id take part. Rows without words all stay.
    """
    keyed = docs.withColumn("_key", row_key(docs.columns))
    found = minhash_dedup(keyed.select("_key", text_col), similarity, "_key", text_col)
    bare = durable(found.select(F.col("doc_id").alias("_key"), "component_id", (F.col("n_shingles") > 0).alias("_words")))
    named = keyed.select("_key", F.col(id_col).alias("_id")).join(bare.filter("_words").select("_key", "component_id").distinct(), "_key")
    stay = named.groupBy("component_id").agg(F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "_key"))["_key"].alias("_key"))
    stay = durable(stay.select("_key", F.lit(True).alias("_once")).unionByName(bare.filter("not _words").select("_key", F.lit(False).alias("_once")).distinct()))
    # equal rows meet in the join on their key; rows without words are not numbered and all pass
    met = keyed.join(stay, "_key")
    once = met.filter("_once").dropDuplicates(["_key"])
    return once.unionByName(met.filter("not _once")).select(docs.columns)


def op1_minhash_dedup(spark, sf_dir: str) -> DataFrame:
    """Query: near-duplicate components of all ``documents``."""
    return minhash_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
