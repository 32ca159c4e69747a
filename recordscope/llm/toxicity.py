"""Toxicity scores from a classifier that is held to ignore identity terms.

Documents are sets of words and word beginnings. Spark counts features by label over a bounded, hash-chosen sample and keeps the
most telling ones. A logistic regression is fitted to them with a second penalty: in each sentence of the sampled documents each
identity term is swapped for every other term of its line, one at a time, and the squared change of the score is added to the loss.
Equal changes are counted by Spark, so the driver sees each kind of change once. The identity terms stay features even when few
documents hold them, so that the penalty acts on them. Sampled rows weigh as many rows as they stand for, so scores are chances
under the mix of all labels, whatever the size of the table.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordscope.llm.common import durable
from recordscope.llm.language import held_out, letters

#: Labelled documents of either label in the sample, in expectation.
SAMPLE_EACH = 4_000
FEATURES = 4_000
LEAST_DOCS = 3
#: Weights of the two penalties.
RIDGE = 5e-5
FAIRNESS = 1.0
STEPS = 300
#: Neutral names of groups in English, German, French and Spanish, swapped within a line.
IDENTITY_TERMS = (
    ("women", "men"),
    ("woman", "man"),
    ("she", "he"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino"),
    ("gay", "lesbian", "straight", "transgender"),
    ("immigrant", "refugee", "foreigner", "citizen"),
    ("immigrants", "refugees", "foreigners", "citizens"),
    ("old", "young"),
    ("disabled", "deaf", "blind"),
    ("frauen", "männer"),
    ("frau", "mann"),
    ("muslimisch", "christlich", "jüdisch", "hinduistisch", "buddhistisch"),
    ("muslime", "christen", "juden", "buddhisten", "atheisten"),
    ("schwarz", "weiß", "asiatisch"),
    ("schwul", "lesbisch", "hetero"),
    ("einwanderer", "flüchtlinge", "ausländer", "bürger"),
    ("alt", "jung"),
    ("behindert", "taub"),
    ("femmes", "hommes"),
    ("femme", "homme"),
    ("musulman", "chrétien", "juif", "hindou", "bouddhiste", "athée"),
    ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "athées"),
    ("noir", "blanc", "asiatique"),
    ("lesbienne", "hétéro"),
    ("immigré", "réfugié", "étranger", "citoyen"),
    ("immigrés", "réfugiés", "étrangers", "citoyens"),
    ("vieux", "jeune"),
    ("handicapé", "sourd", "aveugle"),
    ("mujeres", "hombres"),
    ("mujer", "hombre"),
    ("musulmán", "cristiano", "judío", "hindú", "budista", "ateo"),
    ("musulmanes", "cristianos", "judíos", "hindúes", "budistas", "ateos"),
    ("negro", "blanco", "asiático"),
    ("lesbiana", "heterosexual"),
    ("inmigrante", "refugiado", "extranjero", "ciudadano"),
    ("inmigrantes", "refugiados", "extranjeros", "ciudadanos"),
    ("viejo", "joven"),
    ("discapacitado", "sordo", "ciego"),
)
_SENTENCE = re.compile(r"[.!?\n]+")
#: Word beginnings that are features beside whole words.
BEGINNINGS = (4, 6)


def word_features(word: str) -> list[str]:
    return [word, *[f"{word[:n]}*" for n in BEGINNINGS if len(word) > n]]


def text_words(text: str | None) -> set[str]:
    return set(letters((text or "").lower()))


def swaps(terms: tuple[tuple[str, ...], ...]) -> dict[str, tuple[str, ...]]:
    """Each identity term -> the other terms of its lines."""
    out: dict[str, tuple[str, ...]] = {}
    for line in terms:
        for w in line:
            out[w] = (*out.get(w, ()), *[x for x in line if x != w and x not in out.get(w, ())])
    return out


def counterfactuals(text: str | None, others: dict[str, tuple[str, ...]]) -> Counter:
    """(features that go, features that come) -> number of swaps in the sentences of a text that change them so."""
    out: Counter = Counter()
    for sentence in _SENTENCE.split((text or "").lower()):
        words = set(letters(sentence))
        named = sorted(words & others.keys())
        held = Counter(f for w in words for f in word_features(w)) if named else Counter()
        for term in named:
            own = word_features(term)
            for other in others[term]:
                new = word_features(other)
                # a feature stays while another word of the sentence has it
                gone = [f for f in own if held[f] == 1 and f not in new]
                come = [f for f in new if f not in held]
                if gone or come:
                    out[tuple(gone), tuple(come)] += 1
    return out


def _featurise(terms: tuple[tuple[str, ...], ...]):
    others = swaps(terms)
    change = pa.list_(pa.struct([("gone", pa.list_(pa.string())), ("come", pa.list_(pa.string())), ("times", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                part = batch.slice(lo, 200)
                texts = part.column(2).to_pylist()
                plain = [sorted({f for w in text_words(t) for f in word_features(w)}) for t in texts]
                moved = [[{"gone": list(a), "come": list(b), "times": n} for (a, b), n in sorted(counterfactuals(t, others).items())] for t in texts]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(plain, pa.list_(pa.string())), pa.array(moved, change)], names=["doc_id", "toxic", "plain", "moved"])

    return run


FEATURED = "doc_id long, toxic int, plain array<string>, moved array<struct<gone:array<string>,come:array<string>,times:bigint>>"


def fit(x: list[np.ndarray], y: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]], n_features: int, fairness: float = FAIRNESS, ridge: float = RIDGE, steps: int = STEPS, counts: np.ndarray | None = None, pair_counts: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise mean log loss + ridge * |w|^2 + fairness * mean squared score change over ``pairs``.

    Means are weighted by ``counts`` and ``pair_counts``, by default alike.
    """
    share = np.ones(len(x)) if counts is None else np.asarray(counts, dtype=float)
    pair_share = np.ones(len(pairs)) if pair_counts is None else np.asarray(pair_counts, dtype=float)
    share, pair_share = share / max(share.sum(), 1e-12), pair_share / max(pair_share.sum(), 1e-12)
    flat = np.concatenate([*x, np.empty(0, dtype=np.int64)]).astype(np.int64)
    row = np.repeat(np.arange(len(x)), [len(v) for v in x])
    gone = [np.setdiff1d(a, b) for a, b in pairs]
    come = [np.setdiff1d(b, a) for a, b in pairs]
    d_flat = np.concatenate([*gone, *come, np.empty(0, dtype=np.int64)]).astype(np.int64)
    d_row = np.repeat(np.concatenate([np.arange(len(pairs))] * 2), [len(v) for v in gone + come])
    d_sign = np.repeat([1.0, -1.0], [sum(map(len, gone)), sum(map(len, come))])
    w, bias = np.zeros(n_features), 0.0
    m, v = np.zeros(n_features + 1), np.zeros(n_features + 1)
    for step in range(1, steps + 1):
        z = np.bincount(row, weights=w[flat], minlength=len(x)) + bias
        e = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * share
        g = np.bincount(flat, weights=e[row], minlength=n_features) + 2 * ridge * w
        if len(pairs):
            change = np.bincount(d_row, weights=d_sign * w[d_flat], minlength=len(pairs)) * pair_share
            g += 2 * fairness * np.bincount(d_flat, weights=d_sign * change[d_row], minlength=n_features)
        g = np.append(g, e.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    return w, float(bias)


def train_toxicity(docs: DataFrame, labels: DataFrame, terms: tuple[tuple[str, ...], ...] = IDENTITY_TERMS, fairness: float = FAIRNESS, sample_each: int = SAMPLE_EACH) -> tuple[dict[str, float], float]:
    """Feature weights and bias from labelled rows that are not held out; a document labelled both ways is toxic.

    A document of several rows teaches once, by the row of least features.
    """
    told = labels.filter("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    told = told.filter(~held_out(F.col("doc_id")))
    size = {r["toxic"]: r["count"] for r in told.groupBy("toxic").count().collect()}
    bound = F.when(F.col("toxic") == 1, max(sample_each, size.get(1, 0))).otherwise(max(sample_each, size.get(0, 0)))
    # bounded and small, so that texts are met by broadcast and not shuffled
    few = durable(told.filter(F.pmod(F.xxhash64("doc_id"), bound) < sample_each).coalesce(1))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("text is not null").join(few, "doc_id")
    rows = rows.select("doc_id", "toxic", "text")
    # rows of one document are told apart after the texts are read where they lie; what is shuffled is features
    each = rows.mapInArrow(_featurise(terms), FEATURED).groupBy("doc_id", "toxic").agg(F.min(F.struct("plain", "moved")).alias("d"))
    feats = durable(each.select("doc_id", "toxic", "d.plain", "d.moved"))
    n = {r["toxic"]: r["count"] for r in feats.groupBy("toxic").count().collect()}
    if not n.get(0) or not n.get(1):
        return {}, (-6.0 if n.get(0) else 0.0)
    both = feats.select("toxic", F.explode("plain").alias("f")).groupBy("f").agg(F.count_if(F.col("toxic") == 1).alias("p"), F.count_if(F.col("toxic") == 0).alias("q"))
    p, q = (F.col("p") + 0.5) / (n[1] + 1), (F.col("q") + 0.5) / (n[0] + 1)
    z = F.abs(F.log(p / q)) / F.sqrt(1 / (F.col("p") + 0.5) + 1 / (F.col("q") + 0.5))
    named = {f for line in terms for w in line for f in word_features(w)}
    told_names = {r["f"] for r in both.filter(F.col("p") + F.col("q") >= LEAST_DOCS).orderBy(z.desc(), "f").limit(FEATURES).collect()}
    names = sorted(told_names | named)
    at = {f: k for k, f in enumerate(names)}
    shared = docs.sparkSession.sparkContext.broadcast(at)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            ids = pa.array([[known[f] for f in x if f in known] for x in batch.column(2).to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), ids], names=["doc_id", "toxic", "plain"])

    # rows that each row of the sample stands for
    stands = [max(sample_each, size.get(k, 0)) / sample_each for k in (0, 1)]
    pdf = feats.select("doc_id", "toxic", "plain").mapInArrow(number, "doc_id long, toxic int, plain array<int>").toPandas().sort_values("doc_id", kind="stable")
    x = [np.asarray(v, dtype=np.int64) for v in pdf["plain"]]
    y = pdf["toxic"].to_numpy(dtype=float)
    told_moves = feats.select("toxic", F.explode("moved").alias("m")).groupBy("m.gone", "m.come").agg(F.sum(F.col("m.times") * F.when(F.col("toxic") == 1, stands[1]).otherwise(stands[0])).alias("times"))
    moves = told_moves.orderBy("gone", "come").collect()
    pairs = [tuple(np.array([at[f] for f in fs if f in at], dtype=np.int64) for fs in (r["gone"], r["come"])) for r in moves]
    w, bias = fit(x, y, pairs, len(names), fairness, counts=np.where(y == 1, stands[1], stands[0]), pair_counts=np.array([r["times"] for r in moves]))
    return {f: float(w[k]) for f, k in at.items() if abs(w[k]) > 1e-6}, bias


def score_toxicity(docs: DataFrame, weights: dict[str, float], bias: float, cut: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row; a text without words scores the bias alone."""
    shared = docs.sparkSession.sparkContext.broadcast((weights, bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, base = shared.value
        cache: dict[str, tuple[str, ...]] = {}
        for batch in batches:
            out = []
            for text in batch.column(2).to_pylist():
                hit: set[str] = set()
                for w in text_words(text):
                    f = cache.get(w)
                    if f is None:
                        if len(cache) > 300_000:
                            cache.clear()
                        f = cache[w] = tuple(x for x in word_features(w) if x in known)
                    hit.update(f)
                out.append(base + sum(known[f] for f in sorted(hit)))
            score = 1 / (1 + np.exp(-np.clip(np.array(out, dtype=float), -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score), pa.array((score >= cut).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame, terms: tuple[tuple[str, ...], ...] = IDENTITY_TERMS, fairness: float = FAIRNESS) -> DataFrame:
    """Train on ``labels`` and score every row of ``docs``; null texts score the bias, repeated rows score alike.

    Without labels of both kinds there are no weights: all score the same. Other columns are ignored.
    """
    weights, bias = train_toxicity(docs, labels, terms, fairness)
    return score_toxicity(docs, weights, bias)


def op6_toxicity(spark, sf_dir: str) -> DataFrame:
    """Query: toxicity scores of all ``documents``."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return toxicity(docs.select("doc_id", "text"), labels)
