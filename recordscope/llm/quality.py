"""Quality rules: decision lists learned by sequential covering.

Whole texts are measured once per document. Labelled rows (a bounded, hash-chosen sample) are split into a growing and a
pruning part; a rule is grown by adding the threshold with the best information gain, pruned from its end while that does not
lower its worth on the pruning part, and kept if it is precise enough there; the rows it covers go, and the next rule is
grown. The result is an ordered list that becomes one Spark CASE expression.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordscope.llm.common import durable
from recordscope.llm.minhash import CHUNK, _mix, word_hashes

#: Labelled rows that a rule list is learned from, at most in expectation.
SAMPLE_ROWS = 20_000
#: Features that rules may test, as SQL over the measured columns.
FEATURES = {
    "chars_per_word": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "words_per_line": "n_words / greatest(n_lines, 1)",
    "exclaims_per_word": "n_exclaims / greatest(n_words, 1)",
}
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_exclaims"]
SYMBOLS = "#*$%&|<>"
SPACE_CHARS = " \t\n\x0b\x0c\r"
_UPPER = bytes(range(65, 91))


@dataclass(frozen=True)
class Test:
    """``feature > cut`` (``above``) or ``feature <= cut``."""

    feature: str
    above: bool
    cut: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] > self.cut if self.above else x[self.feature] <= self.cut

    def sql(self) -> str:
        return f"({FEATURES[self.feature]}) {'>' if self.above else '<='} {self.cut!r}D"


Rule = tuple[Test, ...]


def _repeated_words(word: np.ndarray) -> int:
    """Words that stand in a 3-word window found twice or more."""
    if len(word) < 4:
        return 0
    key = _mix(word[:-2] * np.uint64(0x9E3779B97F4A7C15) + word[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + word[2:])
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(len(word), dtype=bool)
    hit = np.concatenate((order[1:][same], order[:-1][same]))
    twice[hit] = twice[hit + 1] = twice[hit + 2] = True
    return int(twice.sum())


def _lines(text: str) -> tuple[int, int]:
    """Lines with a word, and those of them that equal an earlier line."""
    full = [x for x in text.split("\n") if x.strip(SPACE_CHARS)]
    return len(full), len(full) - len(set(full))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t or "" for t in batch.column(1).to_pylist()]
        rows: list[tuple] = []
        lo = 0
        while lo < len(texts):
            hi, size = lo, 0
            while hi < len(texts) and (hi == lo or size < CHUNK):
                size += len(texts[hi])
                hi += 1
            raw = [t.encode("utf-8", "replace") for t in texts[lo:hi]]
            word, first = word_hashes(raw)
            for t, b, i, j in zip(texts[lo:hi], raw, first[:-1], first[1:], strict=True):
                n_lines, dup = _lines(t)
                chars = len(t) - sum(t.count(c) for c in SPACE_CHARS)
                marks = t.count("!") + t.count("?")
                rows.append((int(j - i), chars, sum(t.count(c) for c in SYMBOLS), dup, _repeated_words(word[i:j]), n_lines, len(b) - len(b.translate(None, _UPPER)), marks))
            lo = hi
        columns = list(zip(*rows, strict=True)) if rows else [()] * len(MEASURES)
        names = [f"_{k}" for k in range(batch.num_columns - 2)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:], *[pa.array(c, pa.int64()) for c in columns]], names=["doc_id", *names, *MEASURES])


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Whole-text measures beside the id and ``keep`` columns, one row for each row of ``docs``; a null text has none of anything."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("_text"), *[F.col(c).alias(f"_{k}") for k, c in enumerate(keep)])
    kinds = dict(rows.dtypes)
    schema = ", ".join(["doc_id long", *[f"_{k} {kinds[f'_{k}']}" for k in range(len(keep))], *[f"{m} long" for m in MEASURES]])
    return rows.mapInArrow(_measure, schema)


def _gain(before: tuple[int, int], after: tuple[int, int]) -> float:
    (p, n), (q, m) = before, after
    return q * (math.log2(q / (q + m)) - math.log2(p / (p + n))) if q else -1.0


def _best_test(x: dict[str, np.ndarray], y: np.ndarray, cuts: dict[str, np.ndarray], without: set[str] = frozenset()) -> tuple[float, Test | None]:
    best: tuple[float, Test | None] = (0.0, None)
    p, n = int(y.sum()), int((~y).sum())
    for name in (f for f in FEATURES if f not in without):
        at = np.searchsorted(cuts[name], x[name], side="left")
        pos = np.cumsum(np.bincount(at[y], minlength=len(cuts[name]) + 1))
        neg = np.cumsum(np.bincount(at[~y], minlength=len(cuts[name]) + 1))
        for k, cut in enumerate(cuts[name]):
            for above in (True, False):
                covered = (p - int(pos[k]), n - int(neg[k])) if above else (int(pos[k]), int(neg[k]))
                gain = _gain((p, n), covered)
                if gain > best[0] + 1e-9:
                    best = (gain, Test(name, above, float(cut)))
    return best


def _cuts(values: np.ndarray) -> np.ndarray:
    """Midpoints between neighbouring quantiles, so that a cut stands clear of the rows on both sides."""
    q = np.unique(np.quantile(values, np.linspace(0, 1, 257), method="nearest")) if len(values) else np.empty(0)
    return (q[1:] + q[:-1]) / 2


def _covers(rule: Rule, x: dict[str, np.ndarray]) -> np.ndarray:
    out = np.ones(len(next(iter(x.values()))), dtype=bool)
    for test in rule:
        out &= test.holds(x)
    return out


def _worth(rule: Rule, x: dict[str, np.ndarray], y: np.ndarray) -> float:
    """Balance of right and wrong rejections on the pruning part, -1 to 1."""
    covered = _covers(rule, x)
    n = int(covered.sum())
    return (2 * int(y[covered].sum()) - n) / max(1, n)


def learn_rules(x: dict[str, np.ndarray], bad: np.ndarray, max_rules: int = 12, max_tests: int = 3, precision: float = 0.97, min_cover: int = 5) -> list[Rule]:
    """An ordered list of conjunctions that reject; rows that none covers stay. Deterministic for given rows."""
    prune = np.arange(len(bad)) % 3 == 2
    pick = lambda m: ({k: v[m] for k, v in x.items()}, bad[m])
    (grow_x, grow_y), (prune_x, prune_y) = pick(~prune), pick(prune)
    cuts = {k: _cuts(v) for k, v in grow_x.items()}
    rules: list[Rule] = []
    failed: set[str] = set()  # features that began a rule which was not precise, since the last rule
    while len(rules) < max_rules and grow_y.any():
        rule: Rule = ()
        rest_x, rest_y = grow_x, grow_y
        while len(rule) < max_tests and not rest_y.all():
            _, test = _best_test(rest_x, rest_y, cuts, failed if not rule else frozenset())
            if test is None:
                break
            rule += (test,)
            held = test.holds(rest_x)
            rest_x, rest_y = {k: v[held] for k, v in rest_x.items()}, rest_y[held]
        if not rule:
            break
        short = rule
        while len(short) > 1 and _worth(short[:-1], prune_x, prune_y) >= _worth(short, prune_x, prune_y):
            short = short[:-1]
        # the pruned rule, or the shortest longer form of it, that is precise over both parts
        for rule in (rule[:n] for n in range(max(1, len(short)), len(rule) + 1)):
            grown, pruned = _covers(rule, grow_x), _covers(rule, prune_x)
            hit, n = int(grow_y[grown].sum() + prune_y[pruned].sum()), int(grown.sum() + pruned.sum())
            if n >= min_cover and hit >= precision * n:
                break
        else:
            failed.add(rule[0].feature)
            continue
        failed.clear()
        rules.append(rule)
        grow_x, grow_y = {k: v[~grown] for k, v in grow_x.items()}, grow_y[~grown]
        prune_x, prune_y = {k: v[~pruned] for k, v in prune_x.items()}, prune_y[~pruned]
    return rules


def decision(rules: list[Rule]) -> Column:
    """Number of the first rule that covers a measured row (from 1), 0 where none does."""
    out = F.lit(0)
    for k in range(len(rules), 0, -1):
        out = F.when(F.expr(" AND ".join(t.sql() for t in rules[k - 1])), k).otherwise(out)
    return out


def sample_labels(labels: DataFrame, bound: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, quality) of about ``bound`` labelled documents, chosen by hash; a document labelled both ways is bad."""
    told = labels.filter("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality"))
    return told.filter(F.pmod(F.xxhash64("doc_id"), F.lit(max(bound, told.count()))) < bound)


def train_rules(measured: DataFrame, few: DataFrame) -> list[Rule]:
    """Rules from the measured rows of the sampled labels ``few``; none unless both labels occur."""
    rows = measured.join(few, "doc_id").select("doc_id", "quality", *[F.expr(v).cast("double").alias(k) for k, v in FEATURES.items()])
    pdf = rows.dropDuplicates(["doc_id"]).toPandas().sort_values("doc_id")
    bad = (pdf["quality"] == 0).to_numpy(dtype=bool)
    return learn_rules({k: pdf[k].to_numpy(dtype=float) for k in FEATURES}, bad) if bad.any() and not bad.all() else []


def judge(measured: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds base_failed, rule and kept to measured rows."""
    out = measured.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))).withColumn("rule", decision(rules))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))


def drop_rejected(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, with their columns, that the rules keep; only sampled labelled rows are measured for training."""
    few = durable(sample_labels(labels).coalesce(1))  # bounded and small, so that texts are met by broadcast
    rules = train_rules(measure(docs.join(few.select("doc_id"), "doc_id", "left_semi")), few)
    keep = tuple(docs.columns)
    return judge(measure(docs, keep=keep), rules).filter("kept").select(*[F.col(f"_{k}").alias(c) for k, c in enumerate(keep)])


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, measures, base_failed, rule, kept) for each row of ``docs``.

    ``base_failed``: under 50 words, or over half the words in repeated 3-word windows. ``kept`` is false if the base failed
    or a learned rule covers the row. Null and empty texts fail the base. Repeated rows each get a row; without labels of both
    kinds no rule is learned. Other columns are ignored.
    """
    measured = durable(measure(docs))
    return judge(measured, train_rules(measured, sample_labels(labels)))


def op4_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Query: measures and verdict of all ``documents``."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    out = quality_rules(docs.select("doc_id", "text"), labels)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
