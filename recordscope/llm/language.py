"""Language identification by known words first, then shorter and shorter character n-grams.

Training counts words and n-grams by language over a bounded, hash-chosen sample of labelled documents (``SAMPLE_DOCS`` a
language) and keeps the ``TOP`` most frequent of each kind and language (fewer with many languages). Every language that a training
document names is learned, however rare. A known word scores its log frequency in each language; an unseen word is read left to right,
taking at each place the longest known n-gram, and scores the mean of their log frequencies. A document's score is the posterior of
the best language.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordscope.llm.common import durable

#: Training documents, words and n-grams kept for each language.
SAMPLE_DOCS = 800
TOP = 20_000
#: Words, and as many n-grams, kept over all languages; with more than ten languages each keeps an equal share, one at least. This
#: bounds what the driver gathers and broadcasts of many languages.
TOP_ALL = 200_000
#: Longest n-gram.
GRAM = 4
#: Words that count as independent evidence; more words sharpen a score no further.
EVIDENCE = 25
UNKNOWN = "und"
# letters only, as in \\p{L}: Python's word characters without digits still hold fractions, superscripts and numerals
_NUMERALS = frozenset(c for c in map(chr, range(sys.maxunicode + 1)) if c.isnumeric() and not c.isalpha() and not c.isdecimal())
_BLANKS = dict.fromkeys(map(ord, _NUMERALS), " ")
_WORD = re.compile(r"[^\W\d_]+")


def letters(text: str) -> list[str]:
    """Runs of letters of a text."""
    return _WORD.findall(text if text.isascii() or _NUMERALS.isdisjoint(text) else text.translate(_BLANKS))


def held_out(doc_id) -> F.Column:
    """Rows kept for evaluation: crc32 of the id's text leaves 2 when divided by 4; false for a null id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


#: Scores (a word times a language) that a task keeps, and at most that many again that it adds up at once.
CACHE = 1_600_000


#: Log frequencies of an item by number of its language.
Sparse = dict[int, float]


@dataclass
class LanguageModel:
    """Log frequencies of words and of n-grams (``^`` and ``$`` mark word ends) in the languages that have them; others take the floor."""

    languages: list[str]
    words: dict[str, Sparse]
    grams: dict[str, Sparse]
    word_floor: np.ndarray
    floor: np.ndarray
    _at: dict[str, int] = field(default_factory=dict)
    _rows: np.ndarray | None = None
    _gram_at: dict[str, int] = field(default_factory=dict)
    _gram_first: np.ndarray | None = None
    _gram_lang: np.ndarray | None = None
    _gram_gain: np.ndarray | None = None

    def _dense(self, items: list[Sparse], floor: np.ndarray) -> np.ndarray:
        out = np.tile(floor, (len(items), 1))
        for row, item in zip(out, items, strict=True):
            row[list(item)] = list(item.values())
        return out

    def _parts(self, w: str) -> list[int]:
        """Rows of the n-grams that an unseen word is read as: at each place the longest known one, row 0 without any."""
        marked, at, out, i = f"^{w}$", self._gram_at, [], 0
        while i < len(marked):
            for size in range(min(GRAM, len(marked) - i), 0, -1):
                known = at.get(marked[i : i + size])
                if known is not None:
                    out.append(known)
                    break
            else:
                size = 1
                out.append(0)
            # overlap by all but one character of the n-gram just read, so word parts are not cut apart
            i += max(1, size - 1)
        return out

    def _index_grams(self) -> None:
        """The n-grams' languages and gains over the floor, one after the other; row 0, of characters in no n-gram, gains nothing."""
        self._gram_at = {g: k + 1 for k, g in enumerate(self.grams)}
        sizes = [0, 0, *map(len, self.grams.values())]
        self._gram_first = np.cumsum(sizes)
        self._gram_lang = np.array([k for by in self.grams.values() for k in by], dtype=np.int64)
        self._gram_gain = np.array([x for by in self.grams.values() for x in by.values()], dtype=float) - self.floor[self._gram_lang]

    def _means(self, parts: list[list[int]]) -> np.ndarray:
        """Mean log frequencies by language of the n-grams of each word."""
        size, width = np.array([len(x) for x in parts]), len(self.languages)
        flat, word = np.concatenate(parts), np.repeat(np.arange(len(parts)), size)
        first = self._gram_first[flat]
        many = self._gram_first[flat + 1] - first
        at = np.repeat(first - (np.cumsum(many) - many), many) + np.arange(many.sum())
        gain = np.bincount(np.repeat(word, many) * width + self._gram_lang[at], weights=self._gram_gain[at], minlength=len(parts) * width)
        return self.floor + gain.reshape(len(parts), width) / size[:, None]

    def _learn(self, words: list[str]) -> None:
        """Rows for words: their own log frequencies, or the mean of their parts. Rows of other words go where there is no room for both."""
        if self._gram_first is None:
            self._index_grams()
        new = [w for w in words if w not in self._at]
        if not new and self._rows is not None:
            return
        if self._rows is None or len(self._at) + len(new) > self._room():
            self._at, self._rows, new = {}, np.empty((0, len(self.languages))), words
        known = [w for w in new if w in self.words]
        unseen = [w for w in new if w not in self.words]
        rows = [self._rows, self._dense([self.words[w] for w in known], self.word_floor)]
        if unseen:
            rows.append(self._means([self._parts(w) for w in unseen]))
        for w in known + unseen:
            self._at[w] = len(self._at)
        self._rows = np.vstack(rows)

    def _room(self) -> int:
        return max(1, CACHE // max(1, len(self.languages)))

    def predict_many(self, texts: list[str | None]) -> list[tuple[str, float]]:
        found = [Counter(letters(t.lower())) if t else Counter() for t in texts]
        out = [(UNKNOWN, 0.0)] * len(texts)
        some = [k for k, c in enumerate(found) if c]
        if not some or not self.languages:
            return out
        size = np.array([len(found[k]) for k in some])
        doc = np.repeat(np.arange(len(some)), size)
        words = [w for k in some for w in found[k]]
        times = np.array([n for k in some for n in found[k].values()], dtype=float)
        total, room = np.zeros((len(some), len(self.languages))), self._room()
        for lo in range(0, len(words), room):
            part, own = words[lo : lo + room], doc[lo : lo + room]
            self._learn(list(dict.fromkeys(part)))
            first = np.flatnonzero(np.diff(own, prepend=-1))
            total[own[first]] += np.add.reduceat(self._rows[[self._at[w] for w in part]] * times[lo : lo + room, None], first, axis=0)
        count = np.bincount(doc, weights=times)
        mean = total / count[:, None] * np.minimum(count, EVIDENCE)[:, None]
        p = np.exp(mean - mean.max(axis=1, keepdims=True))
        best = p.argmax(axis=1)
        for k, b, score in zip(some, best, p.max(axis=1) / p.sum(axis=1), strict=True):
            out[k] = (self.languages[int(b)], float(score))
        return out

    def predict(self, text: str | None) -> tuple[str, float]:
        return self.predict_many([text])[0]


def _log_frequencies(rows: list, languages: list[str]) -> tuple[dict[str, Sparse], np.ndarray]:
    """Smoothed log frequencies of (lang, item, n) rows, and what an item has in a language that lacks it."""
    at = {lang: k for k, lang in enumerate(languages)}
    whole, items = np.zeros(len(languages)), {}
    for r in rows:
        whole[at[r["lang"]]] += r["n"]
        items.setdefault(r["item"], {})[at[r["lang"]]] = r["n"]
    whole += 0.5 * max(1, len(items))
    floor = np.log(0.5 / whole)
    return {w: {k: float(np.log((n + 0.5) / whole[k])) for k, n in by.items()} for w, by in items.items()}, floor


def train_language_model(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, top: int = TOP) -> LanguageModel:
    """Model of the (text, lang) rows that are not held out; rows with a null id, text or language teach nothing.

    A document of several rows teaches once, by the least of its (lang, text). All languages of these rows are learned.
    """
    told = docs.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    per = told.groupBy("lang").agg(F.count("*").alias("n"))
    langs = durable(per)
    # ids are chosen without their texts; the written table is small, so the texts are met by broadcast and stay where they are
    ids = durable(told.select("doc_id", "lang").join(langs, "lang").filter(F.pmod(F.xxhash64("doc_id"), F.greatest("n", F.lit(sample_docs))) < sample_docs).select("doc_id").distinct())
    one = told.join(ids, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct("lang", "text")).alias("d"))
    sample = durable(one.select("d.lang", "d.text"))
    found = durable(sample.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))).alias("item")).groupBy("lang", "item").agg(F.count("*").alias("n")))
    marked = F.concat(F.lit("^"), F.col("item"), F.lit("$"))
    spans = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(GRAM)), lambda size: F.when(F.length(marked) >= size, F.transform(F.sequence(F.lit(1), F.length(marked) - size + 1), lambda i: F.substring(marked, i, size))).otherwise(F.array().cast("array<string>"))))
    grams = found.select("lang", "n", F.explode(spans).alias("item")).groupBy("lang", "item").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), "item")
    top = max(1, min(top, TOP_ALL // max(1, langs.count())))
    best = lambda df: df.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= top).select("lang", "item", "n").collect()
    word_rows, gram_rows = best(found), best(grams)
    languages = sorted({r["lang"] for r in word_rows})
    words, word_floor = _log_frequencies(word_rows, languages)
    gram, floor = _log_frequencies(gram_rows, languages)
    return LanguageModel(languages, words, gram, word_floor, floor)


def identify_language(docs: DataFrame, model: LanguageModel | None = None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for each row; ``und`` and 0 for a null text or one without letters.

    Predictions use the text alone. Repeated rows are predicted each; without training rows all are ``und``. Other columns
    are ignored.
    """
    model = model or train_language_model(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for whole in batches:
            for lo in range(0, whole.num_rows, 128):
                batch = whole.slice(lo, 128)
                said = m.predict_many(batch.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([s[0] for s in said], pa.string()), pa.array([s[1] for s in said], pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def op5_language_id(spark, sf_dir: str) -> DataFrame:
    """Query: the language of all ``documents``."""
    return identify_language(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang"))
