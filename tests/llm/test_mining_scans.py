"""Hard negatives, collocations and licence scans against brute force and their SQL."""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from types import SimpleNamespace

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import recordscope.llm.negatives as negatives
import recordscope.llm.phrases as phrases
import recordscope.llm.tokens as tokens
from recordscope.llm import oracles, registry
from recordscope.llm.licenses import NOTICES, rare_places, scan_licenses, templates
from recordscope.llm.negatives import hard_negatives, strassen
from recordscope.llm.phrases import collocations

SF = "/root/testdata/sf0.001"


def test_queries_equal_their_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    for name in ("op11_hard_negatives", "op12_collocations", "op13_license_scan"):
        df = registry.QUERIES[name](spark, SF)
        columns = sorted(df.columns)
        result = con.execute(oracles.__dict__[name.split("_")[0].upper()])
        own = [c[0] for c in result.description]
        assert sorted(own) == columns
        want = sorted((tuple(r[own.index(c)] for c in columns) for r in result.fetchall()), key=str)
        got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)
        assert got == want and (got or name == "op12_collocations")


def test_strassen_is_exact_modulo_a_word():
    rng = np.random.default_rng(1)
    for m, k, n in ((1, 1, 1), (33, 65, 129), (70, 64, 41), (128, 3, 77)):
        a, b = rng.integers(-(2**62), 2**62, (m, k)), rng.integers(-(2**62), 2**62, (k, n))
        assert (strassen(a, b, 4) == a @ b).all()
    big = np.full((40, 40), 2**28)
    assert (strassen(big, big, 8) == 40 * 2**56).all()


def brute_negatives(rows, is_anchor, k=5, low=80):
    ok: dict = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        if sum(min(abs(x * 256) + 1, 1e99) ** 2 for x in v) < 2.0**62:
            ok[i] = min(ok.get(i, (math.inf, [])), (label, [math.floor(256 * x) for x in v]))
    score = lambda a, b: sum(x * y for x, y in zip(ok[a][1], ok[b][1], strict=False))
    out = set()
    for a in filter(is_anchor, ok):
        order = sorted((i for i in ok if i != a), key=lambda i: (-score(a, i), i))
        for p in [i for i in order if ok[i][0] == ok[a][0]][:k]:
            s = score(a, p)
            hard = [i for i in order if ok[i][0] != ok[a][0] and low * s <= 100 * score(a, i) <= 100 * s][:k]
            out |= {(a, p, r, i, s, score(a, i)) for r, i in enumerate(hard, 1)}
    return out


@pytest.mark.parametrize("small", [False, True])
def test_hard_negatives_match_brute_force(spark, monkeypatch, small):
    if small:  # many cells, several tiles in each, leaves of a few rows
        for name, value in (("ANCHORS", 4), ("ROWS", 16), ("TILE", (3, 5)), ("LEAF", 2)):
            monkeypatch.setattr(negatives, name, value)
    rng = random.Random(5)
    values = (0.0, 0.5, 1.0, -0.25, 0.1)
    rows = [(i, [rng.choice(values) for _ in range(6)], rng.choice((0, 0, 0, 1, 2))) for i in range(90)]
    rows += [(100, None, 0), (101, [], 0), (102, [math.nan] * 6, 0), (103, [None] * 6, 1), (104, [math.inf] * 6, 1), (105, [1.0] * 9, 1), (106, [1.0, 1.0], 0), (107, [1.0] * 6, None), (None, [1.0] * 6, 0), (108, [1e300] * 6, 0), (110, [2.0**21] * 6, 0), (109, [2.0**21] * 6, 1)]
    rows += [rows[3], rows[10], (10, [9.0] * 6, 2), rows[3]]
    df = spark.createDataFrame([(*r, "x", 7) for r in rows], "vec_id long, embedding array<double>, label int, q string, anchor int")
    got = hard_negatives(df, F.col("vec_id") % 10 == 0, F.col("label")).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()
    want = brute_negatives(rows, lambda i: i % 10 == 0)
    assert len(got) == len(want) > 100 and {tuple(r) for r in got} == want
    assert hard_negatives(df.limit(0), F.col("vec_id") % 10 == 0, F.col("label")).count() == 0
    with pytest.raises(ValueError):
        hard_negatives(df, F.lit(True), F.col("label"), low=100)


def brute_phrases(rows, least, top):
    f: dict = {}
    n: Counter = Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    f.setdefault(lang, Counter())[tuple(words[i : i + k])] += 1
    out = {}
    for lang, own in f.items():
        often = {p: c for p, c in own.items() if len(p) > 1 and c >= least}
        inside = {q[i : i + k] for q, c in often.items() for k in range(2, len(q)) for i in range(len(q) - k + 1) if c >= own[q[i : i + k]]}
        rows = []
        for p, a in often.items():
            if p in inside:
                continue
            score, cut = min((1000 * a * n[lang] // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p)))
            rows.append((" ".join(p), a, own[p[:cut]], own[p[cut:]], n[lang], score))
        rows.sort(key=lambda r: (-r[5], -r[1], r[0].encode()))
        out |= {(lang, k): r for k, r in enumerate(rows[:top], 1)}
    return out


def phrase_rows():
    rng = random.Random(9)
    vocabulary = ["a", "b", "c", "New", "york", "Éa", "x\x00y", " z", "ß", "d-e"]
    seps = [" ", " ", " ", " ", "  ", "\t", ", ", ".\n", "\x0b", " ; "]
    text = lambda n: "".join(rng.choice(vocabulary) + rng.choice(seps) for _ in range(n))
    rows = [(rng.choice(["en", "de", None, "und", ""]), text(rng.randint(1, 60))) for _ in range(150)]
    rows += [("en", "New York city hall stands"), ("en", "new york city hall stands")] * 12
    return [*rows, ("en", None), ("en", ""), (None, "..,"), ("de", "a a a a a a a"), ("en", "x" * 5000), *rows[:3]]


@pytest.mark.parametrize("bits", [28, 3])
def test_collocations_match_brute_force(spark, monkeypatch, bits):
    """Also where counters are so few that all pairs share them."""
    monkeypatch.setattr(phrases, "HELD", 50)
    rows = phrase_rows()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "lang string, text string, phrase string, n int").repartition(3)
    got = collocations(df, 10, 20, bits=bits).collect()
    want = brute_phrases(rows, 10, 20)
    assert len(got) == len(want) > 30
    assert {(r["lang"], r["rank"]): (r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in got} == want
    assert collocations(df.limit(0)).count() == 0 and collocations(df, 10**6).count() == 0


def test_slices_cut_no_edge(monkeypatch):
    rows = phrase_rows()
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] or "und" for r in rows]), pa.array([r[1] or "" for r in rows])], names=["lang", "text"])

    def edges(size):
        monkeypatch.setattr(phrases, "slices", lambda data: tokens.slices(data, size))
        pairs = Counter()
        for b in phrases._count_pairs(16)(iter([batch])):
            for slots, n in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                pairs.update({int(s): int(c) for s, c in zip(np.frombuffer(slots, "<u2"), np.frombuffer(n, np.uint8), strict=True)})
        bitmap = np.zeros(1 << 13, dtype=np.uint8)
        for slot, n in pairs.items():
            bitmap[slot >> 3] |= (128 >> (slot & 7)) if n >= 20 else 0
        out = Counter()
        for b in phrases._edges(5, 16, SimpleNamespace(value=bitmap))(iter([batch])):
            for lang, gram, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                out[lang, gram] += n
        return out

    whole = edges(1 << 20)
    assert {len(g.split(" ")) for _, g in whole} == {1, 2, 3, 4, 5}
    assert edges(7) == edges(64) == whole


def test_very_long_texts_of_phrases(spark):
    """A text of one piece, many slices long, and one without any space."""
    long = "red green blue " * 400_000
    df = spark.createDataFrame([("en", long), ("en", "y" * 3_000_000), ("en", "," * 1_000_000)], "lang string, text string")
    got = {r["phrase"]: (r["a"], r["n"]) for r in collocations(df, 100).collect()}
    assert got["red green blue red green"] == (399_999, 1_200_001) and len(got) == 4


def brute_licenses(text, least=50):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    out = []
    for label, notice, key, at, base in templates():
        for i in range(len(words)):
            if words[i : i + len(key)] == key:
                same = sum(0 <= i - at + o < len(words) and words[i - at + o] == w for o, w in enumerate(notice))
                if 100 * same >= least * len(notice):
                    out.append((i, label, base, same / len(notice)))
    return len(words), sorted(out)


def test_licenses_match_brute_force(spark):
    rng = random.Random(3)
    parts = [" ".join(n[1].split()) for n in NOTICES] + ["GNU General-Public License", "Apache\nLicense", "CC-BY", "CC BY NC 4.0", "MIT license mit LICENSE", "gnu general public", "öapache license", "apache licenseé", "the", "any", "İ mİt license", "K"]
    texts = []
    for _ in range(120):
        words = " ".join(rng.choice(parts) for _ in range(rng.randint(1, 8))).split(" ")
        texts.append(rng.choice([" ", ", ", "-", "\u0001"]).join(w for w in words if rng.random() > 0.05).title() if rng.random() < 0.5 else " ".join(words))
    texts += [None, "", "  ", "license", "by nc 4 0", "mit license " * 30_000, texts[0], texts[0]]
    df = spark.createDataFrame([(i if i % 9 else None, t, "x", 2) for i, t in enumerate(texts)], "doc_id long, text string, words string, found int").repartition(4)
    got = sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["found"]]) for r in scan_licenses(df).collect()), key=str)
    want = sorted(((i if i % 9 else None, *brute_licenses(t)) for i, t in enumerate(texts)), key=str)
    assert got == want
    assert {label for _, _, found in got for _, label, _, _ in found} >= {n[0] for n in NOTICES}
    assert scan_licenses(df.limit(0)).count() == 0


def test_index_posts_the_rarest_words():
    assert rare_places("gnu general public license".split(), 3, {"gnu": 5, "general": 90, "public": 4, "license": 50}) == [(5, "public"), (3, "gnu")]
