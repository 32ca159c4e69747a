"""Brute-force checks of the text operators on small fixtures and on a test table."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from recordscope.llm.common import connected_components
from recordscope.llm.minhash import _compare_blocks, drop_near_copies, minhash_dedup, shingle_sets, signatures
from recordscope.llm.mixing import mix_sources
from recordscope.llm.packing import hilbert_index, pack_along_curve
from recordscope.llm.quality import FEATURES, judge, learn_rules, measure, quality_rules, sample_labels, train_rules

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
BASE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty"


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, node string, token int, side int, size int")


def odd_rows():
    texts = [None, "", " \t\n", "a", "a b c d", "A B C D", BASE, BASE.upper(), BASE + " extra", "x " * 3000, "straße ÉTÉ ok # * $\nline\nline\n", "<|endoftext|> plain \U0001f600", "a <|endoftext|><|endoftext|>  b<|endoftext|", "word " * 40_000]
    rows = [(i, t, None if i % 3 else "en", None if i % 4 == 0 else f"s{i % 4}", i, "n", 1, 2, 3) for i, t in enumerate(texts)]
    return rows + [rows[6], rows[6], (None, BASE, None, None, None, None, None, None, None)]


def shingles(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return set(zip(w, w[1:], w[2:], w[3:], w[4:], strict=False))


def brute_components(rows):
    sets = {i: shingles(t) for i, t in rows}
    comp = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    for _ in sets:
        for a, b in links:
            comp[a] = comp[b] = min(comp[a], comp[b])
    return {i: (len(sets[i]), comp[i], comp[i] == i) for i in sets}


def test_minhash_odd_rows(spark):
    rows = odd_rows()
    got = minhash_dedup(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    want = brute_components({(r[0], r[1]) for r in rows if r[0] is not None})
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"] is False
        else:
            assert (r["n_shingles"], r["component_id"], r["kept"]) == want[r["doc_id"]]


def test_minhash_empty_table(spark):
    assert minhash_dedup(documents(spark, [])).count() == 0


def test_minhash_long_lists_match_brute_force(spark, monkeypatch):
    """With short limits nearly all lists count as long, and blocks are small; the components stay the same."""
    import recordscope.llm.minhash as m

    monkeypatch.setattr(m, "HEAVY", 3)
    monkeypatch.setattr(m, "BLOCK", 5)
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(40):
        w = list(base)
        for _ in range(int(rng.integers(0, 5))):
            w[int(rng.integers(0, 80))] = f"x{i}{rng.integers(0, 9)}"
        rows.append((i, " ".join(w[: int(rng.integers(55, 81))])))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in minhash_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_components(rows)
    assert len({v[1] for v in got.values()}) > 1


def test_shingle_sets_are_exact_classes():
    texts = [BASE, BASE.upper(), BASE.replace(" ", "\t\n"), BASE + " x", "a b", "b a", ""]
    sets = [tuple(s) for s in shingle_sets(texts)]
    assert sets[0] == sets[1] == sets[2] != sets[3] and sets[4] != sets[5] and sets[6] == ()
    assert [len(s) for s in sets] == [len(shingles(t)) for t in texts]
    sig = signatures([np.array(s, dtype=np.uint64) for s in sets])
    assert (sig[0] == sig[1]).all() and (sig[0] == sig[3]).mean() > 0.6


def test_mix_targets_and_limits(spark):
    rows = odd_rows() + [(100 + i, "word " * (1 + i % 37), "en", "big", 1, "n", 1, 2, 3) for i in range(600)]
    docs = documents(spark, rows)
    got = mix_sources(docs, keep=("text", "source")).collect()
    assert len(got) == len(rows) == mix_sources(docs).count()
    by = defaultdict(list)
    for r in got:
        assert r["size"] == len(WORD.findall(r["text"] or "")) and 0 <= r["taken"] <= 2 * r["size"]
        by[r["source"]].append(r)
    whole = sum(r["size"] for r in got)
    assert sum(v[0]["target"] for v in by.values()) == pytest.approx(1.5 * whole)
    level = {}
    for k, (name, v) in enumerate(sorted(by.items(), key=lambda x: (x[0] is None, x[0] or ""))):
        assert v[0]["source_size"] == sum(r["size"] for r in v) and v[0]["target"] <= 2 * v[0]["source_size"]
        if v[0]["target"] < 2 * v[0]["source_size"]:
            level[name] = v[0]["target"] / (3, 1, 2)[k % 3]
    assert max(level.values()) == pytest.approx(min(level.values()))
    assert sum(r["taken"] for r in by["big"]) == pytest.approx(by["big"][0]["target"], rel=0.02)
    assert mix_sources(documents(spark, [])).count() == 0
    again = sorted((r["doc_id"] or -1, r["taken"]) for r in mix_sources(docs.repartition(3)).collect())
    assert again == sorted((r["doc_id"] or -1, r["taken"]) for r in got)


def brute_measures(text):
    text = text or ""
    w = WORD.findall(text)
    tri = Counter(zip(w, w[1:], w[2:], strict=False))
    hit = {i + j for i, t in enumerate(zip(w, w[1:], w[2:], strict=False)) if tri[t] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


def test_quality_measures_and_held_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    got = {r["doc_id"]: r for r in quality_rules(docs, labels.filter(~held)).collect()}
    truth = {r["doc_id"]: r["quality"] for r in labels.filter(held).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for i, r in got.items():
        want = brute_measures(texts[i])
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
    # labels that the rules never saw
    ok = [i for i in truth if not got[i]["base_failed"]]
    assert len(ok) > 50
    assert sum(got[i]["kept"] == (truth[i] == 1) for i in ok) >= 0.95 * len(ok)
    assert sum(not got[i]["kept"] for i in ok if truth[i] == 1) <= 0.03 * len(ok)


def test_verdict_follows_the_learned_list(spark):
    """Each row's rule number equals a plain walk down the list over the same measures."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    measured = measure(docs).cache()
    rules = train_rules(measured, sample_labels(labels))
    assert rules
    facts = [r.asDict() for r in judge(measured, rules).select("*", *[F.expr(v).cast("double").alias(k) for k, v in FEATURES.items()]).collect()]
    for r in facts:
        first = next((k for k, rule in enumerate(rules, 1) if all((r[t.feature] > t.cut) == t.above for t in rule)), 0)
        assert r["rule"] == first and r["kept"] == (not r["base_failed"] and first == 0)


def test_quality_odd_rows_and_no_labels(spark):
    docs = documents(spark, odd_rows())
    none = spark.createDataFrame([], "doc_id long, quality int, n_words int")
    got = quality_rules(docs, none).collect()
    assert len(got) == len(odd_rows()) and all(r["kept"] is not None for r in got)
    nulls = spark.createDataFrame([(None, 1, 2), (6, None, 2), (8, 1, 2), (8, 0, 2)], "doc_id long, quality int, n_words int")
    assert quality_rules(docs, nulls).count() == len(odd_rows())
    assert quality_rules(documents(spark, []), none).count() == 0


def test_rules_find_a_planted_conjunction():
    from recordscope.llm.quality import FEATURES

    rng = np.random.default_rng(0)
    x = {k: rng.random(3000) for k in FEATURES}
    bad = (x["upper_share"] > 0.7) & (x["symbols_per_word"] <= 0.4)
    rules = learn_rules(x, bad)
    assert rules and {t.feature for t in rules[0]} <= {"upper_share", "symbols_per_word"}
    assert learn_rules(x, np.zeros(3000, dtype=bool)) == []


def test_hilbert_neighbours_touch():
    side = 8
    grid = np.array([[i, j, k] for i in range(side) for j in range(side) for k in range(side)])
    order = np.argsort(hilbert_index(grid, 3))
    assert sorted(hilbert_index(grid, 3)) == list(range(side**3))
    assert (np.abs(np.diff(grid[order], axis=0)).sum(axis=1) == 1).all()


def test_packing_round_trip(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    table = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    docs = table.withColumn("doc_id", F.col("doc_id") + 1000).unionByName(documents(spark, odd_rows()).select("doc_id", "text"))
    rows = docs.collect()
    ids = {r["doc_id"]: tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [0] for r in rows}
    times = Counter(r["doc_id"] for r in rows)
    covered, sequences = Counter(), defaultdict(list)
    for p in pack_along_curve(docs).collect():
        own = ids[p["doc_id"]]
        piece = own[p["start"] : p["start"] + p["length"]]
        assert len(piece) == p["length"] > 0 and p["doc_tokens"] == len(own)
        assert p["ids_crc32"] == zlib.crc32(np.array(piece, dtype="<u4").tobytes())
        covered[p["doc_id"]] += p["length"]
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
    assert covered == {k: times[k] * len(v) for k, v in ids.items()}
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert sorted(sequences) == list(range(len(sequences)))
    assert len(sequences) <= sum(covered.values()) / 1024 + 8
    assert pack_along_curve(documents(spark, [])).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=20), st.sampled_from(["<|endoftext|>", "<|endof", "text|>", " ", "\n\n", "don't", "42", "é"])), max_size=12))
def test_ids_equal_the_named_tokenizer(parts):
    import public_tokenizers
    from tokenizers import Tokenizer

    from recordscope.llm.packing import default_vocabulary, encoder

    text = "".join(parts)
    plain = _TOKENIZER.setdefault(0, Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")))
    assert encoder(default_vocabulary()).encode(text) == plain.encode(text, add_special_tokens=False).ids


_TOKENIZER = {}


def test_neighbours_along_the_curve_are_packed_together(spark):
    """Of documents that share a sequence, far more share a language than chance would give; equal keys spread over partitions."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lang = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    share = Counter(lang.values())
    chance = sum((n / len(lang)) ** 2 for n in share.values())
    by = defaultdict(list)
    for p in pack_along_curve(docs).collect():
        by[p["sequence_id"]].append((p["offset"], lang[p["doc_id"]]))
    near = [a[1] == b[1] for v in by.values() for a, b in zip(sorted(v), sorted(v)[1:], strict=False)]
    assert np.mean(near) > chance + 0.5 * (1 - chance)


def test_packing_splits_equal_rows(spark, monkeypatch):
    import recordscope.llm.packing as pk

    monkeypatch.setattr(pk, "PART_BYTES", 2_000)
    docs = spark.createDataFrame([(None, "same words in every row of this table")] * 2_000, "doc_id long, text string")
    pieces = pk.pack_along_curve(docs)
    assert pieces.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0] <= 1024
    assert pieces.agg(F.sum("length")).first()[0] == 2_000 * pieces.first()["doc_tokens"]
    sequences = pieces.select("sequence_id").distinct().count()
    # one partition would fill them to the last: 18
    assert sequences > -(-2_000 * pieces.first()["doc_tokens"] // 1024)


def planted_pairs(n):
    """Pairs of texts with exactly 3/4 of their union of shingles in common: 60 shared ones, 10 of their own each."""
    out = []
    for i in range(n):
        shared = [f"s{i}x{k}" for k in range(64)]
        out.append((2 * i, " ".join(shared + [f"a{i}x{k}" for k in range(10)])))
        out.append((2 * i + 1, " ".join(shared + [f"b{i}x{k}" for k in range(10)])))
    return out


def test_recall_at_the_threshold(spark):
    """2,000 pairs at exactly 0.75: the chance to miss one is below 1e-6, so none may be missed."""
    rows = planted_pairs(2_000)
    a, b = shingles(rows[0][1]), shingles(rows[1][1])
    assert 100 * len(a & b) == 75 * len(a | b)
    got = {r["doc_id"]: r["component_id"] for r in minhash_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i] == i - i % 2 for i in got)


def test_one_group_of_half_the_rows(spark, monkeypatch):
    """A hot group of near copies: leaders join it, so blocks see what is outside its component only, and the result is exact."""
    import recordscope.llm.minhash as m

    monkeypatch.setattr(m, "HEAVY", 20)
    monkeypatch.setattr(m, "BLOCK", 16)
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(int(rng.integers(0, 3))):
            w[int(rng.integers(0, 200))] = f"x{i}"
        rows.append((i, " ".join(w)))
    rows += [(150 + i, " ".join(base[: 140 + i % 20] + [f"y{i}z{k}" for k in range(30)])) for i in range(60)]
    rows += [(300 + i, " ".join(f"z{i}q{k}" for k in range(50))) for i in range(100)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in minhash_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_components(rows)


def test_dropping_near_copies_keeps_rows_apart(spark):
    """Shared ids with other texts both stay, null ids take part, of repeated rows one stays, rows without words all stay."""
    rows = [(1, BASE, "a"), (1, "other words " * 9, "b"), (None, BASE, "c"), (None, "third text here " * 9, "d"), (2, BASE.upper(), "e"), (3, None, "f"), (3, None, "f"), (1, BASE, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    got = Counter((r["doc_id"], r["text"], r["component_id"]) for r in drop_near_copies(docs).collect())
    assert got == Counter([rows[0], rows[1], rows[3], rows[5], rows[6]])
    assert drop_near_copies(docs.limit(0)).count() == 0


def test_components_of_a_path(spark):
    """An ascending path, the worst case of a fixed order of labels."""
    n = 300
    got = connected_components(spark.range(n).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))).collect()
    assert len(got) == n + 1 and len({r["component"] for r in got}) == 1


def test_mix_spreads_null_and_equal_ids(spark, monkeypatch):
    """One source whose rows all lack an id or repeat: no partition holds them all, reruns over other parts agree."""
    import recordscope.llm.mixing as mx

    monkeypatch.setattr(mx, "PART_ROWS", 100)
    rows = [(None, f"w{i % 9} " * (1 + i % 5), "s") for i in range(600)] + [(7, "same words", "s")] * 400 + [(8, "other", "t")] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    one, two = (sorted((r["doc_id"] or -1, r["text"], r["taken"]) for r in mix_sources(d, keep=("text",)).collect()) for d in (docs, docs.repartition(5)))
    assert one == two and len(one) == len(rows)
    taken, target = sum(x[2] for x in one if x[0] != 8), next(r["target"] for r in mix_sources(docs).filter("doc_id = 7").collect())
    assert abs(taken / target - 1) < 0.02


def test_compare_blocks_returns_a_forest():
    import pandas as pd

    sets = list(shingle_sets([BASE + f" tail{i}" for i in range(6)]))
    sig = signatures(sets).view(np.int32)
    pdf = pd.DataFrame({"side": [0] * 6, "component": [bytes([i]) for i in range(6)], "sig": list(sig), "shingles": [s.view(np.int64) for s in sets]})
    links = {tuple(x) for c in range(3) for x in _compare_blocks((c,), pdf).to_numpy()}
    assert links and all(a != b for a, b in links) and max(len(_compare_blocks((c,), pdf)) for c in range(3)) <= 5


def thue_morse(n):
    return "".join("ab"[bin(k).count("1") % 2] for k in range(n))


def test_words_made_to_collide_under_polynomial_hashes(spark):
    """Complementary Thue-Morse words have equal values of any polynomial modulo 2^64; they are different words all the same."""
    x = thue_morse(2048)
    y = x.translate(str.maketrans("ab", "ba"))
    got = {r["doc_id"]: r["component_id"] for r in minhash_dedup(documents(spark, [(i, t, "en", "s", 1, "n", 1, 2, 3) for i, t in enumerate((x, y))])).collect()}
    assert got == {0: 0, 1: 1}
    rows = [(0, f"A {x} u B {y} u", "en", "s", 1, "n", 1, 2, 3), (1, f"A {x} u B {x} u A {x} u", "en", "s", 1, "n", 1, 2, 3)]
    assert {r["doc_id"]: r["n_repeat_words"] for r in measure(documents(spark, rows)).collect()} == {0: 0, 1: 6}


def test_very_long_texts_are_hashed_in_slices(spark, monkeypatch):
    import recordscope.llm.minhash as m
    import recordscope.llm.tokens as t

    words = [f"w{k % 70_001}" for k in range(600_000)]
    long = "\t ".join(words)
    assert len(long.encode()) > 3 * t.SLICE
    whole = next(iter(shingle_sets([long])))
    monkeypatch.setattr(m, "slices", lambda data: [data])
    assert (next(iter(shingle_sets([long]))) == whole).all() and len(whole) == len(shingles(long))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash_dedup(documents(spark, [(i, x, "en", "s", 1, "n", 1, 2, 3) for i, x in enumerate((long, long + " end", "y" * 5_000_000))])).collect()}
    assert got == {0: (len(whole), 0), 1: (len(whole) + 1, 0), 2: (1, 2)}


def test_runs_of_one_kind_of_characters_are_packed(spark):
    """Where the fast encoder fails, ids are those of the named tokenizer; every id lies in exactly one piece."""
    import public_tokenizers
    from tokenizers import Tokenizer

    named = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [" " * 1_500_000, "\n" * 1_200_000, "a" * 200_000, "!" * 200_000, "x" + " " * 9_999 + "y" * 9_999, "é" * 60_000, "7" * 100_000 + "<|endoftext|> a"]
    rows = [(i, t, "en", "s", 1, "n", 1, 2, 3) for i, t in enumerate(texts)]
    pieces = defaultdict(list)
    for r in pack_along_curve(documents(spark, rows)).collect():
        pieces[r["doc_id"]].append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
    for i, t in enumerate(texts):
        ids = [*named.encode(t, add_special_tokens=False).ids, 0]
        at = 0
        for start, length, crc, total in sorted(pieces[i]):
            assert start == at and total == len(ids) and crc == zlib.crc32(np.array(ids[start : start + length], dtype="<u4").tobytes())
            at += length
        assert at == len(ids)
