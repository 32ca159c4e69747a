"""Held-out accuracy and edge rows of language identification and toxicity."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from recordscope.llm.language import EVIDENCE, GRAM, identify_language, train_language_model
from recordscope.llm.toxicity import IDENTITY_TERMS, counterfactuals, fit, score_toxicity, swaps, text_words, toxicity, train_toxicity, word_features

SF = "/root/testdata/sf0.01"


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r["doc_id"]: r for r in identify_language(docs).collect()}
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for i, r in rows.items())
    held = [i for i, r in rows.items() if r["held_out"]]
    assert sum(rows[i]["lang_pred"] == truth[i] for i in held) >= 0.98 * len(held)


def test_language_odd_rows(spark):
    rows = [(i, t, lang, "s", 1.0) for i, (t, lang) in enumerate([("the house is old", "en")] * 30 + [("das Haus ist alt", "de")] * 30 + [(None, "en"), ("", None), ("² ½ 12 Ⅷ ①", "de"), ("hausung", None), ("das alte Haus " * 50_000, None)])]
    docs = spark.createDataFrame([*rows, rows[0], (None, "das alte Haus", None, None, None)], "doc_id long, text string, lang string, source string, score double")
    got = [(r["doc_id"], r["lang_pred"], r["score"]) for r in identify_language(docs).collect()]
    assert len(got) == len(rows) + 2
    by = {i: (lang, s) for i, lang, s in got}
    assert by[60] == by[61] == by[62] == ("und", 0.0) and by[63][0] == "de" and by[64][0] == "de" and by[None][0] == "de" and by[0][0] == "en"
    assert identify_language(docs.limit(0)).count() == 0
    assert {r["lang_pred"] for r in identify_language(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_unseen_words_back_off(spark):
    docs = spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate([("walking talking", "en"), ("gehung stehung", "de")] * 20)], "doc_id long, text string, lang string")
    model = train_language_model(docs)
    assert "barking" not in model.words and model.predict("barking")[0] == "en" and model.predict("prehung")[0] == "de"


def brute_language(rows, text):
    """The posterior of a text from counts of all training rows, word by word: known words first, else the longest known n-grams."""
    words, grams = {}, {}
    for i, t, lang in rows:
        if zlib.crc32(str(i).encode()) % 4 != 2:
            for w in re.findall("[a-zäöüß]+", t.lower()):
                words.setdefault(lang, Counter())[w] += 1
                m = f"^{w}$"
                for n in range(1, GRAM + 1):
                    for k in range(len(m) - n + 1):
                        grams.setdefault(lang, Counter())[m[k : k + n]] += 1
    langs = sorted(words)
    def logs(counts):
        kinds = {x for c in counts.values() for x in c}
        return kinds, lambda x: np.array([math.log((counts[la][x] + 0.5) / (sum(counts[la].values()) + 0.5 * len(kinds))) for la in langs])
    known, word_log = logs(words)
    parts, gram_log = logs(grams)
    found, total = re.findall("[a-zäöüß]+", (text or "").lower()), np.zeros(len(langs))
    if not found:
        return "und", 0.0
    for w in found:
        if w in known:
            total += word_log(w)
            continue
        m, at, read = f"^{w}$", 0, []
        while at < len(m):
            n = next((n for n in range(min(GRAM, len(m) - at), 0, -1) if m[at : at + n] in parts), 0)
            read.append(gram_log(m[at : at + n]) if n else gram_log(""))
            at += max(1, n - 1)
        total += np.mean(read, axis=0)
    z = total / len(found) * min(len(found), EVIDENCE)
    p = np.exp(z - z.max())
    return langs[int(p.argmax())], float(p.max() / p.sum())


def test_language_matches_brute_force(spark):
    rng = np.random.default_rng(8)
    stems = {"en": ["walk", "talk", "house", "stone", "light"], "de": ["gehen", "haus", "stein", "licht", "grün"], "fr": ["maison", "pierre", "jour", "aller"]}
    ends = {"en": ["ing", "ed", "s"], "de": ["ung", "en", "keit"], "fr": ["tion", "ez", "eux"]}
    rows = []
    for i in range(240):
        lang = ("en", "de", "fr")[i % 3]
        rows.append((i, " ".join(rng.choice(stems[lang]) + rng.choice(ends[lang]) for _ in range(int(rng.integers(1, 40)))), lang))
    odd = [(1000, "walkung steined xyzzy qq", None), (1001, "grünlich", None), (1002, None, None), (1003, "12 ²", None)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string")
    for r in identify_language(docs).collect():
        text = next(t for i, t, _ in rows + odd if i == r["doc_id"])
        lang, score = brute_language(rows, text)
        assert r["lang_pred"] == lang and abs(r["score"] - score) < 1e-9


def test_many_languages_and_repeated_ids_stay_bounded(spark, monkeypatch):
    import recordscope.llm.language as lg

    monkeypatch.setattr(lg, "TOP_ALL", 400)
    rows = [(1000 * k + i, f"wort{k}a wort{k}b wort{k}c", f"l{k:03d}") for k in range(100) for i in range(4)] + [(7, f"copy{i}", "l000") for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = train_language_model(docs)
    assert sum(map(len, model.words.values())) <= 400 and sum(map(len, model.grams.values())) <= 400
    assert sum(w.startswith("copy") for w in model.words) <= 1
    few = train_language_model(spark.createDataFrame([(1, "ein", "de")], "doc_id long, text string, lang string"))
    assert few.languages == ["de"]


def test_rare_languages_are_learned_and_scores_do_not_depend_on_room(spark, monkeypatch):
    """Seven hundred languages, one of them with a single document; a task with room for few words gives the same scores."""
    import recordscope.llm.language as lg

    rows = [(4 * (700 * i + k), " ".join(f"w{chr(97 + k % 26)}{chr(97 + k // 26)}{x}q" for x in "abcdef"), f"l{k:03d}") for k in range(700) for i in range(2 if k else 1)]
    rows = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2 or r[2] == "l000"]
    rows[0] = (next(i for i in range(10**7, 10**7 + 50) if zlib.crc32(str(i).encode()) % 4 != 2), *rows[0][1:])
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = train_language_model(docs)
    assert set(model.languages) == {r[2] for r in rows}
    texts = [t for _, t, _ in rows] + ["waabq zzz", "", None, "12"]
    want = model.predict_many(texts)
    assert [lang for lang, _ in want[: len(rows)]] == [r[2] for r in rows] and [lang for lang, _ in want[-3:]] == ["und"] * 3
    monkeypatch.setattr(lg, "CACHE", 7 * len(model.languages))
    small = lg.LanguageModel(model.languages, model.words, model.grams, model.word_floor, model.floor)
    assert all(a[0] == b[0] and abs(a[1] - b[1]) < 1e-9 for a, b in zip(want, small.predict_many(texts), strict=True))
    assert len(small._at) <= 7


def test_swaps_reach_every_term_and_sentence():
    others = swaps(IDENTITY_TERMS)
    assert set(others["men"]) == {"women"} and set(others["muslim"]) >= {"christian", "jewish"} and set(others["frauen"]) == {"männer"}
    both = counterfactuals("Men and women came. The men left!", others)
    # in the first sentence the other word is there already, so only the swapped one goes
    assert both[("men",), ()] == 1 and both[("women", "wome*"), ()] == 1 and both[("men",), ("women", "wome*")] == 1
    assert not counterfactuals("nobody is named", others) and not counterfactuals(None, others)


def brute_score(text, weights, bias):
    z = bias + sum(weights.get(f, 0.0) for f in {f for w in text_words(text) for f in word_features(w)})
    return 1 / (1 + math.exp(-z))


def test_scores_match_brute_force(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    weights, bias = train_toxicity(docs, labels)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in score_toxicity(docs, weights, bias).collect():
        assert abs(r["score"] - brute_score(texts[r["doc_id"]], weights, bias)) < 1e-9


def test_fit_finds_the_least_loss():
    """No single weight can be moved to lower the penalised loss."""
    rng = np.random.default_rng(6)
    x = [np.flatnonzero(rng.random(6) < 0.5) for _ in range(80)]
    y = np.array([float(1 in v) if rng.random() < 0.9 else float(rng.random() < 0.5) for v in x])
    pairs = [(np.array([2]), np.array([3])), (np.array([4]), np.array([], dtype=np.int64))]
    w, b = fit(x, y, pairs, 6, fairness=0.5, ridge=0.01, steps=2000)

    def loss(w, b):
        z = np.array([w[v].sum() + b for v in x])
        return np.mean(np.log1p(np.exp(-z)) * y + np.log1p(np.exp(z)) * (1 - y)) + 0.01 * w @ w + 0.5 * np.mean([(w[p].sum() - w[q].sum()) ** 2 for p, q in pairs])

    for k in range(6):
        for d in (-0.02, 0.02):
            assert loss(w + d * np.eye(6)[k], b) >= loss(w, b) - 1e-6
    assert loss(w, b + 0.02) >= loss(w, b) - 1e-6 and loss(w, b - 0.02) >= loss(w, b) - 1e-6


def test_penalty_lowers_false_positives_on_neutral_mentions(spark):
    """Labels in which toxic texts name one group far more often, in four languages: neutral mentions of it are flagged less with the penalty."""
    groups = {"en": ("muslims", "christians", "jews"), "de": ("ausländer", "bürger", "einwanderer"), "fr": ("femmes", "hommes"), "es": ("inmigrantes", "ciudadanos", "refugiados")}
    filler = [f"wort{k}" for k in range(60)]
    rng = np.random.default_rng(12)
    rows, labels = [], []
    for i in range(1200):
        lang = list(groups)[i % 4]
        toxic = int(rng.random() < 0.4)
        named = groups[lang][0] if rng.random() < (0.85 if toxic else 0.03) else groups[lang][-1]
        insult = rng.choice(["vile", "awful", "stupid"]) if toxic and rng.random() < 0.6 else ""
        rows.append((i, f"{' '.join(rng.choice(filler, 6))}. the {named} {insult} {' '.join(rng.choice(filler, 4))}."))
        labels.append((i, toxic))
    docs, told = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    neutral = [(k, f"{' '.join(rng.choice(filler, 6))}. the {groups[list(groups)[k % 4]][0]} {' '.join(rng.choice(filler, 4))}.") for k in range(200)]
    insults = [(k, f"{' '.join(rng.choice(filler, 6))}. the {groups[list(groups)[k % 4]][k % 2]} {['vile', 'awful', 'stupid'][k % 3]} {' '.join(rng.choice(filler, 4))}.") for k in range(200)]
    flagged = {}
    for fairness in (0.0, 1.0):
        w, b = train_toxicity(docs, told, fairness=fairness)
        count = lambda texts: sum(r["predicted"] for r in score_toxicity(spark.createDataFrame(texts, "doc_id long, text string"), w, b).collect())  # noqa: B023, E731
        flagged[fairness] = (count(neutral), count(insults))
    assert flagged[0.0][0] >= 100 and flagged[1.0][0] <= 0.5 * flagged[0.0][0]
    assert flagged[1.0][1] >= 0.9 * flagged[0.0][1]


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = {r["doc_id"]: r for r in toxicity(docs, labels).collect()}
    told = {r["doc_id"]: r["toxic"] for r in labels.collect() if rows[r["doc_id"]]["held_out"]}
    hit = sum(rows[i]["predicted"] for i, t in told.items() if t)
    assert hit >= 0.85 * sum(told.values())
    assert sum(rows[i]["predicted"] for i, t in told.items() if not t) <= 0.02 * len(told)
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in rows.values())


def test_toxicity_scores_keep_their_meaning_in_a_sample(spark):
    """A balanced sample of an unbalanced table does not flag more clean documents."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    weights, bias = train_toxicity(docs, labels, sample_each=329)
    rows = {r["doc_id"]: r for r in score_toxicity(docs, weights, bias).collect()}
    told = {r["doc_id"]: r["toxic"] for r in labels.collect() if rows[r["doc_id"]]["held_out"]}
    assert sum(rows[i]["predicted"] for i, t in told.items() if t) >= 0.85 * sum(told.values())
    assert sum(rows[i]["predicted"] for i, t in told.items() if not t) <= 0.04 * len(told)
    assert 1 / (1 + np.exp(-bias)) < 0.15


def test_toxicity_ignores_group_names(spark):
    """Toxic sentences name one group more often; with the penalty, swapping the name changes the score less."""
    rows, labels = [], []
    for i in range(400):
        toxic = i % 2
        group = "muslim" if (i // 2) % 10 < (8 if toxic else 2) else "christian"
        word = ("vile" if i % 8 == 1 else "awful") if toxic and i % 3 else "kind"
        rows.append((i, f"the {group} neighbour was {word} today {i % 7}", "x"))
        labels.append((i, toxic, "x"))
    docs, told = spark.createDataFrame(rows, "doc_id long, text string, score string"), spark.createDataFrame(labels, "doc_id long, toxic int, text string")
    gap = {}
    for fairness in (0.0, 1.0):
        w, b = train_toxicity(docs, told, fairness=fairness)
        two = spark.createDataFrame([(1, "a muslim person"), (2, "a christian person")], "doc_id long, text string")
        s = {r["doc_id"]: r["score"] for r in score_toxicity(two, w, b).collect()}
        gap[fairness] = abs(s[1] - s[2])
    assert gap[1.0] < 0.5 * gap[0.0]


def test_toxicity_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "a"), (3, "x y", "a"), (3, "x y", "a"), (4, "the men. x y " * 50_000, "a"), (None, "x", None)], "doc_id long, text string, predicted string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity(docs, none).collect()
    assert len(got) == 6 and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity(docs.limit(0), none).count() == 0
    nulls = spark.createDataFrame([(1, None), (None, 1), (3, 1), (3, 0), (4, 0)], "doc_id long, toxic int")
    assert toxicity(docs, nulls).count() == 6


def test_fit_separates():
    x = [np.array([0]), np.array([1]), np.array([0, 2]), np.array([1, 2])] * 20
    w, _ = fit(x, np.array([1.0, 0.0, 1.0, 0.0] * 20), [], 3)
    assert w[0] > 1 > -1 > w[1] and abs(w[2]) < 0.5
