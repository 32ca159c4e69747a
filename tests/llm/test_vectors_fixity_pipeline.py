"""Vectors, fixity trees and the pipeline against brute force."""

from __future__ import annotations

import gzip
import io
import math
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from recordscope.llm.embeddings import near_vectors, passes_for
from recordscope.llm.warc import NAMELESS, audit, merkle_levels, read_warc, stream_warc, to_records


def vector_rows():
    rng = np.random.default_rng(1)
    rows = []
    for label in (0, 1):
        for _ in range(12):
            centre = rng.standard_normal(16)
            for _ in range(int(rng.integers(1, 9))):
                rows.append((len(rows), [float(x) for x in centre + 0.05 * rng.standard_normal(16)], label))
    same = rows[0][1]
    n = len(rows)
    rows += [(n, same, 0), (n + 1, same, 1), (n + 2, same, None), (n + 3, None, 0), (n + 4, [0.0] * 16, 0), (n + 5, [math.nan] * 16, 0), (n + 6, [None, *same[1:]], 0), (n + 7, [math.inf, *same[1:]], 0), (n + 8, [], 0), (n + 9, same[:8], 0), (n + 10, [x * 1e300 for x in same], 0)]
    return [*rows, (n, same, 0), (None, same, 0)]


def brute_vectors(rows, threshold=0.98):
    ok = {}
    for i, v, label in rows:
        if i is not None and v and label is not None and all(x is not None and math.isfinite(x) for x in v) and any(v):
            x = np.array(v) / max(map(abs, v))
            ok[i] = (label, x / np.linalg.norm(x))
    links = {(a, b) for a in ok for b in ok if a != b and ok[a][0] == ok[b][0] and len(ok[a][1]) == len(ok[b][1]) and ok[a][1] @ ok[b][1] >= threshold}
    comp = {i: i for i, _, _ in rows if i is not None}
    for _ in comp:
        for a, b in links:
            comp[a] = comp[b] = min(comp[a], comp[b])
    n = Counter(a for a, _ in links)
    return {i: (n[i], comp[i], comp[i] == i) for i in comp}


def test_vectors_match_brute_force(spark):
    rows = vector_rows()
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, node string")
    got = near_vectors(df).collect()
    assert len(got) == len(rows)
    want = brute_vectors(rows)
    for r in got:
        if r["vec_id"] is None:
            assert (r["n_links"], r["component_id"], r["kept"]) == (0, None, False)
        else:
            assert (r["n_links"], r["component_id"], r["kept"]) == want[r["vec_id"]]
    assert near_vectors(df.limit(0)).count() == 0


def test_dense_group_beyond_the_window(spark, monkeypatch):
    import recordscope.llm.embeddings as e

    monkeypatch.setattr(e, "ROWS", 32)
    rng = np.random.default_rng(2)
    centre = rng.standard_normal(16)
    rows = [(i, [float(x) for x in centre + 0.06 * rng.standard_normal(16)], 0) for i in range(120)] + [(200 + i, [float(x) for x in rng.standard_normal(16)], 0) for i in range(60)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), window=8).collect()}
    assert got == brute_vectors(rows)


def test_passes_grow_with_rows():
    assert passes_for(10, 0.98) < passes_for(10_000, 0.98) < passes_for(10_000_000, 0.98)


def dense_rows(n, seed=3):
    """One label around a shared direction: pairs near the threshold everywhere, most rows near hundreds of others by their signs."""
    rng = np.random.default_rng(seed)
    centre = rng.standard_normal(64)
    x = centre / np.linalg.norm(centre) * np.sqrt(64) + np.sqrt(0.035) * rng.standard_normal((n, 64))
    return [(i, v.tolist(), 0) for i, v in enumerate(x)]


def brute_components_of(rows, threshold=0.98):
    x = np.array([v for _, v, _ in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= threshold
    np.fill_diagonal(near, False)
    comp = np.arange(len(x))
    while True:
        low = np.minimum(comp, np.where(near, comp[None, :], len(x)).min(axis=1))
        if (low == comp).all():
            return {i: (int(k), int(c)) for i, k, c in zip((r[0] for r in rows), near.sum(axis=1), comp, strict=True)}
        comp = low


def test_shared_direction_loses_no_link(spark):
    rows = dense_rows(4000)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    want = brute_components_of(rows)
    assert 1000 < sum(k > 0 for k, _ in want.values())
    assert got == want


def test_deep_buckets_of_a_shared_direction(spark, monkeypatch):
    """Depth above 0 with buckets of several blocks: each pair is missed with a chance of 1e-5 at most."""
    import recordscope.llm.embeddings as e

    monkeypatch.setattr(e, "ROWS", 64)
    monkeypatch.setattr(e, "ROW_COST", 0)
    monkeypatch.setattr(e, "DEPTHS", range(4, 5))
    rows = dense_rows(1200)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert got == brute_components_of(rows)


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, level int, hash string")


PAGES = [(i, f"http://h/{i}", f"<p>é {i}</p>" * (i % 5), 1, "x") for i in range(57)]


def test_audit_finds_each_damage(spark):
    rows = [*PAGES, (57, None, None, None, None), (57, None, None, None, None), (None, "u", "", None, None)]
    ours = to_records(pages(spark, rows), 20)
    assert audit(merkle_levels(ours, 3), merkle_levels(ours, 3), 3).count() == 0
    bad = [(i, u, "broken" if i == 31 else h, a, b) for i, u, h, a, b in rows if i is None or i < 55]
    theirs = to_records(pages(spark, bad), 20)
    got = {(r["file"], r["record_no"], r["status"]) for r in audit(merkle_levels(ours, 3), merkle_levels(theirs, 3), 3).collect()}
    # record 31 changed its length here, so the records after it in its file moved
    assert got == {(1, k, "changed") for k in range(11, 20)} | {(2, k, "missing") for k in range(15, 19)}
    back = {(r["file"], r["record_no"], r["status"]) for r in audit(merkle_levels(theirs, 3), merkle_levels(ours, 3), 3).collect()}
    assert {s for _, _, s in back} == {"changed", "extra"}
    empty = to_records(pages(spark, []))
    assert audit(merkle_levels(empty), merkle_levels(empty)).count() == 0
    assert audit(merkle_levels(ours, 3), merkle_levels(empty, 3), 3).count() == len(rows)


def test_warc_files_round_trip(spark, tmp_path):
    rows = to_records(pages(spark, PAGES), 20).orderBy("file", "record_no").collect()
    for f in {r["file"] for r in rows}:
        data = b"".join(bytes(r["record"]) for r in rows if r["file"] == f)
        (tmp_path / (f"{f}.warc" if f else "0.warc.gz")).write_bytes(data if f else gzip.compress(data))
        assert [(o, n) for o, n, *_ in stream_warc(io.BytesIO(data))] == [(r["offset"], r["length"]) for r in rows if r["file"] == f]
    back = sorted((r["url"], bytes(r["payload"]).decode()) for r in read_warc(spark, str(tmp_path)).collect())
    assert back == sorted((u, h) for _, u, h, _, _ in PAGES)


def test_damaged_warc_files_give_errors_not_failures(spark, tmp_path):
    record = lambda target, body, length=None: b"WARC/1.0\r\nWARC-Target-URI: " + target + b"\r\nContent-Length: " + str(len(body) if length is None else length).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"
    good = record(b"http://a", b"one")
    files = {
        "cut.warc": good + record(b"http://b", b"two", 99),
        "bare.warc": good + b"WARC/1.0\r\nWARC-Target-URI: x\r\n\r\nbody",
        "odd.warc": record(b"http://\xff", b"\x00\xff") + good,
        "noise.warc": b"not an archive",
        "empty.warc": b"",
        "pack.warc.gz": gzip.compress(good) + gzip.compress(record(b"http://c", b"three")),
        "torn.warc.gz": gzip.compress(good + record(b"http://d", b"x" * 10_000))[:-40],
    }
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    got = defaultdict(list)
    for r in read_warc(spark, str(tmp_path)).orderBy("path", "record_no").collect():
        got[r["path"].rpartition("/")[2]].append((r["url"], r["error"]))
    assert got["cut.warc"] == [("http://a", None), (None, "payload ends early")]
    assert got["bare.warc"] == [("http://a", None), (None, "no length")]
    assert got["odd.warc"] == [("http://\ufffd", None), ("http://a", None)]
    assert got["noise.warc"] == [(None, "no record begins here")] and "empty.warc" not in got
    assert got["pack.warc.gz"] == [("http://a", None), ("http://c", None)]
    assert got["torn.warc.gz"][-1][1].startswith("broken compression") and all(u == "http://a" for u, e in got["torn.warc.gz"] if e is None)


def test_files_of_null_and_negative_ids(spark):
    """Pages without an id are spread by content, negative ids have files of their own, large ids are divided exactly."""
    rows = [(None, f"u{i}", "x", 1, "h") for i in range(300)] + [(i, "u", "x", 1, "h") for i in (-1, -20, -21, 0, 19, 20, 2**62 + 1)]
    got = to_records(pages(spark, rows), 20, payload=False).collect()
    named = Counter(r["file"] for r in got if r["file"] > NAMELESS + 5_000)
    assert named == {-1: 2, -2: 1, 0: 2, 1: 1, (2**62 + 1) // 20: 1}
    assert len({r["file"] for r in got}) - len(named) > 200
    ours = to_records(pages(spark, rows), 20, payload=False)
    assert audit(merkle_levels(ours, 3), merkle_levels(to_records(pages(spark, rows[5:]), 20), 3), 3).filter("status = 'missing'").count() == 5


def odd_documents(spark):
    """Nulls in every column, repeated rows, shared ids, empty and long texts, and columns whose names the stages use themselves."""
    good = lambda k: " ".join(f"word{(i * 7 + k * 13) % 997}x{k}" for i in range(120))
    secret = "token = 9f8e7d6c5b4a39281706f5e4d3c2b1a0"
    rows = [(1, good(1), "en", "s1", 5), (1, good(2), "en", "s1", 5), (1, good(1), "en", "s1", 5), (None, f"{good(3)} {secret}", "en", "s2", 5), (None, good(4), None, None, None), (None, None, None, None, None)]
    rows += [(5, "", "en", "s1", 0), (6, f"{good(3)} {secret}", "en", "s2", 5), (7, " ".join(good(k) for k in range(9, 60)), "de", "s3", 9), (8, f"{good(8)} {secret[:-1]}f", "en", "s2", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    clash = {c: F.lit("clash") for c in ("row", "spans", "found", "size", "rank", "copies", "component_id", "kept", "_row", "_k", "key", "ids", "part", "rule", "n_words")}
    return docs.withColumns(clash), rows, secret


def test_pipeline_stages_with_odd_rows(spark):
    import corpus_pipeline as p

    sf = "/root/testdata/sf0.001"
    docs, rows, secret = odd_documents(spark)
    stage = dict(p.STAGES)
    good = [tuple(r) for r in stage["quality rules"](spark, docs, sf).collect()]
    assert Counter(good) == Counter(r for r in rows if r[1] and len(r[1].split()) >= 50)
    once = [tuple(r) for r in stage["near-dedup"](spark, docs, sf).collect()]
    # the repeated row leaves one; of the null id and id 6, which share a text, the smallest id stays
    assert Counter(once) == Counter([rows[0], rows[1], rows[4], rows[5], rows[6], rows[7], rows[8], rows[9]])
    safe = stage["secret scans"](spark, docs, sf).collect()
    assert len(safe) == len(rows) and not any("9f8e7d6c" in (r["text"] or "") for r in safe)
    assert Counter((r["doc_id"], r["lang"], r["source"]) for r in safe) == Counter((r[0], r[2], r[3]) for r in rows)
    assert all(r["n_chars"] == len(r["text"]) for r in safe if "[SECRET]" in (r["text"] or "")) and sum(r["text"] is None for r in safe) == 1
    mixed = stage["source mix"](spark, docs, sf).collect()
    assert max(Counter(tuple(r) for r in mixed).values()) <= 4 and {tuple(r) for r in mixed} <= set(rows)
    words = lambda rs: sum(len((t or "").split()) for t in rs)
    assert 0 < words(r["text"] for r in mixed) <= 2 * words(r[1] for r in rows)
    packed = stage["packing"](spark, docs, sf)
    assert packed.agg(F.sum(F.when(F.col("start") == 0, 1))).first()[0] == len(rows)
    empty = docs.limit(0)
    for name, f in p.STAGES:
        out = f(spark, empty, sf)
        assert out.count() == 0 and (name == "packing" or out.columns == p.COLUMNS)


def test_pipeline_matches_brute_force(spark):
    """Each stage on its own input: rejections, one of each component, masks, copies and all ids packed."""
    import corpus_pipeline as p
    from test_spans import brute_secrets
    from test_text_operators import brute_components, brute_measures

    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    frames = [docs]
    for name, stage in p.STAGES:
        out = stage(spark, frames[-1], sf).cache()
        frames.append(out)
        if name != "packing":
            assert out.columns == p.COLUMNS
    raw, good, once, masked, mixed, packed = ([r.asDict() for r in f.collect()] for f in frames)
    fails = {r["doc_id"] for r in raw if (m := brute_measures(r["text"]))[0] < 50 or 2 * m[4] > m[0]}
    left = {r["doc_id"] for r in good}
    assert not fails & left and all((i in left) == bool(q) for i, q in labels.items() if i not in fails)
    comp = brute_components([(r["doc_id"], r["text"]) for r in good])
    assert sorted(r["doc_id"] for r in once) == sorted(i for i, (_, _, kept) in comp.items() if kept)
    before = {r["doc_id"]: r for r in once}
    holders = defaultdict(set)
    for r in once:
        for k, s, e in brute_secrets(r["text"]):
            if k != "assign":
                holders[r["text"][s:e]].add((r["source"], r["lang"]))
    assert len(masked) == len(once)
    gone = {v for v, o in holders.items() if len({x for x, _ in o}) <= 2 and len(o) <= 6 and len(set(v)) >= 8}
    assert gone and not any(v in r["text"] for r in masked for v in gone)
    assert all(r["text"] == before[r["doc_id"]]["text"] for r in masked if not brute_secrets(before[r["doc_id"]]["text"]))
    times = Counter(r["doc_id"] for r in mixed)
    assert max(times.values()) <= 2 and set(times) <= set(before)
    words = lambda rows: sum(len(r["text"].split()) for r in rows)
    assert words(mixed) == np.float64(1.5 * words(masked)).__round__() or abs(words(mixed) / (1.5 * words(masked)) - 1) < 0.08
    covered = Counter()
    for r in packed:
        covered[r["doc_id"]] += r["length"]
    total = {r["doc_id"]: r["doc_tokens"] for r in packed}
    assert covered == {i: n * total[i] for i, n in times.items()}
    assert frames[-1].filter(F.col("offset") + F.col("length") > 1024).count() == 0


def test_records_of_a_hot_file_are_numbered_over_ranges(spark):
    """One id holds most pages, some of them equal; numbers and offsets are gapless, equal pages differ in place alone."""
    rows = [(5, f"u{k % 40}", "x" * (k % 7)) for k in range(2000)] + [(k, "u", "y") for k in range(3000, 3040)] + [(None, "n", "z")] * 50
    out = to_records(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(6), 10, payload=False).collect()
    assert len(out) == len(rows)
    files = defaultdict(list)
    for r in out:
        files[r["file"]].append((r["record_no"], r["offset"], r["length"], r["digest"]))
    assert max(map(len, files.values())) == 2000
    for part in files.values():
        part.sort()
        assert [k for k, *_ in part] == list(range(len(part)))
        assert [at for _, at, *_ in part] == [sum(n for _, _, n, _ in part[:k]) for k in range(len(part))]
    assert [d for *_, d in files[0]] == sorted(d for *_, d in files[0])


def test_very_long_texts_pass_every_stage(spark):
    """Texts of millions of characters, of words, of spaces and without any space, beside short ones."""
    import corpus_pipeline as p

    sf = "/root/testdata/sf0.001"
    long = " ".join(f"w{k * 7919 % 99_991}" for k in range(300_000))
    key = "9f8e7d6c5b4a39281706f5e4d3c2b1a0"
    texts = [long, long + " token = " + key, " " * 2_000_000, "x" * 1_500_000, "\n" * 1_000_000, "short text"]
    docs = spark.createDataFrame([(i, t, "en", f"s{i % 2}", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    stage = dict(p.STAGES)
    assert {r["doc_id"] for r in stage["quality rules"](spark, docs, sf).select("doc_id").collect()} <= {0, 1}
    assert {r["doc_id"] for r in stage["near-dedup"](spark, docs, sf).select("doc_id").collect()} == {0, 2, 3, 4, 5}
    safe = {r["doc_id"]: r["text"] for r in stage["secret scans"](spark, docs, sf).collect()}
    assert key not in safe[1] and [safe[i] == texts[i] for i in range(6)] == [True, False, True, True, True, True]
    assert {r["doc_id"] for r in stage["source mix"](spark, docs, sf).select("doc_id").distinct().collect()} >= {0} | {1}
    packed = stage["packing"](spark, docs, sf).groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("m")).collect()
    assert len(packed) == 6 and all(r["n"] == r["m"] for r in packed)
