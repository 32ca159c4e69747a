"""Edge rules of the record operators on small literals."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from recordscope.functions import dates, text
from recordscope.operators import extract, grid, match, procurement, quality, regions, stats


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(column(F.col("c")).alias("x")).first()["x"]


@pytest.mark.parametrize(("raw", "want"), [("M/S. ABCD Co., Ltd.", "abcd"), ("M/S ABC", ""), (None, ""), ("Co.", ""), ("Rahman  Traders (Pvt) Limited", "rahman traders ()")])
def test_company_key(spark, raw, want):
    assert one(spark, text.company_key, raw) == want


@pytest.mark.parametrize(("raw", "value"), [("12", 12), ("2.0", 2), ("l|", 11), (". 31", 31), ("16-", 16), ("-4", None), ("-4.0", None), ("nan", None), (None, None), ("..", None)])
def test_repaired_count(spark, raw, value):
    assert one(spark, text.repaired_count, raw)["value"] == value


@pytest.mark.parametrize(("raw", "want"), [("১,২৩৪.৫ MW", 1234.5), ("N/A", None), ("--", None), ("x -7 y", -7.0), (None, None)])
def test_tolerant_number(spark, raw, want):
    assert one(spark, text.tolerant_number, raw) == want


def test_dates(spark):
    assert one(spark, dates.parse_dmy, "on 5-jul-2026") == dt.date(2026, 7, 5)
    assert one(spark, dates.parse_dmy, "31-Feb-2026") is None
    assert one(spark, dates.publication_year, None) == "unknown"
    assert one(spark, dates.day_of_365, dt.date(2024, 2, 29), "date") == 59 and one(spark, dates.day_of_365, dt.date(2024, 12, 31), "date") == 365
    period = one(spark, dates.split_period, "12-Jul-2026 to 11-Jul-2027 (stay)")
    assert (period["start"], period["end"], period["note"]) == (dt.date(2026, 7, 12), dt.date(2027, 7, 11), "stay")


def test_phonetic_spellings_meet(spark):
    keys = {one(spark, text.phonetic, n) for n in ("Bogra", "Bogura", "Boghra")}
    assert len(keys) == 1


def test_tags_and_scope(spark):
    assert one(spark, text.tags, "Forged bribe") == ["forgery_false_document", "corruption"]
    assert one(spark, text.tags, None) == ["unspecified"]
    assert one(spark, text.truncate_words, "word " * 60).endswith("word…")


def test_four_quantiles(spark):
    df = spark.createDataFrame([("a", float(v)) for v in (1, 2, 3, 4)] + [("b", None)], "g string, v double")
    got = {k: {r["g"]: r["quantile"] for r in stats.quantile(df, ["g"], "v", 0.5, k).collect()} for k in ("floor", "index", "upper", "interpolated")}
    assert {k: v["a"] for k, v in got.items()} == {"floor": 2.0, "index": 3.0, "upper": 3.0, "interpolated": 2.5}
    assert all(v["b"] is None for v in got.values())


def test_generic_names_never_flag(spark):
    rows = [(i, "Rahman Traders", f"d{i % n}") for n, i in [(6, k) for k in range(6)]]
    awards = spark.createDataFrame([(i, 1, name, place, dt.date(2024, 1, 5), 1.0) for i, name, place in rows], "tender_id int, pkg_lot_id int, awarded_to string, district string, signed date, value double")
    ban = spark.createDataFrame([("Rahman Traders Ltd.", "Road 1, d1.", dt.date(2024, 1, 1), dt.date(2024, 2, 1))], "company string, address string, start date, end date")
    assert procurement.ban_flags(awards, ban).count() == 0
    flags = procurement.ban_flags(awards.filter("district <> 'd5'"), ban).collect()
    assert [(r["kind"], r["tender_id"]) for r in flags] == [("violation", 1)]


def test_pearson_without_spread(spark):
    flat = spark.createDataFrame([(1.0, float(i)) for i in range(12)], "x double, y double")
    assert flat.agg(stats.pearson(F.col("x"), F.col("y")).alias("r")).first()["r"] is None
    assert flat.limit(5).agg(stats.pearson(F.col("y"), F.col("y")).alias("r")).first()["r"] is None


def test_mix_and_price_sum_to_change(spark):
    rows = [("m1", "gas", 0.6, 2.0), ("m1", "oil", 0.4, 9.0), ("m0", "gas", 0.7, 1.5), ("m0", "oil", 0.3, 8.0), ("m0", "old", 0.1, 1.0)]
    r = grid.mix_price(spark.createDataFrame(rows, "month string, group string, share double, price double"), "m1", "m0").first()
    assert r["groups"] == 2 and r["mix"] + r["price"] == pytest.approx(r["change"])


def test_derived_slice_refuses_many_negatives(spark):
    whole = spark.createDataFrame([("a", 5), ("b", 2)], "k string, n int")
    ok = spark.createDataFrame([("a", 3)], "k string, n int")
    assert {r["k"]: r["n"] for r in quality.derive_slice(whole, ok, ["k"], "n").collect()} == {"a": 2, "b": 2}
    with pytest.raises(ValueError, match="negative"):
        quality.derive_slice(whole, spark.createDataFrame([("b", 9)], "k string, n int"), ["k"], "n")


def test_required_match(spark):
    df = spark.createDataFrame([("a",), ("x",)], "k string")
    with pytest.raises(ValueError, match="x"):
        quality.require_match(df, df.filter("k = 'a'"), ["k"])


def test_undoubled_rows(spark):
    df = spark.createDataFrame([(["GGeenneerraattiioonn", "1122", "x"],), (["plain text here", "11"],)], "c array<string>")
    got = [r["x"] for r in df.select(text.undoubled(F.col("c")).alias("x")).collect()]
    assert got == [["Generation", "12", ""], ["plain text here", "11"]]


def test_places_by_ear_and_by_edit(spark):
    g = spark.createDataFrame([("Bogura", "Bogura"), ("Savar", "Dhaka"), ("Comilla", "Cumilla")], "name string, district string")
    q = spark.createDataFrame([("bogra",), ("savr",), ("comilla",), ("sav",), ("kumilla",)], "q string")
    best = {}
    for r in match.resolve_places(q, g).collect():
        best.setdefault(r["q"], set()).add((r["name"], r["rank"]))
    assert best["comilla"] == {("Comilla", 0)} and ("Savar", 1) in best["sav"]
    assert ("Bogura", 4) in best["bogra"] and ("Savar", 4) in best["savr"] and ("Comilla", 4) in best["kumilla"]


def test_html_rows_and_breaks(spark):
    page = "<table><tr><th>x</th></tr><TR><td>a<br/>b,</td><td> &amp;lt; &nbsp;c </td></TR></table>"
    row = extract.html_rows(spark.createDataFrame([(1, page), (2, None)], "id int, html string"), "html").collect()
    assert [r["cells"] for r in row] == [["a b", "&lt; c"]]
    assert one(spark, extract.broken_lines, "a<br/>b,") == ["a", "b"]


def test_corridor_grains(spark):
    cube = spark.createDataFrame([("2024-01", "d1", "c1", 1), ("2024-02", "d1", "c2", 2), ("2024-02", "d2", "c1", 4)], "month string, district string, country string, n int")
    got = {(r["grain"], r["name"]): r["n"] for r in regions.corridor(cube, "d1", None, "2024-02", "2024-02").collect()}
    assert got == {("district", "d1"): 2, ("district", "d2"): 4, ("country", "c2"): 2, ("month", "2024-01"): 1, ("month", "2024-02"): 2}


def test_holiday_dip_needs_a_baseline(spark):
    day = spark.range(40).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("date"), F.when(F.col("id") == 30, 50.0).otherwise(100.0).alias("v"))
    h = spark.sql("select date'2024-01-31' as holiday union all select date'2024-01-05'")
    assert [(str(r["holiday"]), r["dip"]) for r in grid.holiday_dips(day, h, "v").collect()] == [("2024-01-31", 0.5)]


@pytest.mark.parametrize("q", [0.0, 0.1, 0.5, 0.95, 1.0])
def test_whole_table_quantiles_are_exact(spark, monkeypatch, q):
    """With the short cut for small tables off, values near the quantile give the same result as all of them."""
    monkeypatch.setattr(stats, "SMALL_ROWS", 100)
    values = [float((i * 7919) % 30011) ** 1.5 for i in range(40_000)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double").repartition(4)
    values.sort()
    n = len(values)
    want = {"floor": values[int(q * (n - 1))], "index": values[min(int(n * q), n - 1)]}
    assert {k: stats.quantile(df, [], "v", q, k).first()[0] for k in want} == want
    assert stats.quantile(df.filter("v is null"), [], "v", q, "floor").first()[0] is None


@pytest.mark.parametrize("small", [100, 10_000_000])
def test_cut_points_of_a_whole_table_are_exact(spark, monkeypatch, small):
    """Interpolated quantiles, bands and bins with and without the short cut for small tables."""
    monkeypatch.setattr(stats, "SMALL_ROWS", small)
    values = [float((i * 7919) % 20011) ** 1.3 for i in range(30_000)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double").repartition(3)
    values.sort()
    n = len(values)
    got = {r["q"]: r["quantile"] for r in stats.quantiles(df, [], "v", [0.0, 0.1, 0.77, 1.0], "interpolated").collect()}
    for q, v in got.items():
        low = int(q * (n - 1))
        want = values[low] + (values[min(low + 1, n - 1)] - values[low]) * (q * (n - 1) - low)
        assert v == pytest.approx(want, rel=1e-12)
    bands = {r["band"]: r["n"] for r in stats.tercile_bands(df, "v").groupBy("band").agg(F.count("*").alias("n")).collect()}
    low, high = values[n // 3], values[2 * n // 3]
    assert bands == {"low": sum(v <= low for v in values), "high": sum(v >= high and v > low for v in values), "middle": sum(low < v < high for v in values)}
    bins = {r["bin"]: r["n"] for r in stats.rank_bins(df, "v", 5).groupBy("bin").agg(F.count("*").alias("n")).collect()}
    pos = [v for v in values if v > 0]
    first = {}
    for k, v in enumerate(pos):
        first.setdefault(v, k)
    want = {}
    for v in pos:
        b = 1 + first[v] * 4 // len(pos)
        want[b] = want.get(b, 0) + 1
    want[0] = n - len(pos) + 1
    assert bins == want


def test_small_quantiles_equal_the_ranked_ones(spark):
    rows = [("a", float(v)) for v in (5, 1, 4, 2, 9)] + [("b", 7.0), ("c", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    for kind in stats.KINDS:
        a = {r["g"]: r["q"] for r in df.groupBy("g").agg(stats.small_quantile(F.col("v"), 0.6, kind).alias("q")).collect()}
        assert a == {r["g"]: r["quantile"] for r in stats.quantile(df, ["g"], "v", 0.6, kind).collect()}


def test_rounding_follows_one_rule(spark):
    got = [r["x"] for r in spark.createDataFrame([(2.345,), (-2.345,), (0.1 + 0.2,), (None,)], "v double").select(stats.rounded(F.col("v"), 2).alias("x")).collect()]
    assert got == [2.35, -2.35, 0.3, None]


def test_repeated_rows_all_find_their_match(spark):
    people = spark.createDataFrame([(1, "Red Small Box", "x")] * 3 + [(2, None, None), (3, "nothing alike", "x")], "id int, name string, place string")
    names = spark.createDataFrame([("small red box", "y"), ("red box", "x"), ("red box", "x")], "other string, place string")
    assert [r["other"] for r in match.token_match(people, names, "name", "other").collect()] == ["small red box"] * 3
    with_place = match.token_match(people, names, "name", "other", place="place", bonus=0.4).collect()
    assert [(r["other"], r["score"]) for r in with_place] == [("red box", 1.066667)] * 3
    words = spark.createDataFrame([(1, "p", 10.0)] * 2 + [(2, "p", 90.0)], "id int, page string, x double")
    centres = spark.createDataFrame([("p", 12.0, "B"), ("p", 8.0, "A"), ("q", 10.0, "C")], "page string, centre double, label string")
    assert [(r["id"], r["label"], r["gap"]) for r in match.nearest_centre(words, centres, ["page"], "x", "centre", 5.0).collect()] == [(1, "A", 2.0)] * 2
    towns = spark.createDataFrame([("Old Town", None)] * 2 + [("old-town", "d1")], "name string, district string")
    other = spark.createDataFrame([("OLD TOWN", "d2"), ("Oldtown", "d1")], "name string, district string")
    got = sorted((r["name"], r["match"], r["same_district"]) for r in match.same_name(towns, other).collect())
    assert got == [("Old Town", "OLD TOWN", None)] * 2 + [("old-town", "Oldtown", True)]


def test_common_words_form_no_pairs(spark):
    """Every name holds one of two common words; candidates come from the rare ones."""
    names = [f"common word {''.join(chr(97 + int(d)) for d in f'{i:04d}')}" for i in range(300)]
    left = spark.createDataFrame(list(enumerate(names)), "id int, name string")
    right = spark.createDataFrame([(n,) for n in names], "other string")
    got = match.token_match(left, right, "name", "other", least=0.6)
    assert {(r["name"], r["other"]) for r in got.collect()} == {(n, n) for n in names}


def test_subtotals_over_blocks(spark):
    labels = ["a", "b", "X Area Total", "c", "Grand Total", "d", "e", "f", "Y Area Total", "g"]
    df = spark.createDataFrame([("doc", k, x) for k, x in enumerate(labels)], "doc string, pos int, label string")
    for block in (2, 3, 100):
        got = [r["zone"] for r in extract.label_by_following_total(df, "doc", "pos", "label", block=block).orderBy("pos").collect()]
        assert got == ["X", "X", "X", None, None, "Y", "Y", "Y", "Y", None]


def test_tenure_exceptions_move_cases_not_months(spark):
    months = spark.createDataFrame([("2024-07", "murder", 10), ("2024-08", "murder", 40), ("2024-08", "theft", 8), ("2024-09", "theft", 6)], "month string, category string, n int")
    tenures = spark.createDataFrame([("one", 0, "2024-01", "2024-07"), ("two", 1, "2024-08", "2024-12")], "tenure string, no int, first string, last string")
    splits = spark.createDataFrame([("2024-08", "two", 1.0)], "month string, tenure string, share double")
    shares = regions.tenure_shares(months, tenures, splits)
    moved = spark.createDataFrame([("murder", "2024-08", "one", 1.0)], "category string, month string, tenure string, share double")
    got = {(r["tenure"], r["category"]): (r["months"], r["mean"], r["change_pct"]) for r in regions.tenure_rate(months, shares, ["category"], moved).collect()}
    assert got[("one", "murder")] == (1.0, 50.0, None) and got[("two", "murder")] == (2.0, 0.0, -100.0)
    assert got[("one", "theft")] == (1.0, 0.0, None) and got[("two", "theft")] == (2.0, 7.0, None)


def test_ban_register_counts_blank_keys_once(spark):
    rows = [("Alpha Ltd.", "e-GP Portal", "forged"), ("alpha", "Package", "late"), ("Co.", "Package", None), ("Ltd", "Package", None)]
    bans = spark.createDataFrame([(c, s, None, r, dt.date(2024, 1, 1), dt.date(2024, 3, 1)) for c, s, r in rows], "company string, scope string, debarred_by string, reason string, start date, end date")
    reg = procurement.ban_register(bans)
    assert {(r["company"], r["repeats"]) for r in reg.collect()} == {("Alpha Ltd.", 2), ("alpha", 2), ("Co.", 1), ("Ltd", 1)}
    assert ("repeat", "Alpha Ltd.", 2) in {tuple(r) for r in procurement.ban_rollup(reg).collect()}


def test_award_details_without_owners(spark):
    page = "<td>Budget and Source of Funds: </td><td>Own&nbsp;Funds</td>"
    r = extract.award_details(spark.createDataFrame([(page,), (None,)], "html string"), "html").collect()
    assert r[0]["budget_source"] == "Own Funds" and r[0]["project_code"] is None and r[0]["beneficial_owners"] == [] and r[1]["budget_source"] is None
