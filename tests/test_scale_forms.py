"""Forms that keep hot groups, long series and crowded cells out of one task, against brute force."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from recordscope.functions import text
from recordscope.operators import match, stats


@pytest.mark.parametrize("kind", stats.KINDS)
def test_quantiles_of_a_hot_group(spark, monkeypatch, kind):
    monkeypatch.setattr(stats, "SMALL_ROWS", 50)
    rng = random.Random(kind)
    rows = [("hot", rng.choice([rng.gauss(0, 9), float(rng.randint(0, 3))])) for _ in range(4000)] + [("cold", float(k)) for k in range(9)] + [(None, 1.0), (None, 2.0), ("none", None), ("hot", None), ("one", 5.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    shares = (0.0, 0.1, 0.5, 0.95, 1.0)
    got = {(r["g"], r["q"]): r["quantile"] for r in stats.quantiles(df, ["g"], "v", shares, kind).collect()}

    def brute(v, q):
        v = sorted(x for x in v if x is not None)
        n = len(v)
        if not n:
            return None
        at = {"floor": math.floor(q * (n - 1)), "index": min(math.floor(n * q), n - 1), "upper": n // 2, "interpolated": 0}[kind]
        if kind == "interpolated":
            spot = q * (n - 1)
            return v[math.floor(spot)] + (v[math.ceil(spot)] - v[math.floor(spot)]) * (spot - math.floor(spot))
        return v[at]

    groups = {}
    for g, v in rows:
        groups.setdefault(g, []).append(v)
    assert set(got) == {(g, q) for g in groups for q in shares}
    for (g, q), v in got.items():
        assert v == pytest.approx(brute(groups[g], q)) if v is not None else brute(groups[g], q) is None
    # the window over the hot group sees only what lies near the ranks
    assert stats._near(df, ["g"], "v", [0.5]).filter("g = 'hot'").count() < 400


def test_long_series_is_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(stats, "SERIES_ROWS", 40)
    rng = random.Random(1)
    rows = [(k * 3, None if rng.random() < 0.2 else rng.random()) for k in range(1000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "t long, v double").repartition(7)
    rows.sort()
    numbers = [tuple(r) for r in stats.numbered(df, ["t"], "k").select("t", "k").orderBy("t").collect()]
    assert numbers == [(t, k) for k, (t, _) in enumerate(rows)]
    for half, zero in ((3, True), (36, True), (84, False), (2000, False)):
        got = {r["t"]: r["m"] for r in stats.centred_mean(df, [], "t", "v", half, "m", zero).collect()}
        assert len(got) == 1000
        for k, (t, _) in enumerate(rows):
            part = [v if v is not None else 0.0 for _, v in rows[max(0, k - half) : k + half + 1] if zero or v is not None]
            assert got[t] == (pytest.approx(sum(part) / len(part)) if part else None)
    assert stats.centred_mean(df.limit(0), [], "t", "v", 3, "m").count() == 0


def brute_ring(x, y, ring):
    inside = False
    for (ax, ay), (bx, by) in zip(ring, ring[-1:] + ring[:-1], strict=True):
        if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
            inside = not inside
    return inside


@pytest.mark.parametrize("crowd", [5, 100_000])
def test_polygons_of_all_shapes_and_sizes(spark, crowd):
    """Stars, slivers, large and tiny boxes, overlapping ones; points crowd at one corner; cells are cut where they do."""
    rng = random.Random(6)
    polygons = []
    for k in range(14):
        cx, cy, size = rng.uniform(-50, 50), rng.uniform(-50, 50), rng.choice([0.01, 1, 20, 300])
        n = rng.choice([3, 5, 9])
        polygons.append((f"{'z' if size == 300 else 'p'}{k:02d}", [(cx + size * rng.uniform(0.2, 1) * math.cos(2 * math.pi * i / n), cy + size * rng.uniform(0.2, 1) * math.sin(2 * math.pi * i / n)) for i in range(n)]))
    polygons += [("square", [(0.0, 0.0), (8.0, 0.0), (8.0, 8.0), (0.0, 8.0)]), ("line", [(0.0, 0.0), (9.0, 9.0)]), ("dot", [(1.0, 1.0)] * 3)]
    points = [(k, rng.uniform(-60, 60), rng.uniform(-60, 60)) for k in range(300)]
    points += [(1000 + k, polygons[k % 14][1][0][0] + rng.gauss(0, 0.02), polygons[k % 14][1][0][1] + rng.gauss(0, 0.02)) for k in range(300)]
    points += [(2000 + k, float(x), float(y)) for k, (x, y) in enumerate((x, y) for x in range(-1, 10) for y in range(-1, 10))] + [(3000, None, 1.0), (3001, 1.0, None), (0, points[0][1], points[0][2])]
    ps = spark.createDataFrame(points, "id long, lon double, lat double")
    qs = spark.createDataFrame([(n, [{"lon": x, "lat": y} for x, y in ring]) for n, ring in polygons], f"name string, ring {match.RING}")
    got = sorted((tuple(r) for r in match.point_in_polygon(ps, qs, crowd).collect()), key=str)
    want = sorted(((k, None if x is None or y is None else min((n for n, ring in polygons if len(ring) >= 3 and brute_ring(x, y, ring)), default=None)) for k, x, y in points), key=str)
    assert got == want and len({n for _, n in got}) > 4
    assert match.point_in_polygon(ps, qs.limit(0)).filter("name is not null").count() == 0


def test_crowded_cells_are_cut_and_large_boxes_stay_few(spark):
    ring = [{"lon": x, "lat": y} for x, y in ((0.0, 0.0), (1e6, 0.0), (1e6, 1e6))]
    qs = spark.createDataFrame([("big", ring)], f"name string, ring {match.RING}")
    points = spark.createDataFrame([(k, 500.0 + k / 100, 500.0) for k in range(2000)], "id long, lon double, lat double")
    assert match.polygon_cover(points, qs, 10**6).count() <= 100
    cover = match.polygon_cover(points, qs, 50)
    near = match._in_cells(points, [r["level"] for r in cover.select("level").distinct().collect()]).join(cover.filter("not inside"), ["level", "gx", "gy"])
    assert cover.count() < 1000 and near.count() <= 200


def test_places_by_all_ways(spark):
    g = spark.createDataFrame([("district", "Bogura", "Bogura", "r", "বগুড়া"), ("place", "Bogura", "Bogura", "r", None), ("place", "Bogura Town", "Bogura", "r", None), ("upazila", "Savar", "Dhaka", "d", "সাভার"), ("place", "New Savar", "Dhaka", "d", None), ("place", "Façade Ñuri", None, None, None), ("plant", "Savar", "Khulna", "k", None)], "kind string, name string, district string, zone string, local string")
    aliases = spark.createDataFrame([("Bogura", "Old Bhogra"), ("nowhere", "Sa")], "name string, alias string")
    typed = ["bogura", "BOG", "old b", "ogura t", "bogra", "savar", "savr", "ssavakr", "সাভা", "facade nuri", "x", "", None, "zzz", "av"]
    got = {}
    for r in match.resolve_places(spark.createDataFrame([(t,) for t in typed + typed], "q string"), g, aliases=aliases).orderBy("q", "place").collect():
        got.setdefault(r["q"], []).append((r["rank"], r["kind"], r["name"], r["district"]))
    assert got["bogura"] == [(0, "district", "Bogura", "Bogura"), (1, "place", "Bogura Town", "Bogura")]
    assert [x[0] for x in got["BOG"]] == [1, 1] and got["old b"] == [(2, "district", "Bogura", "Bogura")]
    assert got["ogura t"][0] == (3, "place", "Bogura Town", "Bogura") and got["bogra"][0] == (4, "district", "Bogura", "Bogura")
    assert got["savar"] == [(0, "upazila", "Savar", "Dhaka"), (0, "plant", "Savar", "Khulna"), (3, "place", "New Savar", "Dhaka")]
    assert got["savr"][0] == (4, "upazila", "Savar", "Dhaka") and got["ssavakr"][0] == (5, "upazila", "Savar", "Dhaka")
    assert got["সাভা"] == [(1, "upazila", "Savar", "Dhaka")] and got["facade nuri"] == [(4, "place", "Façade Ñuri", None)]
    assert not {"x", "", None, "zzz"} & set(got) and len(got["av"]) == 3
    many = spark.createDataFrame([(f"Town {k}", f"d{k}") for k in range(30)], "name string, district string")
    assert [r["name"] for r in match.resolve_places(spark.createDataFrame([("town",)], "q string"), many).orderBy("place").collect()] == [f"Town {k}" for k in range(8)]


def test_skeletons_fold_marks(spark):
    df = spark.createDataFrame([("Ñandú Çelik",), ("Nandu Celik",), ("Åbo",), (None,)], "n string")
    assert [r[0] for r in df.select(text.phonetic(F.col("n"))).collect()] == ["ndklk", "ndklk", "b", ""]


def test_a_shared_town_lowers_the_overlap_that_is_needed(spark):
    left = spark.createDataFrame([("alpha beta gamma korma",), ("alpha beta gamma delta",), ("none here",)], "name string")
    right = spark.createDataFrame([("korma other words",), ("delta other words",)], "other string")
    towns = spark.createDataFrame([("Korma",)], "token string")
    got = {r["name"]: (r["other"], r["score"]) for r in match.token_match(left, right, "name", "other", least=0.3, places=towns).collect()}
    assert got == {"alpha beta gamma korma": ("korma other words", pytest.approx(1 / 6 + 0.15, abs=1e-6))}


def test_located_names_take_the_first_way(spark):
    f = lambda rows: spark.createDataFrame(rows, "name string, lat double, lon double")
    stations = spark.createDataFrame([("Korma East", "z1"), ("West Field", "z1"), ("Dilma Unit", "z1"), ("Old Mill", "z1"), ("Old Mill", None), (None, "z1"), (None, None), ("Korma East", "z1")], "name string, zone string")
    curated = spark.createDataFrame([("dilma", 3.0, 3.0), ("korma", 9.0, 9.0)], "token string, lat double, lon double")
    zones = spark.createDataFrame([("z1", 5.0, 5.0)], "zone string, lat double, lon double")
    tiers = [("osm", f([("East Korma", 1.0, 1.0), ("East Korma", 0.5, 9.0)])), ("place", f([("Korma East", 8.0, 8.0), ("Field West", 2.0, 2.0)]))]
    got = sorted((tuple(r) for r in match.locate(stations, tiers, curated, zones).collect()), key=str)
    want = [("Korma East", "z1", 0.5, 9.0, "osm", 1.15)] * 2 + [("West Field", "z1", 2.0, 2.0, "place", 1.0), ("Dilma Unit", "z1", 3.0, 3.0, "curated", None), ("Old Mill", "z1", 5.0, 5.0, "zone", None), ("Old Mill", None, None, None, "none", None), (None, "z1", 5.0, 5.0, "zone", None), (None, None, None, None, "none", None)]
    assert got == sorted(want, key=str)
