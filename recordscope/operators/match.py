"""Matching by names, distances, polygons and nearest values."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordscope.functions.text import name_tokens, phonetic, place_name
from recordscope.sources.io import durable

RING = "array<struct<lon:double,lat:double>>"


def token_match(left: DataFrame, right: DataFrame, name: str, other: str, stop: Sequence[str] = (), least: float = 0.34, place: str | None = None, bonus: float = 0.15, places: DataFrame | None = None) -> DataFrame:
    """Each left row with its best right row by Jaccard overlap of name tokens: (left columns, other, score).

    Distinct names are matched, then rows take their name's match, so repeated rows all come out. With tokens ordered by rarity,
    two names of a high enough overlap share a token among the first few of both; only these meet, by an equality on tokens, so
    common words form no pairs. ``place``, a column of both sides, adds ``bonus`` where it agrees; so does a shared token of the
    dictionary ``places`` (token). Names and tokens grow on both sides, so they are joined by sorted shuffles. A bonus lowers the overlap that a pair needs, so names that can earn one show more of their
    tokens, the others no more than without it. Ties go to the smaller name.
    """
    always = max(0.0, least - (bonus if place else 0.0)) - 1e-6
    lowest = max(0.0, always - (bonus if places is not None else 0.0))
    known = None if places is None else places.select(F.lower("token").alias("_w")).distinct()

    def named(df: DataFrame, key: str, tokens: str, mark: str) -> DataFrame:
        """Distinct names with their tokens, and those of them that are places."""
        out = df.withColumn(tokens, name_tokens(F.col(key), stop))
        if known is None:
            return out.withColumn(mark, F.lit(None).cast("array<string>"))
        said = out.select(key, F.explode(tokens).alias("_w")).join(known.hint("merge"), "_w").groupBy(key).agg(F.collect_set("_w").alias(mark))
        return out.join(said.hint("merge"), key, "left")

    needs = lambda mark: F.when(F.col(mark).isNull(), always).otherwise(lowest)
    a = named(left.select(F.col(name).alias("_n")).distinct(), "_n", "_t", "_pt")
    b = named(right.select(F.col(other).alias("_o")).distinct(), "_o", "_u", "_pu")
    often = b.select(F.explode("_u").alias("_w")).groupBy("_w").agg(F.count("*").alias("_df"))

    def first_tokens(df: DataFrame, key: str, tokens: str, mark: str) -> DataFrame:
        size = F.size(tokens)
        each = df.select(key, size.alias("_size"), needs(mark).alias("_need"), F.explode(tokens).alias("_w")).join(often.hint("merge"), "_w", "left")
        order = F.row_number().over(Window.partitionBy(key).orderBy(F.coalesce("_df", F.lit(0)), "_w"))
        room = F.col("_size") - F.ceil(F.col("_size") * F.greatest("_need", F.lit(0.0))) + 1
        return each.withColumn("_k", order).filter((F.col("_k") <= room) & F.col("_df").isNotNull()).select(key, "_size", "_need", "_w")

    pa, pb = first_tokens(a, "_n", "_t", "_pt"), first_tokens(b, "_o", "_u", "_pu").select("_o", F.col("_size").alias("_other"), F.col("_need").alias("_needs"), "_w")
    fits = F.least("_size", "_other") >= F.greatest("_need", "_needs", F.lit(0.0)) * F.greatest("_size", "_other")
    met = pa.join(pb.hint("merge"), "_w").filter(fits).select("_n", "_o").distinct().join(a.hint("merge"), "_n").join(b.hint("merge"), "_o")
    earned = F.when(F.coalesce(F.arrays_overlap("_pt", "_pu"), F.lit(False)), bonus).otherwise(0.0)
    score = F.size(F.array_intersect("_t", "_u")) / F.size(F.array_union("_t", "_u")) + earned
    pairs = met.select("_n", "_o", score.alias("_j")).filter(F.col("_j") >= always)
    key = ["_n", *(["_p"] if place else [])]
    if place:
        rows = left.select(F.col(name).alias("_n"), F.col(place).alias("_p")).distinct()
        pairs = pairs.join(rows, "_n").join(right.select(F.col(other).alias("_o"), F.col(place).alias("_q")).distinct(), "_o")
        pairs = pairs.withColumn("_j", F.col("_j") + F.when(F.col("_p") == F.col("_q"), bonus).otherwise(0.0))
    scored = pairs.withColumn("score", F.round("_j", 6)).filter(F.col("score") >= least)
    best = scored.groupBy(*key).agg(F.max("score").alias("score"), F.min_by("_o", F.struct(-F.col("score"), F.col("_o"))).alias("_o"))
    same = F.col(name) == F.col("_n")
    same = same & F.col(place).eqNullSafe(F.col("_p")) if place else same
    return left.join(best.hint("merge"), same).select(*left.columns, F.col("_o").alias(other), "score")


def locate(stations: DataFrame, tiers: Sequence[tuple[str, DataFrame]], curated: DataFrame, zones: DataFrame, stop: Sequence[str] = (), least: float = 0.34, bonus: float = 0.15) -> DataFrame:
    """``stations`` (name, zone, ...) with ``lat``, ``lon``, ``tier`` and ``score``: where a name lies and how that is known.

    ``tiers`` are (tag, features of name, lat, lon) in order; a name goes to the first whose best feature by ``token_match``, with
    ``bonus`` for a shared token of ``curated`` (token, lat, lon), scores ``least``. Only names without a match go on: to the position
    of their first curated token (tier curated), then the centre of their zone (tier zone; (zone, lat, lon)), else none. Scores have
    two digits; of features that share a name the least position counts. Repeated rows and null names come out row by row.
    """
    here = F.struct("lat", "lon")
    todo = stations.select("name").filter("name is not null").distinct()
    found = None
    for tag, features in tiers:
        spots = features.groupBy(F.col("name").alias("other")).agg(F.min(here).alias("at"))
        best = durable(token_match(todo, spots.select("other"), "name", "other", stop, least, bonus=bonus, places=curated).join(spots.hint("merge"), "other").select("name", "at", F.lit(tag).alias("tier"), F.round("score", 2).alias("score")))
        found = best if found is None else found.unionByName(best)
        todo = todo.join(best.select("name").hint("merge"), "name", "left_anti")
    words = todo.select("name", F.posexplode(name_tokens(F.col("name"), stop)).alias("k", "token"))
    towns = words.join(curated.groupBy(F.lower("token").alias("token")).agg(F.min(here).alias("at")).hint("merge"), "token")
    towns = towns.groupBy("name").agg(F.min_by("at", "k").alias("at")).select("name", "at", F.lit("curated").alias("tier"), F.lit(None).cast("double").alias("score"))
    every = towns if found is None else found.unionByName(towns)
    centres = zones.groupBy("zone").agg(F.min(here).alias("_z"))
    out = stations.join(every.hint("merge"), "name", "left").join(centres, "zone", "left")
    at = F.coalesce("at", "_z")
    tier = F.coalesce("tier", F.when(F.col("_z").isNotNull(), "zone").otherwise("none"))
    return out.select(*stations.columns, at["lat"].alias("lat"), at["lon"].alias("lon"), tier.alias("tier"), "score")


def tiered(df: DataFrame, tiers: Sequence[tuple[str, DataFrame]], key: Sequence[str], value: str) -> DataFrame:
    """Adds ``value`` from the first tier that knows the key and ``tier``, its name ('none' without one)."""
    out = df
    for k, (_, tier) in enumerate(tiers):
        out = out.join(tier.select(*key, F.col(value).alias(f"_v{k}")).dropDuplicates(list(key)), list(key), "left")
    found = F.coalesce(*[F.col(f"_v{k}") for k in range(len(tiers))])
    name = F.coalesce(*[F.when(F.col(f"_v{k}").isNotNull(), n) for k, (n, _) in enumerate(tiers)], F.lit("none"))
    return out.withColumn(value, found).withColumn("tier", name).drop(*[f"_v{k}" for k in range(len(tiers))])


def in_ring(lon: Column, lat: Column, ring: Column) -> Column:
    """Whether a point is inside a ring, by the parity of edges that a ray to the east crosses."""
    n = F.size(ring)

    def crosses(i: Column) -> Column:
        a, b = F.element_at(ring, i), F.element_at(ring, F.when(i == 1, n).otherwise(i - 1))
        spans = (a["lat"] > lat) != (b["lat"] > lat)
        at = (b["lon"] - a["lon"]) * (lat - a["lat"]) / (b["lat"] - a["lat"]) + a["lon"]
        return F.when(spans, lon < at).otherwise(F.lit(False))

    inside = F.aggregate(F.sequence(F.lit(1), n), F.lit(False), lambda s, i: s != crosses(i))
    return F.when(n >= 3, inside).otherwise(F.lit(False))


def ring_area(ring: Column) -> Column:
    """Area of a ring, never negative."""
    return F.abs(_twice_area(ring)) / 2


def _twice_area(ring: Column) -> Column:
    n = F.size(ring)

    def part(i: Column) -> Column:
        a, b = F.element_at(ring, i), F.element_at(ring, F.when(i == n, F.lit(1)).otherwise(i + 1))
        return a["lon"] * b["lat"] - b["lon"] * a["lat"]

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0.0), lambda s, i: s + part(i))


def ring_centroid(ring: Column) -> Column:
    """STRUCT<lon, lat> of a ring's centroid; null for a ring without area."""
    n = F.size(ring)

    def side(axis: str) -> Column:
        def part(i: Column) -> Column:
            a, b = F.element_at(ring, i), F.element_at(ring, F.when(i == n, F.lit(1)).otherwise(i + 1))
            return (a[axis] + b[axis]) * (a["lon"] * b["lat"] - b["lon"] * a["lat"])

        return F.try_divide(F.aggregate(F.sequence(F.lit(1), n), F.lit(0.0), lambda s, i: s + part(i)), 3 * _twice_area(ring))

    return F.struct(side("lon").alias("lon"), side("lat").alias("lat"))


#: Cells along a polygon's longer side at first, points from which a cell at a polygon's edge is cut into four, and cells' least level.
ACROSS, CROWD, DEEPEST = 8, 10_000, 40


def _cut(cells: DataFrame) -> DataFrame:
    """(name, ring, level, gx, gy, inside) of cells (name, ring, level, gx, gy): those that an edge of the ring crosses, and those inside."""
    size = F.pow(F.lit(2.0), -F.col("level"))
    x0, y0 = F.col("gx") * size, F.col("gy") * size
    n = F.size("ring")

    def crosses(i: Column) -> Column:
        """Whether an edge touches the closed cell: their boxes overlap and the corners are not all on one side of it."""
        a, b = F.element_at("ring", i), F.element_at("ring", F.when(i == n, F.lit(1)).otherwise(i + 1))
        side = lambda x, y: (b["lon"] - a["lon"]) * (y - a["lat"]) - (b["lat"] - a["lat"]) * (x - a["lon"])
        sides = [side(x, y) for x in (x0, x0 + size) for y in (y0, y0 + size)]
        boxes = (F.least(a["lon"], b["lon"]) <= x0 + size) & (F.greatest(a["lon"], b["lon"]) >= x0) & (F.least(a["lat"], b["lat"]) <= y0 + size) & (F.greatest(a["lat"], b["lat"]) >= y0)
        return boxes & (F.least(*sides) <= 0) & (F.greatest(*sides) >= 0)

    edge = F.exists(F.sequence(F.lit(1), n), crosses)
    told = cells.withColumn("_edge", edge).withColumn("inside", ~F.col("_edge") & in_ring(x0 + size / 2, y0 + size / 2, F.col("ring")))
    return told.filter("_edge or inside").select("name", "ring", "level", "gx", "gy", "inside")


def _in_cells(points: DataFrame, levels: Sequence[int]) -> DataFrame:
    """Points with the cell they are in at each of the levels."""
    at = F.explode(F.array(*[F.lit(k) for k in levels])).alias("level")
    grid = lambda c: F.floor(F.col(c) * F.pow(F.lit(2.0), F.col("level")))
    return points.select("lon", "lat", at).withColumns({"gx": grid("lon"), "gy": grid("lat")})


def polygon_cover(points: DataFrame, polygons: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(name, ring, level, gx, gy, inside): cells of side 2^-level that cover the polygons, marked where they lie wholly inside.

    A polygon begins with cells of an eighth of its longer side, whatever its size. Cells at an edge in which over ``crowd`` points lie
    are cut into four, again and again, so the more points there are, the fewer meet an edge. Points at one position count once: no
    cut would part them.
    """
    points = points.select("lon", "lat").distinct()
    bound = lambda f, axis: f(F.transform("ring", lambda p: p[axis]))
    box = polygons.filter(F.size("ring") >= 3).select("name", "ring", *[bound(f, axis).alias(c) for c, f, axis in (("x0", F.array_min, "lon"), ("x1", F.array_max, "lon"), ("y0", F.array_min, "lat"), ("y1", F.array_max, "lat"))])
    side = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
    level = F.when(side > 0, F.floor(F.log2(ACROSS / side))).otherwise(DEEPEST)
    box = box.withColumn("level", F.least(F.greatest(level, F.lit(-DEEPEST)), F.lit(DEEPEST)).cast("int"))
    at = lambda c: F.floor(F.col(c) * F.pow(F.lit(2.0), F.col("level")))
    cells = box.withColumn("gx", F.explode(F.sequence(at("x0"), at("x1")))).withColumn("gy", F.explode(F.sequence(at("y0"), at("y1"))))
    cover = durable(_cut(cells.select("name", "ring", "level", "gx", "gy")))
    done = []
    while True:
        levels = [r["level"] for r in cover.filter("not inside").select("level").distinct().collect()]
        if not levels:
            break
        key = ["level", "gx", "gy"]
        full = cover.filter("not inside").select(*key).distinct().join(_in_cells(points, levels), key).groupBy(*key).agg(F.count("*").alias("n"))
        full = durable(full.filter((F.col("n") > crowd) & (F.col("level") < DEEPEST)).select(*key))
        if full.isEmpty():
            break
        done.append(cover.join(full, key, "left_anti"))
        part = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)])).alias("_q")
        split = cover.filter("not inside").join(full, key).select("name", "ring", (F.col("level") + 1).alias("level"), "gx", "gy", part)
        done.append(cover.filter("inside").join(full, key, "left_semi"))
        cover = durable(_cut(split.select("name", "ring", "level", (2 * F.col("gx") + F.col("_q.i")).alias("gx"), (2 * F.col("gy") + F.col("_q.j")).alias("gy"))))
    return reduce(lambda a, b: a.unionByName(b), done, cover)


def point_in_polygon(points: DataFrame, polygons: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Points (id, lon, lat) with the first polygon by name whose ring holds them: (id, name); points outside all have null.

    Points meet the polygons' ``polygon_cover`` by equality on cells; where a cell is wholly inside nothing else is asked, at an edge
    the ring is tested. Each position is judged once, for all its points. Repeated ids come out once each; null positions and rings of
    under three corners match nothing.
    """
    spots = durable(points.select("lon", "lat").filter("lon is not null and lat is not null").distinct())
    cover = durable(polygon_cover(spots, polygons, crowd))
    levels = [r["level"] for r in cover.select("level").distinct().collect()]
    if not levels:
        return points.select("id", F.lit(None).cast("string").alias("name"))
    met = _in_cells(spots, levels).join(cover, ["level", "gx", "gy"])
    hit = met.filter(F.col("inside") | in_ring(F.col("lon"), F.col("lat"), F.col("ring"))).groupBy("lon", "lat").agg(F.min("name").alias("name"))
    return points.select("id", "lon", "lat").join(hit, ["lon", "lat"], "left").select("id", "name")


def nearest_centre(words: DataFrame, centres: DataFrame, key: Sequence[str], x: str, centre: str, within: float) -> DataFrame:
    """Words with the nearest centre of their page inside the tolerance, the smaller on a tie; others are left out.

    A page's centres, which are few, travel as one array, so every word row comes out once, repeated ones too.
    """
    own = [centre, *[c for c in centres.columns if c not in (*key, centre)]]
    listed = centres.groupBy(*key).agg(F.collect_list(F.struct(*own)).alias("_c"))
    gaps = F.transform("_c", lambda c: F.struct(F.abs(c[centre] - F.col(x)).alias("gap"), *[c[name].alias(name) for name in own]))
    near = words.join(listed, list(key)).withColumn("_b", F.array_min(F.filter(gaps, lambda g: g["gap"] <= within)))
    rest = [c for c in words.columns if c not in key]
    return near.filter("_b is not null").select(*key, *rest, *[F.col(f"_b.{name}").alias(name) for name in own], F.col("_b.gap").alias("gap"))


#: Kinds of places in the order in which they answer.
KINDS = ("district", "upazila", "place", "zone", "plant", "substation")
#: Answers for a typed name.
MOST = 8
#: Lengths of the pieces of names that are listed; a text looks up pieces of the longest that it holds.
PIECES = (2, 3, 6, 12)


def resolve_places(queries: DataFrame, gazetteer: DataFrame, q: str = "q", aliases: DataFrame | None = None, kinds: Sequence[str] = KINDS, most: int = MOST) -> DataFrame:
    """(q, place, rank, kind, name, district, zone): the best ``most`` answers for each typed name, one a (name, district), ``place`` from 1.

    ``gazetteer`` has name and district, and where it has them kind, zone and ``local`` (the name in another script). Ranks: 0 exact,
    1 the name begins with the text, 2 another spelling (``aliases``: name, alias) begins with it, 3 the name holds it, 4 same
    consonants as the name or a spelling, 5 consonants of three letters or more but for one edit; then the order of ``kinds``,
    shorter names, names. Texts of fewer than two characters find nothing; case does not count.

    Ways 0 to 3 share an inverted index of pieces of 2, 3, 6 and 12 characters with their places: a text looks up its rarest piece of
    the longest of these lengths that it holds and stays where its other characters stand around it. Long pieces keep the lists short
    where all triples are frequent. Ways 4 and 5 meet on skeletons with at most one letter left out. So no text meets the whole
    gazetteer, and what a text finds is cut to its best rows by partial sorts. All joins are by sorted shuffles: both sides grow with
    the input, and Spark guesses them from a packed file, so it would send them through the driver.
    """
    has = lambda c, other: F.col(c) if c in gazetteer.columns else F.lit(other).cast("string")
    asked = queries.select(q).distinct().withColumn("_q", F.lower(F.trim(F.col(q)))).filter(F.length("_q") >= 2)
    entries = gazetteer.select(has("kind", kinds[0]).alias("kind"), "name", "district", has("zone", None).alias("zone"), has("local", None).alias("local")).filter("name is not null").distinct()
    said = aliases.select("name", "alias").filter("alias is not null") if aliases is not None else queries.sparkSession.createDataFrame([], "name string, alias string")
    # a spelling holds for all entries of a name, a name in another script for its own ones
    none = F.lit(None).cast("string").alias("_own")
    texts = entries.select("name", F.col("name").alias("text"), F.lit(False).alias("_alias"), none)
    texts = texts.unionByName(said.join(entries.select("name").distinct().hint("merge"), "name").select("name", F.col("alias").alias("text"), F.lit(True).alias("_alias"), none))
    texts = texts.unionByName(entries.filter("local is not null").select("name", F.col("local").alias("text"), F.lit(False).alias("_alias"), F.col("local").alias("_own")))
    texts = texts.withColumn("text", F.lower("text")).distinct()
    pieces = lambda c, n: F.transform(F.sequence(F.lit(1), F.length(c) - n + 1), lambda i: F.struct(F.substring(c, i, F.lit(n) if isinstance(n, int) else n).alias("gram"), i.cast("int").alias("at")))
    listed = F.concat(*[F.when(F.length("text") >= n, pieces(F.col("text"), n)).otherwise(F.array().cast("array<struct<gram:string,at:int>>")) for n in PIECES])
    posted = texts.select("name", "text", "_alias", "_own", F.inline(listed))
    often = posted.groupBy("gram").agg(F.count("*").alias("_df"))
    # a text's rarest gram; one that is nowhere ends the search
    longest = F.greatest(*[F.when(F.length("_q") >= n, n).otherwise(PIECES[0]) for n in PIECES])
    grams = asked.select(q, "_q", F.inline(pieces(F.col("_q"), longest))).join(often.hint("merge"), "gram", "left")
    rare = grams.groupBy(q, "_q").agg(F.min(F.struct(F.coalesce("_df", F.lit(0)).alias("df"), F.col("at").alias("_off"), F.col("gram"))).alias("g")).select(q, "_q", "g.gram", "g._off")
    start = F.col("at") - F.col("_off") + 1
    held = rare.join(posted.hint("merge"), "gram").filter((start >= 1) & (F.substring("text", F.greatest(start, F.lit(1)), F.length("_q")) == F.col("_q")))
    way = F.when(F.col("_alias"), F.when(start == 1, 2)).otherwise(F.when(F.col("text") == F.col("_q"), 0).when(start == 1, 1).otherwise(3))
    found = held.select(q, "name", way.alias("rank"), "_own").filter("rank is not null")

    spoken = texts.filter("_own is null").select("name", phonetic(F.col("text")).alias("_k")).filter("_k <> ''").distinct()
    heard = asked.select(q, phonetic(F.col("_q")).alias("_s")).filter("_s <> ''")
    found = found.unionByName(heard.join(spoken.hint("merge"), F.col("_s") == F.col("_k")).select(q, "name", F.lit(4).alias("rank"), none))
    shorter = lambda c: F.array_distinct(F.concat(F.array(c), F.transform(F.sequence(F.lit(1), F.length(c)), lambda i: F.concat(F.substring(c, F.lit(1), i - 1), F.substring(c, i + 1, F.length(c))))))
    skeletons = spoken.select("_k").distinct().select("_k", F.explode(shorter(F.col("_k"))).alias("_d"))
    wanted = heard.filter(F.length("_s") >= 3).select("_s").distinct().select("_s", F.explode(shorter(F.col("_s"))).alias("_d"))
    edited = wanted.join(skeletons.hint("merge"), "_d").select("_s", "_k").distinct().filter(F.levenshtein("_s", "_k", 1) >= 0)
    found = found.unionByName(heard.join(edited.hint("merge"), "_s").join(spoken.hint("merge"), "_k").select(q, "name", F.lit(5).alias("rank"), none))

    best = found.groupBy(q, F.col("name").alias("_name"), "_own").agg(F.min("rank").alias("rank"))
    own = (F.col("_name") == F.col("name")) & (F.col("_own").isNull() | (F.col("_own") == F.col("local")))
    kind = F.coalesce(F.array_position(F.array(*[F.lit(k) for k in kinds]), F.col("kind")), F.lit(0))
    order = F.struct("rank", F.when(kind == 0, len(kinds) + 1).otherwise(kind).alias("k"), F.length("name").alias("n"), "name", "kind", "zone")
    one = best.join(entries.hint("merge"), own).groupBy(q, F.lower("name").alias("_l"), "district").agg(F.min(order).alias("o"))
    place = F.row_number().over(Window.partitionBy(q).orderBy("o", "district"))
    return one.withColumn("place", place).filter(F.col("place") <= most).select(q, "place", "o.rank", "o.kind", "o.name", "district", "o.zone")


def same_name(df: DataFrame, other: DataFrame, name: str = "name", district: str = "district") -> DataFrame:
    """Rows with the record of another kind that has the same cleaned name, one of the same district first: adds match, same_district.

    The best record is found once for each (name, district) that occurs, then rows take it, repeated ones too.
    """
    key = lambda c: F.regexp_replace(F.lower(F.col(c)), "[^a-z0-9]", "")
    b = other.select(key(name).alias("_k"), F.col(name).alias("match"), F.col(district).alias("_d")).distinct()
    rows = df.withColumn("_k", key(name))
    asked = rows.select("_k", F.col(district).alias("_a")).distinct()
    met = asked.join(b, "_k").withColumn("same_district", F.col("_d") == F.col("_a"))
    order = F.struct((~F.coalesce("same_district", F.lit(False))).alias("away"), F.col("same_district").isNull().alias("unknown"), F.col("match"), F.col("_d"))
    best = met.groupBy("_k", "_a").agg(F.min_by(F.struct("match", "same_district"), order).alias("_m"))
    same = (rows["_k"] == best["_k"]) & rows[district].eqNullSafe(best["_a"])
    return rows.join(best, same).select(*[rows[c] for c in df.columns], F.col("_m.match").alias("match"), F.col("_m.same_district").alias("same_district"))


def gazetteer(points: DataFrame, polygons: DataFrame) -> DataFrame:
    """(kind, name, district) of points (id, kind, name, lon, lat) inside a district, without the district's own name, once each."""
    inside = points.join(point_in_polygon(points.select("id", "lon", "lat"), polygons).withColumnRenamed("name", "district"), "id").filter("district is not null")
    named = inside.withColumn("name", place_name(F.col("name"))).filter("name <> '' and lower(name) <> lower(district)")
    return named.select("kind", "name", "district").distinct()


def merge_slots(a: DataFrame, b: DataFrame, key: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Two curves by date and slot as one; the first wins where both have a field."""
    right = b.select(*key, *[F.col(f).alias(f"_{f}") for f in fields])
    return a.join(right, list(key), "full").select(*key, *[F.coalesce(f, f"_{f}").alias(f) for f in fields])
