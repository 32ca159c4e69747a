"""Procurement findings: dedup, dimensions, spend, profiles, prices, plans, bans, owners."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordscope.functions.text import address_tail, company_key, has_tokens, owner_key, reference_key, scope, severity, tags
from recordscope.operators.stats import numbered
from recordscope.sources.io import durable

UNKNOWN = "Unknown"
# How open a procurement method is.
OPENNESS = {"OTM": 5, "OSTETM": 4, "QCBS": 4, "SFB": 4, "RFQU": 3, "RFQ": 3, "RFQL": 3, "LTM": 2, "IC": 2, "DPM": 1, "SSS": 1}


def pick_first(df: DataFrame, key: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key; ``order`` must be total. Null keys form a key."""
    k = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("_k", k).filter("_k = 1").drop("_k")


def pick_last(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key."""
    return pick_first(df, key, [F.col(c).desc_nulls_last() for c in order])


def duplicate_count(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: rows, distinct keys and rows beyond the first of their key.

    Keys are dealt out to all shuffle partitions, which are not merged, so no task counts them beside the sorts of a join before.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    per = df.select(*key).repartition(parts, *key).groupBy(*key).agg(F.count("*").alias("n"))
    return per.agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_keys"), F.sum(F.col("n") - 1).alias("n_duplicates"))


def build_dimension(df: DataFrame, name: str, order: Sequence[str]) -> DataFrame:
    """(id, name): dense ids in order of first appearance; distinct names are numbered by sorted ranges, in many tasks. Nulls have no id."""
    first = df.filter(F.col(name).isNotNull()).groupBy(F.col(name).alias("name")).agg(F.min(F.struct(*order)).alias("_o"))
    return numbered(first, ["_o", "name"], "id").select("id", "name")


def decode_dimension(df: DataFrame, id_col: str, dim: DataFrame, out: str) -> DataFrame:
    """Adds the name of a dimension id, 'Unknown' for null or unlisted ids."""
    small = dim.select(F.col("id").alias(id_col), F.col("name").alias(out))
    return df.join(small, id_col, "left").withColumn(out, F.coalesce(out, F.lit(UNKNOWN)))


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """(name, n) by descending count, then name; nulls count as 'Unknown'."""
    out = df.groupBy(F.coalesce(F.col(column).cast("string"), F.lit(UNKNOWN)).alias("name")).agg(F.count("*").alias("n"))
    return out.orderBy(F.col("n").desc(), "name").limit(top) if top else out


def spend_cube(df: DataFrame) -> DataFrame:
    """(grain, year, method, ministry, district, n, value) at four grains in one pass."""
    sets = [["year"], ["year", "method"], ["ministry", "year"], ["district"]]
    cols = ["year", "method", "ministry", "district"]
    cube = df.groupingSets([[F.col(c) for c in s] for s in sets], *cols).agg(F.grouping_id().alias("_g"), F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("value"))
    grain = F.when(F.col("_g") == 7, "year").when(F.col("_g") == 3, "year_method").when(F.col("_g") == 5, "ministry_year").otherwise("district")
    return cube.select(grain.alias("grain"), *cols, "n", "value")


def top_entities(df: DataFrame, name: str, value: str, top: int) -> DataFrame:
    """(name, total) of the ``top`` names by value."""
    return df.groupBy(name).agg(F.round(F.sum(value), 2).alias("total")).orderBy(F.col("total").desc(), name).limit(top)


def vendor_profile(df: DataFrame) -> DataFrame:
    """Per vendor key: modal name, count, value, distinct entities and ministries, active years, top entity and its share.

    Rows are added up once by printed name, entity, ministry and year; keys are made once from the names that are left. Then names,
    entities, ministries and years are added up together by vendor, and each vendor's sums give all figures, so nothing is joined.
    Ties go to the smaller name.
    """
    small = df.groupBy("awarded_to", "entity", "ministry", F.year("signed").alias("year")).agg(F.count("*").alias("c"), F.sum("value").alias("v"))
    named = durable(small.select("*", company_key(F.col("awarded_to")).alias("vendor"))).filter("vendor <> ''")
    kinds = ("awarded_to", "entity", "ministry", "year")
    each = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).cast("string").alias("said")) for k, c in enumerate(kinds)])
    sums = named.select("vendor", "c", "v", F.inline(each)).groupBy("vendor", "kind", "said").agg(F.sum("c").alias("c"), F.sum("v").alias("v"))
    of = lambda c, value: F.when(F.col("kind") == kinds.index(c), value)
    first = F.struct(-F.col("c"), F.col("said"))
    best = lambda c: F.min_by("said", of(c, first))
    out = sums.groupBy("vendor").agg(
        best("awarded_to").alias("name"), F.sum(of("awarded_to", F.col("c"))).alias("n"), F.round(F.sum(of("awarded_to", F.col("v"))), 2).alias("value"),
        *[F.count(of(c, F.col("said"))).alias(name) for c, name in (("entity", "n_entities"), ("ministry", "n_ministries"))],
        F.count(of("year", F.col("said"))).cast("int").alias("n_years"), best("entity").alias("top_entity"), F.max(of("entity", F.col("c"))).alias("_top"),
    )
    return out.select("vendor", "name", "n", "value", "n_entities", "n_ministries", "n_years", "top_entity", F.round(F.col("_top") / F.col("n"), 3).alias("top_share"))


def vendor_lists(profiles: DataFrame, top: int = 40, least: int = 5, share: float = 0.8) -> DataFrame:
    """(list, place, vendor): by value, by count, and concentrated vendors (their rounded share counts)."""
    def ranked(df: DataFrame, name: str, order: list[Column], limit: int | None) -> DataFrame:
        few = df.orderBy(*order).limit(limit) if limit else df
        return few.select(F.lit(name).alias("list"), F.row_number().over(Window.orderBy(*order)).alias("place"), "vendor")

    profiles = durable(profiles.select("vendor", "value", "n", "top_share"))
    by_value = ranked(profiles, "value", [F.col("value").desc(), F.col("vendor")], top)
    by_count = ranked(profiles, "count", [F.col("n").desc(), F.col("vendor")], top)
    dense = profiles.filter((F.col("n") >= least) & (F.col("top_share") >= share))
    return by_value.unionByName(by_count).unionByName(ranked(dense, "concentrated", [F.col("value").desc(), F.col("vendor")], top))


def entity_profile(df: DataFrame, level: str, top: int = 5) -> DataFrame:
    """Per entity: count, value, counts by nature (map), its ``top`` vendors by value (array); lists are built after the cut."""
    main = df.groupBy(level).agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("value"))
    nature = df.groupBy(level, F.coalesce("nature", F.lit(UNKNOWN)).alias("nature")).agg(F.count("*").alias("c"))
    nature = nature.groupBy(level).agg(F.array_sort(F.collect_list(F.concat_ws("=", "nature", F.col("c").cast("string")))).alias("natures"))
    per = df.groupBy(level, "awarded_to").agg(F.round(F.sum("value"), 2).alias("v"))
    w = Window.partitionBy(level).orderBy(F.col("v").desc(), "awarded_to")
    few = per.withColumn("k", F.row_number().over(w)).filter(F.col("k") <= top)
    vendors = few.groupBy(level).agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "awarded_to"))), lambda x: x["awarded_to"]).alias("vendors"))
    return main.join(nature, level).join(vendors, level)


def cross_vendors(df: DataFrame, least: int = 3, top_each: int = 10, top: int = 30) -> DataFrame:
    """Vendors of ``least`` ministries or more with their main ministries, by number of ministries, then value."""
    per = df.groupBy("awarded_to", F.coalesce("ministry", F.lit(UNKNOWN)).alias("ministry")).agg(F.sum("value").alias("v"), F.count("*").alias("c"))
    few = per.withColumn("k", F.row_number().over(Window.partitionBy("awarded_to").orderBy(F.col("v").desc(), "ministry")))
    out = few.groupBy("awarded_to").agg(F.count("*").alias("n_ministries"), F.sum("c").alias("n"), F.round(F.sum("v"), 2).alias("value"), F.array_sort(F.collect_list(F.when(F.col("k") <= top_each, F.struct("k", "ministry")))).alias("m"))
    out = out.filter(F.col("n_ministries") >= least).orderBy(F.col("n_ministries").desc(), F.col("value").desc(), "awarded_to").limit(top)
    return out.select("awarded_to", "n_ministries", "n", "value", F.transform("m", lambda x: x["ministry"]).alias("ministries"))


def shares(df: DataFrame, keys: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """Count, value and share of value of each key, of all or of each ``within`` group."""
    part = Window.partitionBy(*within)
    out = df.groupBy(*dict.fromkeys([*within, *keys])).agg(F.count("*").alias("n"), F.sum("value").alias("v"))
    return out.withColumn("share", F.round(F.try_divide(F.col("v"), F.sum("v").over(part)), 6)).withColumn("value", F.round("v", 2)).drop("v")


def month_rush(df: DataFrame, month: int = 6, least: int = 500, partial_from: str | None = None) -> DataFrame:
    """Per year with ``least`` rows: share of the value that falls in one month, and whether the year is incomplete."""
    out = df.groupBy(F.year("signed").alias("year")).agg(F.count("*").alias("n"), F.sum("value").alias("v"), F.sum(F.when(F.month("signed") == month, F.col("value"))).alias("m"))
    partial = F.make_date(F.col("year"), F.lit(12), F.lit(31)) > F.lit(partial_from).cast("date") if partial_from else F.lit(False)
    return out.filter(F.col("n") >= least).select("year", "n", F.round(F.try_divide(F.coalesce("m", F.lit(0.0)), "v"), 6).alias("share"), partial.alias("partial"))


def office_concentration(df: DataFrame, least_n: int = 50, least_value: float = 5e8, worst: int | None = None) -> DataFrame:
    """Per office with enough awards: share of its largest vendor and its 20-point bucket; all rows count in its value.

    ``worst`` keeps that many offices of largest share.
    """
    per = df.groupBy("entity", "awarded_to").agg(F.count("*").alias("c"), F.sum("value").alias("v"))
    out = per.groupBy("entity").agg(F.sum("c").alias("n"), F.sum("v").alias("value"), F.max(F.when(F.col("awarded_to").isNotNull(), F.col("v"))).alias("most"))
    out = out.filter((F.col("n") >= least_n) & (F.col("value") >= least_value)).withColumn("share", F.col("most") / F.col("value"))
    out = out.select("entity", "n", F.round("value", 2).alias("value"), F.round("share", 6).alias("share"), F.least(F.floor(F.col("share") * 5), F.lit(4)).cast("int").alias("bucket"))
    return out.orderBy(F.col("share").desc(), "entity").limit(worst) if worst else out


def price_points(df: DataFrame, method: str, top: int = 25) -> DataFrame:
    """The most repeated exact values with their count, share of ``method`` and modal method."""
    per = df.filter("value is not null").groupBy("value", "method").agg(F.count("*").alias("c"))
    out = per.groupBy("value").agg(F.sum("c").alias("n"), F.sum(F.when(F.col("method") == method, F.col("c")).otherwise(0)).alias("m"), F.min_by("method", F.struct(-F.col("c"), "method")).alias("modal_method"))
    return out.orderBy(F.col("n").desc(), "value").limit(top).select("value", "n", F.round(F.col("m") / F.col("n"), 6).alias("method_share"), "modal_method")


def price_summary(df: DataFrame, method: str, top: int = 20) -> DataFrame:
    """One row: distinct values, share of rows on the ``top`` values, share of rows by ``method``."""
    per = df.filter("value is not null").groupBy("value").agg(F.count("*").alias("n"), F.count_if(F.col("method") == method).alias("m"))
    few = per.orderBy(F.col("n").desc(), "value").limit(top).agg(F.sum("n").alias("t"))
    return per.agg(F.count("*").alias("n_values"), F.sum("n").alias("n"), F.sum("m").alias("m")).crossJoin(few).select("n_values", F.round(F.col("t") / F.col("n"), 6).alias("top_share"), F.round(F.col("m") / F.col("n"), 6).alias("method_share"))


def match_plans(plan: DataFrame, award: DataFrame, plan_order: Sequence[str]) -> DataFrame:
    """Awards with the first plan item of their reference; needs a positive estimate and a value that is not 0."""
    first = pick_first(plan.withColumn("ref", reference_key(F.col("package_no"))).filter("ref <> '' and estimate > 0"), ["ref"], plan_order)
    return award.withColumn("ref", reference_key(F.col("reference"))).filter("value <> 0").join(first, "ref")


def ratio_bucket(r: Column) -> Column:
    return F.when(r < 0.7, "<70%").when(r < 0.85, "70-85%").when(r < 0.95, "85-95%").when(r <= 1.0, "95-100%").when(r <= 1.15, "100-115%").otherwise(">115%")


def ratio_bands(pairs: DataFrame) -> DataFrame:
    """One row: pairs near round discounts and above the estimate, as counts and shares."""
    r = F.col("ratio")
    bands = {"at_10pct_below": (0.895, 0.905), "at_5pct_below": (0.945, 0.955), "at_15pct_below": (0.845, 0.855), "exactly_at_estimate": (0.999, 1.001)}
    out = pairs.agg(F.count("*").alias("n"), F.count_if(r > 1).alias("above"), *[F.count_if(r.between(*b)).alias(k) for k, b in bands.items()])
    return out.select("n", *bands, F.round(F.try_divide("above", "n"), 6).alias("share_above"))


def method_changes(pairs: DataFrame, rank: dict[str, int] = OPENNESS, top: int | None = None) -> DataFrame:
    """(planned, awarded, n, change, equal_rank): same, less_open or, for all others, more_open; unknown methods rank 0.

    ``top`` keeps that many of the most frequent pairs.
    """
    table = F.create_map(*[F.lit(x) for kv in rank.items() for x in kv])
    openness = lambda c: F.coalesce(F.element_at(table, c), F.lit(0))
    per = pairs.groupBy("planned_method", "method").agg(F.count("*").alias("n"))
    p, a = openness(F.col("planned_method")), openness(F.col("method"))
    change = F.when(F.col("planned_method") == F.col("method"), "same").when(a < p, "less_open").otherwise("more_open")
    out = per.select("planned_method", "method", "n", change.alias("change"), ((p == a) & (F.col("planned_method") != F.col("method"))).alias("equal_rank"))
    return out.orderBy(F.col("n").desc(), "planned_method", "method").limit(top) if top else out


def generic_keys(awards: DataFrame, bans: DataFrame, most: int = 5) -> DataFrame:
    """(key): register keys that occur in over ``most`` districts of all awards; a null district counts as one."""
    wanted = bans.select("key").distinct()
    place = F.lower(F.trim(F.coalesce("district", F.lit(""))))
    return awards.join(wanted, "key", "left_semi").groupBy("key").agg(F.count_distinct(place).alias("n")).filter(F.col("n") > most).select("key")


def ban_flags(awards: DataFrame, bans: DataFrame, most: int = 5) -> DataFrame:
    """Awards to banned companies of the same district: 'violation' inside the ban, 'later_award' after it.

    Companies match on their key, generic keys are left out, an award can match several bans. The register is the small
    side; Spark broadcasts it when its size allows and otherwise splits the keyed join.
    """
    b = bans.select(company_key(F.col("company")).alias("key"), address_tail(F.col("address")).alias("place"), "company", "start", "end").filter("key <> ''")
    # awards are read twice, for the generic keys and for the match, and may be dear to make: the columns needed are written once
    a = awards.withColumn("key", company_key(F.col("awarded_to"))).join(b.select("key").distinct(), "key", "left_semi")
    a = durable(a.select("key", "district", F.lower(F.trim(F.coalesce("district", F.lit("")))).alias("place"), "tender_id", "pkg_lot_id", "signed", "value"))
    b = b.join(generic_keys(a, b, most), "key", "left_anti")
    hit = a.join(b, ["key", "place"]).filter(F.col("signed") >= F.col("start"))
    kind = F.when(F.col("signed") <= F.col("end"), "violation").otherwise("later_award")
    return hit.select("company", "tender_id", "pkg_lot_id", "signed", "value", "start", "end", kind.alias("kind"))


def flag_rollup(flags: DataFrame) -> DataFrame:
    """(kind, year, n, value, n_firms) by kind and year and, with a null year, by kind."""
    return flags.groupingSets([[F.col("kind")], [F.col("kind"), F.col("year")]], "kind", "year").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("value"), F.count_distinct("company").alias("n_firms"))


def shared_owners(details: DataFrame, owners: str = "owners", company: str = "company", least: int = 2) -> DataFrame:
    """(owner, companies): owner keys of three words or more that stand behind ``least`` companies; each company once."""
    o = details.select(F.explode(owners).alias("o"), company).select(owner_key(F.col("o")).alias("owner"), company).filter(has_tokens(F.col("owner")) & F.col(company).isNotNull())
    pairs = o.distinct()
    many = pairs.groupBy("owner").agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    return pairs.join(many.select("owner"), "owner", "left_semi").groupBy("owner").agg(F.array_sort(F.collect_list(company)).alias("companies"))


def id_aliases(df: DataFrame, id_col: str, key: str) -> DataFrame:
    """(id, keys): ids that occur under two keys or more."""
    return df.groupBy(F.col(id_col).alias("id")).agg(F.array_sort(F.collect_set(key)).alias("keys")).filter(F.size("keys") >= 2)


def latest_samples(df: DataFrame, top: int) -> DataFrame:
    """Per vendor its most recent award (the smallest id on a tie), for the ``top`` vendors by value."""
    out = df.groupBy("awarded_to").agg(F.round(F.sum("value"), 2).alias("value"), F.max("signed").alias("signed"), F.min_by("tender_id", F.struct(-F.unix_date("signed"), "tender_id", "pkg_lot_id")).alias("tender_id"))
    return out.orderBy(F.col("value").desc(), "awarded_to").limit(top)


def work_list(df: DataFrame, office: str, kinds: Sequence[str], done: DataFrame) -> DataFrame:
    """(office, kind, n): pairs still to fetch, most frequent offices first."""
    per = df.groupBy(office).agg(F.count("*").alias("n")).withColumn("kind", F.explode(F.array(*[F.lit(k) for k in kinds])))
    return per.join(done, [office, "kind"], "left_anti").select(office, "kind", "n")


def plan_rollup(plan: DataFrame, top: int = 20) -> DataFrame:
    """(grain, fiscal_year, ministry, n): projects by year, by ministry and year, and of the ``top`` ministries, in one pass over the plan."""
    per = plan.groupBy(F.coalesce("ministry", F.lit(UNKNOWN)).alias("ministry"), "fiscal_year").agg(F.count("*").alias("n"))
    years = per.groupBy("fiscal_year").agg(F.sum("n").alias("n")).select(F.lit("year").alias("grain"), "fiscal_year", F.lit(None).cast("string").alias("ministry"), "n")
    both = per.select(F.lit("ministry_year").alias("grain"), "fiscal_year", "ministry", "n")
    most = per.groupBy("ministry").agg(F.sum("n").alias("n")).orderBy(F.col("n").desc(), "ministry").limit(top)
    return years.unionByName(both).unionByName(most.select(F.lit("top_ministry").alias("grain"), F.lit(None).cast("string").alias("fiscal_year"), "ministry", "n"))


def ban_register(bans: DataFrame) -> DataFrame:
    """Adds to bans (company, scope, debarred_by, reason, start, end): key, repeats, scope_label, days, severity, tags.

    ``repeats`` counts the bans of a company by its key; a blank key stands for no company and counts once.
    """
    rows = bans.withColumn("key", company_key(F.col("company")))
    per = rows.filter("key <> ''").groupBy("key").agg(F.count("*").alias("repeats"))
    said = scope(F.col("scope"), F.col("debarred_by"))
    out = rows.join(per, "key", "left").withColumn("repeats", F.coalesce("repeats", F.lit(1))).withColumn("days", F.datediff("end", "start"))
    return out.withColumns({"scope_label": said["label"], "severity": severity(said["score"], F.col("days"), F.col("repeats")), "tags": tags(F.col("reason"))})


def ban_rollup(register: DataFrame) -> DataFrame:
    """(grain, name, n): bans by severity, by tag (a ban counts under each of its tags) and of each company with more than one."""
    by = lambda grain, df, name: df.groupBy(F.col(name).alias("name")).agg(F.count("*").alias("n")).select(F.lit(grain).alias("grain"), "name", "n")
    again = register.filter("repeats > 1").groupBy("key").agg(F.min("company").alias("name"), F.count("*").alias("n")).select(F.lit("repeat").alias("grain"), "name", "n")
    return by("severity", register, "severity").unionByName(by("tag", register.select(F.explode("tags").alias("tag")), "tag")).unionByName(again)


def tender_funnel(tenders: DataFrame, statuses: Sequence[str], at: str = "published", status: str = "status") -> DataFrame:
    """One row a year, one column a status: numbers of tenders."""
    out = tenders.groupBy(F.year(at).alias("year")).pivot(status, list(statuses)).agg(F.count(F.lit(1)))
    return out.select("year", *[F.coalesce(c, F.lit(0)).alias(c) for c in statuses])


def owner_coverage(details: DataFrame, owner: str, person: str) -> DataFrame:
    """One row: contracts, those with an owner, distinct persons behind them and the share that is covered."""
    return details.agg(F.count("*").alias("n"), F.count(owner).alias("n_with_owner"), F.count_distinct(person).alias("n_owners"), F.round(F.count(owner) / F.count("*"), 6).alias("coverage"))
