"""Checks that published tables agree with themselves and with each other."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordscope.operators.stats import quantile
from recordscope.sources.io import durable


class ReferenceError_(ValueError):
    """Rows without the partner that they must have."""


def richest(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key with the longest JSON form; the first by ``order`` on a tie."""
    rows = df.withColumn("_len", F.length(F.to_json(F.struct(*df.columns))))
    k = F.row_number().over(Window.partitionBy(*key).orderBy(F.col("_len").desc(), *order))
    return rows.withColumn("_k", k).filter("_k = 1").drop("_k", "_len")


def classify_pairs(df: DataFrame, districts: DataFrame) -> DataFrame:
    """Adds ``class``: unknown (no name), valid, wrong_division (the district is of another division) or invalid."""
    names = districts.select("district", F.lit(True).alias("_known")).distinct()
    pairs = districts.select("district", "division", F.lit(True).alias("_pair")).distinct()
    out = df.join(names, "district", "left").join(pairs, ["district", "division"], "left")
    blank = F.col("district").isNull() | F.col("division").isNull()
    return out.withColumn("class", F.when(blank, "unknown").when(F.col("_pair"), "valid").when(F.col("_known"), "wrong_division").otherwise("invalid")).drop("_known", "_pair")


def class_summary(df: DataFrame, value: str) -> DataFrame:
    """(class, rows, total, percent of total)."""
    per = df.groupBy("class").agg(F.count("*").alias("rows"), F.sum(value).alias("total"))
    return per.withColumn("percent", F.round(F.try_divide(F.col("total") * 100, F.sum("total").over(Window.partitionBy())), 4)).withColumn("total", F.round("total", 2))


def canonical(df: DataFrame, name: str, aliases: DataFrame, strict: bool = False) -> DataFrame:
    """Replaces ``name`` by its canonical form from (alias, canonical); unlisted names stay, or go if ``strict``."""
    small = aliases.select(F.col("alias").alias("_a"), F.col("canonical").alias("_c"))
    out = df.join(small, F.lower(F.trim(F.col(name))) == F.col("_a"), "inner" if strict else "left")
    return out.withColumn(name, F.coalesce("_c", name)).drop("_a", "_c")


def require_match(df: DataFrame, ref: DataFrame, key: Sequence[str]) -> DataFrame:
    """``df`` itself; raises if a row has no partner in ``ref``."""
    missing = df.join(ref, list(key), "left_anti").select(*key).distinct().limit(5).collect()
    if missing:
        raise ReferenceError_(f"no match for {[tuple(r) for r in missing]}")
    return df


def unmatched(df: DataFrame, ref: DataFrame, key: Sequence[str], value: str, over: float = 0.0) -> DataFrame:
    """Keys without a partner whose total is over the limit: (key, rows, total)."""
    out = df.join(ref, list(key), "left_anti").groupBy(*key).agg(F.count("*").alias("rows"), F.round(F.sum(value), 2).alias("total"))
    return out.filter(F.col("total") > over)


def override(base: DataFrame, better: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of ``better``, and those of ``base`` whose key it lacks: a transcript replaces the compiled period."""
    return base.join(better.select(*key).distinct(), list(key), "left_anti").unionByName(better, allowMissingColumns=True)


def superseded(base: DataFrame, better: DataFrame, key: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """(key, rows, differing): keys that both tables hold, how many rows of the base they replace and how many of its values change.

    Rows meet on the key and all columns beside the fields; a row that the better table lacks counts with all its fields.
    """
    rest = [c for c in base.columns if c not in fields]
    a = base.join(better.select(*key).distinct(), list(key), "left_semi")
    b = better.select(*rest, F.struct(*fields).alias("_b"))
    changed = sum((F.when(F.col(f).eqNullSafe(F.col(f"_b.{f}")), 0).otherwise(1) for f in fields), F.lit(0))
    return a.join(b, rest, "left").groupBy(*key).agg(F.count("*").alias("rows"), F.sum(changed).alias("differing"))


def flag_rows(df: DataFrame, id_col: str, allowed: Sequence[int], date: str, sentinels: Sequence[str], flag: str = "volatile_sentinel") -> DataFrame:
    """Adds ``valid`` (the id is one of those allowed; null is not) and ``date_flag`` (the flag on dates that stand for no day)."""
    marked = F.when(F.col(date).isin(*[F.lit(s).cast("date") for s in sentinels]), flag)
    return df.withColumns({"valid": F.coalesce(F.col(id_col).isin(*allowed), F.lit(False)), "date_flag": marked})


def apply_fixes(df: DataFrame, fixes: DataFrame, key: Sequence[str], value: str) -> DataFrame:
    """Values of listed cells replaced; ``fixed`` marks them."""
    out = df.join(fixes.select(*key, F.col(value).alias("_fix")), list(key), "left")
    return out.withColumn("fixed", F.col("_fix").isNotNull()).withColumn(value, F.coalesce("_fix", value)).drop("_fix")


def holes(df: DataFrame, periods: DataFrame, units: DataFrame, columns: Sequence[str], key: tuple[str, str]) -> DataFrame:
    """(period, unit, column) of the full grid for which there is no value. Three small key sets make the grid."""
    grid = periods.crossJoin(units).withColumn("column", F.explode(F.array(*[F.lit(c) for c in columns])))
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]))
    have = df.select(*key, cells.alias("x")).select(*key, "x.column", "x.value").filter("value is not null")
    return grid.join(have, [*key, "column"], "left_anti")


def checksum_audit(cells: DataFrame, constraints: DataFrame) -> DataFrame:
    """Constraints that do not hold: (sheet, constraint, members, total, delta).

    ``cells`` is (sheet, row, col, value); ``constraints`` is (constraint, role member|total, row, col). A constraint with a
    missing cell is not judged.
    """
    rows = constraints.crossJoin(cells.select("sheet").distinct()).join(cells, ["sheet", "row", "col"], "left")
    member, total = F.col("role") == "member", F.col("role") == "total"
    per = rows.groupBy("sheet", "constraint").agg(F.sum(F.when(member, F.col("value"))).alias("members"), F.max(F.when(total, F.col("value"))).alias("total"), F.count_if(F.col("value").isNull()).alias("_gaps"))
    return per.filter((F.col("_gaps") == 0) & (F.col("members") != F.col("total"))).select("sheet", "constraint", "members", "total", (F.col("members") - F.col("total")).alias("delta"))


def deduce_missing(cells: DataFrame, constraints: DataFrame) -> DataFrame:
    """Fills cells that a constraint determines alone, until no constraint does; a negative value is refused.

    ``cells`` is (sheet, row, col, value); cells of a constraint that are null or absent are holes, filled ones of either kind come out,
    marked by ``deduced``. All constraints are judged at once in a round; where two disagree about a cell, the first by name counts.
    Of repeated cells the largest value counts. What is known of a constraint is a sum over its known cells, so a round adds the
    cells of the last one and judges only the constraints that hold them.
    """
    sign = F.when(F.col("role") == "total", -1).otherwise(1).alias("sign")
    rules = durable(constraints.select("constraint", "row", "col", sign, F.xxhash64("row", "col").alias("code")))
    terms = durable(rules.groupBy("constraint").agg(F.count("*").alias("terms"), F.bit_xor("code").alias("all")))
    cells = cells.groupBy("sheet", "row", "col").agg(F.max("value").alias("value"))

    def told(known: DataFrame) -> DataFrame:
        """What known cells (sheet, row, col, value) add to each of their constraints."""
        rows = known.join(rules, ["row", "col"])
        return rows.groupBy("sheet", "constraint").agg(F.count("*").alias("n"), F.sum(F.col("sign") * F.col("value")).alias("balance"), F.bit_xor("code").alias("code"))

    def state(parts: DataFrame) -> DataFrame:
        """(sheet, constraint, balance, gaps, n, code): constraints with a hole; ``code`` is that of the known cells."""
        sums = parts.groupBy("sheet", "constraint").agg(F.sum("n").alias("n"), F.sum("balance").alias("balance"), F.bit_xor("code").alias("code"))
        return sums.join(terms, "constraint").withColumn("gaps", F.col("terms") - F.col("n")).filter("gaps > 0")

    opened = durable(state(told(cells.filter("value is not null"))))
    ledger = opened.select("sheet", "constraint", "n", "balance", "code")
    touched, found = opened, None
    while True:
        # the codes of all cells but the known ones leave that of the hole
        ready = touched.filter("gaps = 1").withColumn("code", F.col("code").bitwiseXOR(F.col("all")))
        solved = ready.join(rules, ["constraint", "code"]).withColumn("value", -F.col("sign") * F.col("balance")).filter("value >= 0")
        fills = durable(solved.groupBy("sheet", "row", "col").agg(F.min_by("value", "constraint").alias("value")))
        if fills.isEmpty():
            break
        found = fills if found is None else found.unionByName(fills)
        more = durable(told(fills))
        ledger = ledger.unionByName(more)
        touched = durable(state(ledger.join(more.select("sheet", "constraint"), ["sheet", "constraint"], "left_semi")))
    if found is None:
        return cells.withColumn("deduced", F.lit(False))
    out = cells.join(found.withColumnRenamed("value", "_v"), ["sheet", "row", "col"], "full")
    return out.select("sheet", "row", "col", F.coalesce("value", "_v").alias("value"), (F.col("value").isNull() & F.col("_v").isNotNull()).alias("deduced"))


class _Sheet:
    """A sheet's cells, and for each constraint its number of holes and its balance (members less total) over the known cells."""

    def __init__(self, terms: list[dict], values: dict):
        self.terms, self.values = terms, values
        self.of: dict = {}
        for k, part in enumerate(terms):
            for cell in part:
                self.of.setdefault(cell, []).append(k)
        self.holes = [sum(values.get(c) is None for c in part) for part in terms]
        self.balance = [sum(s * (values.get(c) or 0) for c, s in part.items()) for part in terms]

    def put(self, cell, value: int) -> None:
        before = self.values.get(cell)
        for k in self.of.get(cell, ()):
            self.holes[k] -= before is None
            self.balance[k] += self.terms[k][cell] * (value - (before or 0))
        self.values[cell] = value

    def implied(self, k: int, cell) -> int:
        """The value by which constraint ``k`` would balance, its other cells being known."""
        sign = self.terms[k][cell]
        return (self.values.get(cell) or 0) - sign * self.balance[k]

    def deduce(self, todo: list[int]) -> None:
        """Fills what constraints determine alone, beginning with those of ``todo`` and going on with those of each filled cell."""
        while todo:
            later: list[int] = []
            for k in todo:
                if self.holes[k] == 1:
                    cell = next(c for c in self.terms[k] if self.values.get(c) is None)
                    if (value := self.implied(k, cell)) >= 0:
                        self.put(cell, value)
                        later += self.of[cell]
            todo = sorted(set(later))

    def broken(self) -> list[int]:
        return [k for k, b in enumerate(self.balance) if b and not self.holes[k]]

    def step(self, unsure: set) -> tuple | None:
        """(cell, value): the change of an unsure cell of a broken constraint by which the residual of all known constraints falls most; the smaller change on a tie."""
        best = (0, 0, None)
        for cell in dict.fromkeys(c for k in self.broken() for c in self.terms[k] if c in unsure):
            now = self.values[cell]
            for value in sorted({self.implied(k, cell) for k in self.of[cell] if not self.holes[k]}):
                if value >= 0 and value != now:
                    fall = sum(abs(self.balance[k] + self.terms[k][cell] * (value - now)) - abs(self.balance[k]) for k in self.of[cell] if not self.holes[k])
                    if fall < 0 and (fall, abs(value - now)) < best[:2]:
                        best = (fall, abs(value - now), (cell, value))
        return best[2]

    def repair(self, unsure: set, most: int) -> None:
        """Deduces, then changes one unsure cell after the other, each once, deducing in between; changes that do not make all known constraints balance are undone."""
        self.deduce(list(range(len(self.terms))))
        deduced, left = dict(self.values), set(unsure)
        for _ in range(most):
            change = self.step(left)
            if change is None:
                break
            self.put(*change)
            left.discard(change[0])
            self.deduce(self.of[change[0]])
        if self.broken():
            self.__init__(self.terms, deduced)


def reconcile_sheets(cells: DataFrame, constraints: DataFrame, most: int = 12) -> DataFrame:
    """(sheet, row, col, read, value, clean): cells after deduction and repair; ``clean`` sheets have no hole and no broken constraint.

    Holes are filled where constraints determine them. If some still do not balance, cells whose ``sure`` is not true are changed, at most
    ``most`` of them and each once; unless everything that is known balances then, a sheet keeps its deductions only. Without a
    column ``sure`` all cells count as sure. Cells that a constraint names and a sheet lacks are holes; cells without a constraint
    pass; of repeated cells the largest value counts. A sheet is small by nature and is reconciled by one call; sheets are dealt to tasks.
    """
    by_name: dict = {}
    for r in constraints.collect():
        part = by_name.setdefault(r["constraint"], {})
        part[r["row"], r["col"]] = part.get((r["row"], r["col"]), 0) + (-1 if r["role"] == "total" else 1)
    terms = [dict(sorted(by_name[name].items())) for name in sorted(by_name)]
    named = list(dict.fromkeys(c for part in terms for c in part))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        read: dict = dict.fromkeys(named)
        sure = set()
        for r, c, v, s in zip(pdf["row"], pdf["col"], pdf["value"], pdf["sure"], strict=True):
            read[r, c] = max((x for x in (read.get((r, c)), None if pd.isna(v) else int(v)) if x is not None), default=None)
            if s and not pd.isna(v):
                sure.add((r, c))
        sheet = _Sheet(terms, dict(read))
        sheet.repair({c for c in named if c not in sure}, most)
        clean = not sheet.broken() and not any(sheet.holes)
        rows = [(pdf["sheet"].iloc[0], *cell, v, sheet.values[cell], clean) for cell, v in read.items()]
        return pd.DataFrame(rows, columns=["sheet", "row", "col", "read", "value", "clean"]).astype({"read": "Int64", "value": "Int64"})

    kinds = dict(cells.dtypes)
    known = F.coalesce("sure", F.lit(False)) if "sure" in kinds else F.lit(True)
    rows = cells.select("sheet", "row", "col", F.col("value").cast("long").alias("value"), known.alias("sure"))
    return rows.groupBy("sheet").applyInPandas(run, f"sheet {kinds['sheet']}, row {kinds['row']}, col {kinds['col']}, read long, value long, clean boolean")


def repair_sheets(cells: DataFrame, constraints: DataFrame, most: int = 12) -> DataFrame:
    """(sheet, row, col, before, after): cells that ``reconcile_sheets`` filled (before is null) or changed."""
    rows = reconcile_sheets(cells, constraints, most).filter(~F.col("read").eqNullSafe(F.col("value")))
    return rows.select("sheet", "row", "col", F.col("read").alias("before"), F.col("value").alias("after"))


def total_row_audit(rows: DataFrame, totals: DataFrame, period: str, columns: Sequence[str]) -> DataFrame:
    """(period, column, computed, printed, delta): column sums of the units that differ from the printed total row."""
    sums = rows.groupBy(period).agg(*[F.sum(c).alias(c) for c in columns])
    long = lambda df, name: df.select(period, F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias(name)) for c in columns])).alias("x")).select(period, "x.*")
    both = long(sums, "computed").join(long(totals, "printed"), [period, "column"])
    return both.withColumn("delta", F.round(F.col("computed") - F.col("printed"), 4)).filter("delta <> 0")


def profile_anomalies(df: DataFrame, period: str, unit: str, columns: Sequence[str], ratio: float = 6.0, weight: float = 0.01) -> DataFrame:
    """Cells whose share of their row is far from the column's upper median share: (period, unit, column, share, usual)."""
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in columns]))
    long = df.select(period, unit, cells.alias("x")).select(period, unit, "x.*")
    share = F.try_divide(F.col("v"), F.sum("v").over(Window.partitionBy(period, unit)))
    long = long.withColumn("share", share).filter("share is not null")
    usual = quantile(long, [unit, "column"], "share", 0.5, "upper", "usual")
    odd = (F.col("usual") >= weight) & ((F.col("share") > ratio * F.col("usual")) | (F.col("share") < F.col("usual") / ratio))
    return long.join(usual, [unit, "column"]).filter(odd).select(period, unit, "column", F.round("share", 6).alias("share"), F.round("usual", 6).alias("usual"))


def reconcile(parts: DataFrame, control: DataFrame, key: Sequence[str], value: str, tolerance: float = 0.02) -> DataFrame:
    """(key, parts, control, residual, bad): sums against their control; bad if negative or over the tolerance."""
    a = parts.groupBy(*key).agg(F.sum(value).alias("parts"))
    b = control.groupBy(*key).agg(F.sum(value).alias("control"))
    rest = F.coalesce("control", F.lit(0)) - F.coalesce("parts", F.lit(0))
    out = a.join(b, list(key), "full").withColumn("residual", rest)
    return out.withColumn("bad", (rest < 0) | (rest > tolerance * F.coalesce("control", F.lit(0))))


def crosscheck_months(daily: DataFrame, months: DataFrame, value: str, known: Sequence[str] = ()) -> DataFrame:
    """(month, days, stated, diff): months whose daily sum is not the stated total, but for known ones."""
    sums = daily.groupBy(F.date_format("date", "yyyy-MM").alias("month")).agg(F.sum(value).alias("days"))
    out = months.join(sums, "month", "left").withColumn("diff", F.coalesce("days", F.lit(0)) - F.col("stated"))
    return out.filter((F.col("diff") != 0) & ~F.col("month").isin(*known) if known else F.col("diff") != 0).select("month", "days", "stated", "diff")


def derive_slice(whole: DataFrame, others: DataFrame, key: Sequence[str], value: str, allowed: float = 0.0001) -> DataFrame:
    """The whole minus the other slices, not below 0; raises if more than ``allowed`` of the keys are negative."""
    signed = whole.select(*key, F.col(value).alias("_v")).unionByName(others.select(*key, (-F.col(value)).alias("_v")))
    out = signed.groupBy(*key).agg(F.sum("_v").alias("_v"))
    share = out.agg(F.try_divide(F.count_if(F.col("_v") < 0), F.count("*"))).first()[0] or 0.0
    if share > allowed:
        raise ReferenceError_(f"{share:.4%} of the derived cells are negative")
    return out.select(*key, F.greatest("_v", F.lit(0)).alias(value)).filter(F.col(value) > 0)


def dataset_diff(stored: DataFrame, fresh: DataFrame, key: Sequence[str], value: str) -> DataFrame:
    """(key, stored, fresh) of the cells that differ in either direction, null for a cell that one side lacks."""
    a, b = stored.select(*key, F.col(value).alias("stored")), fresh.select(*key, F.col(value).alias("fresh"))
    return a.join(b, list(key), "full").filter(~F.col("stored").eqNullSafe(F.col("fresh")))


def unstable_keys(seen: DataFrame, key: Sequence[str], value: str, volatile: DataFrame | None = None) -> DataFrame:
    """(key, values): keys whose value changed over repeated observations, declared volatile ones left out."""
    out = seen.groupBy(*key).agg(F.count_distinct(value).alias("values")).filter(F.col("values") > 1)
    return out.join(volatile, list(key), "left_anti") if volatile is not None else out


def missing_days(have: DataFrame, spine: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, date) of the spine without a row; with ``by``, of every group that occurs."""
    grid = have.select(*by).distinct().crossJoin(spine) if by else spine
    return grid.join(have.select(*by, "date").distinct(), [*by, "date"], "left_anti")


def dead_periods(log: DataFrame, control: DataFrame, by: Sequence[str] = (), period: str = "date") -> DataFrame:
    """(by, period): periods that were fetched but for which the control series has no count above 0, per slice with ``by``."""
    return log.select(*by, period).distinct().join(control.filter("n > 0").select(*by, period), [*by, period], "left_anti")


def log_gap(log: DataFrame, facts: DataFrame, key: Column, names: Sequence[str]) -> DataFrame:
    """(names, rows): fetches logged with rows whose facts are absent; names are parsed from the log's key at '|'."""
    parts = F.split(key, r"\|")
    want = log.filter("rows > 0").select(*[F.get(parts, F.lit(k)).alias(n) for k, n in enumerate(names)], "rows")
    return want.join(facts.select(*[F.col(n).cast("string").alias(n) for n in names]).distinct(), list(names), "left_anti")


def month_spans(spans: DataFrame, start: str = "date_from", end: str = "date_to") -> DataFrame:
    """Spans that are exactly one calendar month."""
    return spans.filter((F.col(start) == F.to_date(F.trunc(start, "month"))) & (F.col(end) == F.last_day(start)))
