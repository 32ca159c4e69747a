"""Deduction, repair and the publishing gate against brute force and sheets whose answer is known."""

from __future__ import annotations

import itertools
import random

import pytest

from recordscope.operators import quality as ql
from recordscope.streaming import jobs

CELLS = "sheet string, row int, col int, value long"
RULES = "constraint string, role string, row int, col int"


def rules_of(spark, rows, cols):
    """Totals of rows in the last column and of columns in the last row."""
    out = [(f"row{r}", "total" if c == cols - 1 else "member", r, c) for r in range(rows) for c in range(cols)]
    out += [(f"col{c}", "total" if r == rows - 1 else "member", r, c) for c in range(cols) for r in range(rows)]
    return spark.createDataFrame(out, RULES), out


def full(rng, rows, cols):
    """A grid whose totals are right."""
    v = [[rng.randint(0, 9) for _ in range(cols - 1)] for _ in range(rows - 1)]
    v = [[*r, sum(r)] for r in v]
    v.append([sum(c) for c in zip(*v, strict=True)])
    return {(r, c): v[r][c] for r in range(rows) for c in range(cols)}


def brute_deduce(grid, rules):
    grid = dict(grid)
    by = {}
    for name, role, r, c in rules:
        by.setdefault(name, []).append(((r, c), -1 if role == "total" else 1))
    while True:
        found = {}
        for _, part in sorted(by.items()):
            gap = [(cell, s) for cell, s in part if grid.get(cell) is None]
            if len(gap) == 1:
                (cell, s), rest = gap[0], sum(s * grid[c] for c, s in part if grid.get(c) is not None)
                if -s * rest >= 0:
                    found.setdefault(cell, -s * rest)
        if not found:
            return grid
        grid |= found


def test_deduction_reaches_the_end(spark):
    rng = random.Random(4)
    rules, plain = rules_of(spark, 6, 6)
    sheets = {}
    for k in range(40):
        grid = full(rng, 6, 6)
        for cell in rng.sample(sorted(grid), rng.randint(0, 22)):
            grid[cell] = None
        if k % 4 == 0:  # inconsistent sheets, with refused negative values
            grid[rng.randrange(6), 5] = 1
        sheets[f"s{k}"] = grid
    chain = full(rng, 6, 6)
    for k in range(5):
        chain[k, k] = chain[k, k + 1] = None
    sheets["chain"] = chain
    # a hole is a null or no row at all; repeated cells count once
    rows = [(s, r, c, v) for s, grid in sheets.items() for (r, c), v in grid.items() if v is not None or r % 2]
    got = ql.deduce_missing(spark.createDataFrame([*rows, *rows[:5]], CELLS), rules).collect()
    assert len(got) == len({(r["sheet"], r["row"], r["col"]) for r in got})
    seen = {(r["sheet"], r["row"], r["col"]): r["value"] for r in got}
    for s, grid in sheets.items():
        want = brute_deduce(grid, plain)
        assert {c: seen.get((s, *c)) for c in want} == want
    assert all(r["deduced"] == (sheets[r["sheet"]][r["row"], r["col"]] is None and r["value"] is not None) for r in got)
    assert None not in {v for (s, *_), v in seen.items() if s == "chain"}
    assert ql.deduce_missing(spark.createDataFrame([], CELLS), rules).count() == 0


def repaired(spark, rows, rules, **options):
    cells = spark.createDataFrame(rows, f"{CELLS}, sure boolean")
    return sorted(tuple(r) for r in ql.repair_sheets(cells, rules, **options).collect())


def test_a_hole_is_no_misread(spark):
    rules = spark.createDataFrame([("r", "member", 0, 0), ("r", "member", 0, 1), ("r", "total", 0, 2)], RULES)
    assert repaired(spark, [("s", 0, 0, 3, False), ("s", 0, 1, None, False), ("s", 0, 2, 8, True)], rules) == [("s", 0, 1, None, 5)]
    # the deduction would be negative, so nothing is filled and nothing changed
    assert repaired(spark, [("s", 0, 0, 9, False), ("s", 0, 1, None, False), ("s", 0, 2, 8, True)], rules) == []


def test_two_misreads_of_one_constraint_and_sheets_to_leave_alone(spark):
    rng = random.Random(8)
    rules, _ = rules_of(spark, 5, 5)
    grid = full(rng, 5, 5)
    wrong = grid | {(1, 1): grid[1, 1] + 20, (1, 2): grid[1, 2] + 3}
    rows = [("two", r, c, v, (r, c) not in {(1, 1), (1, 2), (2, 2)}) for (r, c), v in wrong.items()]
    # a sure cell is wrong: changes of the others cannot mend it
    rows += [("left", r, c, v + (5 if (r, c) == (0, 0) else 0), r > 0) for (r, c), v in grid.items() if (r, c) != (3, 3)]
    rows = [(s, r, c, v, True if (s, r, c) == ("left", 0, 0) else ok) for s, r, c, v, ok in rows]
    got = repaired(spark, rows, rules)
    assert [x for x in got if x[0] == "two"] == [("two", 1, 1, grid[1, 1] + 20, grid[1, 1]), ("two", 1, 2, grid[1, 2] + 3, grid[1, 2])]
    # the hole is deduced (and stays), no cell that was read is changed
    assert [x[:4] for x in got if x[0] == "left"] == [("left", 3, 3, None)]
    done = {r["sheet"]: r["clean"] for r in ql.reconcile_sheets(spark.createDataFrame(rows, f"{CELLS}, sure boolean"), rules).collect()}
    assert done == {"two": True, "left": False}
    assert repaired(spark, rows, rules, most=1)[0][:4] == ("left", 3, 3, None) and len(repaired(spark, rows, rules, most=1)) == 1


def test_single_repairs_match_brute_force(spark):
    """One wrong cell among several doubtful ones: the only change of one doubtful cell that balances all is found."""
    rng = random.Random(2)
    rules, plain = rules_of(spark, 4, 4)
    by = {}
    for name, role, r, c in plain:
        by.setdefault(name, []).append(((r, c), -1 if role == "total" else 1))
    rows, want = [], []
    for k in range(30):
        grid = full(rng, 4, 4)
        unsure = set(rng.sample(sorted(grid), 6))
        bad = rng.choice(sorted(unsure if k % 3 else set(grid) - unsure))
        read = grid | {bad: grid[bad] + rng.randint(1, 30)}
        rows += [(f"s{k}", r, c, v, (r, c) not in unsure) for (r, c), v in read.items()]
        for cell, value in itertools.product(unsure, range(max(read.values()) + 60)):
            trial = read | {cell: value}
            if value != read[cell] and all(sum(s * trial[c] for c, s in part) == 0 for part in by.values()):
                want.append((f"s{k}", *cell, read[cell], value))
    assert repaired(spark, rows, rules) == sorted(want) and 15 <= len(want) < 30


def stream_of(spark, path, schema, parts):
    for k, rows in enumerate(parts):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/{k}")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/*")


@pytest.mark.parametrize("fails", ["published", "review", "manifest"])
def test_gate_after_a_failure(spark, tmp_path, monkeypatch, fails):
    """Holes go to review or are filled; a job that dies at either table or before its entry gives the same two tables when run again."""
    rules = spark.createDataFrame([("r", "member", 0, 0), ("r", "member", 0, 1), ("r", "total", 0, 2)], RULES)
    sheet = lambda name, values: [(name, 0, c, v) for c, v in enumerate(values)]
    parts = [sheet("good", (1, 2, 3)) + sheet("hole", (1, None, 3)) + sheet("holes", (None, None, 3)), sheet("bad", (1, 2, 4)) + sheet("later", (5, 5, 10))]
    at = {x: str(tmp_path / x) for x in ("published", "review", "cp", "manifest")}
    run = lambda: jobs.gate_stream(stream, rules, at["published"], at["review"], at["cp"], at["manifest"])
    stream = stream_of(spark, str(tmp_path / "in"), CELLS, parts)
    from pyspark.sql import DataFrameWriter

    real = {"parquet": DataFrameWriter.parquet, "json": DataFrameWriter.json}

    def dies(kind):
        def write(self, path, *a, **b):
            if path.startswith(at[fails]):
                raise OSError("disk is gone")
            return real[kind](self, path, *a, **b)

        return write

    with monkeypatch.context() as m:
        m.setattr(DataFrameWriter, "parquet", dies("parquet"))
        m.setattr(DataFrameWriter, "json", dies("json"))
        with pytest.raises(Exception, match="disk is gone"):
            run().awaitTermination(120)
    schema = spark.createDataFrame([], CELLS).schema
    read = lambda name: sorted(tuple(r) for r in jobs.read_gated(spark, at["manifest"], name, schema).collect())
    assert read("published") == read("review") == []
    run().awaitTermination(120)
    assert read("published") == sorted(sheet("good", (1, 2, 3)) + sheet("hole", (1, 2, 3)) + sheet("later", (5, 5, 10)))
    assert sorted(r[0] for r in read("review")) == ["bad"] * 3 + ["holes"] * 3
    assert sorted(r["batch"] for r in jobs.committed(spark, at["manifest"]).collect()) == [0, 1]


def test_first_seen_over_batches_restarts_and_buckets(spark, tmp_path):
    schema = "id string, bucket string, at timestamp"
    at = lambda s: __import__("datetime").datetime.fromisoformat(s)
    parts = [[("a", "2024", at("2024-01-01 00:00:00")), ("b", "2024", at("2024-01-01 01:00:00")), ("a", "2024", at("2024-01-01 02:00:00"))]]
    folder, table, cp = (str(tmp_path / x) for x in ("in", "table", "cp"))
    # "a" comes again under another bucket, after a restart; "old" is beyond what is kept
    later = [[("a", "2025", at("2024-01-02 00:00:00")), ("c", "2025", at("2024-01-02 00:00:00"))], [("b", "unknown", at("2024-01-03 00:00:00")), ("d", "2024", at("2024-02-20 00:00:00"))], [("a", "2026", at("2024-02-20 01:00:00"))]]
    run = lambda: jobs.first_seen_stream(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*"), table, cp, ["id"], "at", "10 days", "bucket")
    for k, rows in enumerate(parts + later):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{k}")
        q = run()
        q.awaitTermination(120)
        assert q.exception() is None
    got = sorted((r["id"], str(r["bucket"])) for r in spark.read.parquet(table).collect())
    # by the last batch the watermark has passed the first "a" by ten days: its key has expired
    assert got == [("a", "2024"), ("a", "2026"), ("b", "2024"), ("c", "2025"), ("d", "2024")]
