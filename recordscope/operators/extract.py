"""Values from page fragments, report texts and sheets of cells, without row-wise Python."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordscope.functions.dates import parse_dmy
from recordscope.functions.text import squeeze, tolerant_number

# Entities in the order in which pages are decoded; blanks and quotes come after the ampersand, which may hide them.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"), ("&nbsp;", " "), ("&#39;", "'"), ("&quot;", '"'))


def cell_text(c: Column) -> Column:
    """Text of a table cell: tags become spaces, entities are decoded in their order, white space is squeezed, a trailing comma goes."""
    t = F.regexp_replace(c, "<[^>]*>", " ")
    for entity, to in ENTITIES:
        t = F.replace(t, F.lit(entity), F.lit(to))
    return F.regexp_replace(squeeze(t), r"\s*,$", "")


def html_rows(df: DataFrame, html: str) -> DataFrame:
    """One row for each <tr> with cells: the other columns, row_no and the array of cell texts. Null pages give none."""
    rows = F.regexp_extract_all(html, F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), F.lit(1))
    cells = lambda r: F.transform(F.regexp_extract_all(r, F.lit(r"(?is)<td\b[^>]*>(.*?)</td>"), F.lit(1)), cell_text)
    out = df.select(*[c for c in df.columns if c != html], F.posexplode(rows).alias("row_no", "_r"))
    return out.withColumn("cells", cells(F.col("_r"))).drop("_r").filter(F.size("cells") > 0)


def broken_lines(c: Column) -> Column:
    """Parts of a raw cell between its line breaks, cleaned."""
    return F.transform(F.split(c, r"(?i)<br\s*/?>"), cell_text)


def text_in(k: int) -> Callable[[Column], Column]:
    return lambda cells: F.get(cells, F.lit(k))


def number_in(k: int) -> Callable[[Column], Column]:
    return lambda cells: tolerant_number(F.get(cells, F.lit(k))).cast("long")


def date_in(k: int) -> Callable[[Column], Column]:
    return lambda cells: parse_dmy(F.get(cells, F.lit(k)))


def map_cells(rows: DataFrame, fields: Mapping[str, Callable[[Column], Column]]) -> DataFrame:
    """Adds named fields read from the cells of a row; missing cells give null."""
    return rows.withColumns({name: read(F.col("cells")) for name, read in fields.items()})


def extract_fields(df: DataFrame, text: str, patterns: Mapping[str, str | Sequence[str]]) -> DataFrame:
    """Adds a number for each field: the first group of the first of its patterns that matches; null without a match."""
    def first(ps: str | Sequence[str]) -> Column:
        return F.coalesce(*[tolerant_number(F.nullif(F.regexp_extract(text, p, 1), F.lit(""))) for p in ([ps] if isinstance(ps, str) else ps)])

    return df.withColumns({name: first(ps) for name, ps in patterns.items()})


def label_by_following_total(df: DataFrame, doc: str, pos: str, label: str, pattern: str = r"^(.*\S)\s+Area Total$", grand: str = r"(?i)^grand total", block: int = 10_000) -> DataFrame:
    """Adds ``zone``: the name in the next subtotal line at or after a row; a grand total line ends the search before it.

    A document is cut into blocks of positions: rows look ahead inside their block, and take what the next block with a total
    begins with otherwise, so a very long document is no single window.
    """
    zone = F.nullif(F.regexp_extract(label, pattern, 1), F.lit(""))
    event = F.when(zone.isNotNull() | F.col(label).rlike(grand), F.struct(zone.alias("zone")))
    rows = df.withColumn("_e", event).withColumn("_b", F.floor(F.col(pos) / block))
    inside = Window.partitionBy(doc, "_b").orderBy(pos).rowsBetween(0, Window.unboundedFollowing)
    heads = rows.groupBy(doc, "_b").agg(F.min_by("_e", F.when(F.col("_e").isNotNull(), F.col(pos))).alias("_h"))
    later = Window.partitionBy(doc).orderBy("_b").rowsBetween(1, Window.unboundedFollowing)
    carried = heads.select(doc, "_b", F.first("_h", ignorenulls=True).over(later).alias("_n"))
    found = rows.withColumn("_f", F.first("_e", ignorenulls=True).over(inside)).join(carried, [doc, "_b"])
    return found.select(*df.columns, F.coalesce("_f", "_n")["zone"].alias("zone"))


def unpack_groups(df: DataFrame, cells: str, names: Sequence[str]) -> DataFrame:
    """A row of repeating column groups becomes one row a group; groups without a first cell go."""
    width = len(names)
    groups = F.transform(F.sequence(F.lit(0), F.floor((F.size(cells) - 1) / width).cast("int")), lambda g: F.slice(cells, g * width + 1, width))
    out = df.select(*[c for c in df.columns if c != cells], F.posexplode(groups).alias("group", "_g"))
    return out.select("*", *[F.get("_g", F.lit(k)).alias(n) for k, n in enumerate(names)]).drop("_g").filter(F.coalesce(F.col(names[0]), F.lit("")) != "")


def value_right_of(cells: DataFrame, pattern: str, within: int) -> DataFrame:
    """(doc, row, col, label, value): the first number at most ``within`` cells right of each label cell, by equality on the row."""
    label = cells.filter(F.col("text").rlike(pattern)).select("doc", "row", F.col("col").alias("at"), F.col("text").alias("label"))
    number = cells.select("doc", "row", "col", tolerant_number(F.when(F.col("text").rlike(r"^\s*-?[0-9০-৯.,]+\s*$"), F.col("text"))).alias("value")).filter("value is not null")
    near = label.join(number, ["doc", "row"]).filter(F.col("col").between(F.col("at") + 1, F.col("at") + within))
    return near.groupBy("doc", "row", F.col("at").alias("col"), "label").agg(F.min_by("value", "col").alias("value"))


def rows_under_header(cells: DataFrame, labels: Mapping[str, str], needed: int = 2) -> DataFrame:
    """(doc, row, one text column a label): the header is the first row in which ``needed`` labels match; columns follow it.

    A header's columns are found by two aggregates; cells meet them by sorted shuffles, since there is a header for each sheet.
    """
    which = F.coalesce(*[F.when(F.col("text").rlike(p), F.lit(name)) for name, p in labels.items()])
    named = cells.withColumn("field", which).filter("field is not null")
    at = named.groupBy("doc", "row").agg(*[F.min(F.when(F.col("field") == name, F.struct("col"))).alias(f"_{k}") for k, name in enumerate(labels)])
    found = F.array(*[F.struct(F.lit(name).alias("field"), F.col(f"_{k}").alias("at")) for k, name in enumerate(labels)])
    heads = at.select("doc", "row", F.filter(found, lambda x: x["at"].isNotNull()).alias("_c")).filter((F.size("_c") >= needed) & F.col("row").isNotNull())
    columns = heads.groupBy("doc").agg(F.min(F.struct("row", "_c")).alias("_h")).select("doc", F.col("_h.row").alias("head"), F.inline("_h._c")).select("doc", "head", "field", F.col("at.col").alias("col"))
    below = cells.join(columns.hint("merge"), ["doc", "col"]).filter(F.col("row") > F.col("head"))
    return below.groupBy("doc", "row").pivot("field", list(labels)).agg(F.first("text"))


def sheet_date(cells: DataFrame, top: int = 6, within: int = 4) -> DataFrame:
    """(doc, date): the first date right of a 'Date' label, else the first date in the top rows; several spellings.

    Cells are read once; only labels and cells that may hold a date go on. A date looks back in its row for the nearest label.
    """
    said = F.col("text")
    may = said.rlike(r"\d[-/.]")  # in every spelling a digit stands before one of these
    date = F.coalesce(*[F.try_to_date(F.nullif(F.regexp_extract(said, p, 0), F.lit("")), f) for p, f in ((r"\d{1,2}-\d{1,2}-\d{4}", "d-M-yyyy"), (r"\d{1,2}/\d{1,2}/\d{4}", "d/M/yyyy"), (r"\d{4}-\d{2}-\d{2}", "yyyy-MM-dd"), (r"\d{1,2}\.\d{1,2}\.\d{4}", "d.M.yyyy"))], parse_dmy(said))
    label = said.rlike(r"(?i)^\s*date\b")
    few = cells.filter(may | label).select("doc", "row", "col", F.when(may, date).alias("date"), F.when(label, F.col("col")).alias("at")).filter("date is not null or at is not null")
    nearest = F.max("at").over(Window.partitionBy("doc", "row").orderBy("col").rangeBetween(Window.unboundedPreceding, Window.currentRow))
    beside = F.coalesce((F.col("col") <= F.col("_at") + within) & F.col("doc").isNotNull() & F.col("row").isNotNull(), F.lit(False))
    dated = few.withColumn("_at", nearest).filter("date is not null").select("doc", F.when(beside, 0).when(F.col("row") < top, 1).alias("rank"), "row", "col", "date")
    return dated.filter("rank is not null").groupBy("doc").agg(F.min_by("date", F.struct("rank", "row", "col")).alias("date"))


def table_lines(lines: DataFrame, header: str, total: str) -> DataFrame:
    """(doc, line, label, fiscal_year, value) of printed tables (doc, line, text).

    The last line with ``header`` marks above a line names its columns; numbers are aligned with them from the right, the rest
    of the line is the label; lines that match ``total`` or hold fewer numbers than columns are left out.
    """
    marks = F.regexp_extract_all("text", F.lit(f"({header})"), F.lit(1))
    w = Window.partitionBy("doc").orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    rows = lines.withColumn("_m", F.when(F.size(marks) > 0, marks)).withColumn("_h", F.last("_m", ignorenulls=True).over(w)).filter("_m is null and _h is not null")
    tail = F.regexp_extract("text", r"((?:\s+-?[0-9][0-9,.]*)+)\s*$", 1)
    rows = rows.withColumn("_n", F.filter(F.split(F.trim(tail), r"\s+"), lambda x: x != "")).withColumn("label", F.trim(F.regexp_replace("text", r"(?:\s+-?[0-9][0-9,.]*)+\s*$", "")))
    rows = rows.filter((F.size("_n") >= F.size("_h")) & ~F.col("label").rlike(total))
    last = F.slice("_n", F.size("_n") - F.size("_h") + 1, F.size("_h"))
    return rows.select("doc", "line", "label", F.explode(F.arrays_zip(F.col("_h").alias("fiscal_year"), last.alias("v"))).alias("x")).select("doc", "line", "label", F.col("x.fiscal_year").alias("fiscal_year"), tolerant_number(F.col("x.v")).alias("value"))


#: Layouts of published row fragments: field -> (cell, line in the cell, pattern or None); line -1 is the cell's last line. A
#: pattern's first group is the value.
LAYOUTS: dict[str, dict[str, tuple[int, int, str | None]]] = {
    "awards": {
        "tender_id": (2, 0, r"^([^,]+)"), "package_ref": (2, 0, r"^[^,]+, (.*)$"), "description": (2, 1, None), "ministry": (1, 0, None), "division": (1, 1, None), "procuring_entity": (3, 0, None),
        "procurement_method": (3, 1, None), "district": (4, 0, None), "contract_signing_date": (5, 0, None), "awarded_to": (6, 0, None), "value_crore": (7, 0, None),
    },
    "tenders": {
        "tender_id": (1, 0, None), "package_ref": (1, 1, None), "status": (1, 2, None), "procurement_nature": (2, 0, None), "description": (2, 1, None), "ministry": (3, 0, None), "division": (3, 1, None),
        "organization": (3, 2, None), "procuring_entity": (3, 3, None), "procurement_type": (4, 0, None), "procurement_method": (4, 1, None), "publish_date": (5, 0, None), "close_date": (5, 1, None),
    },
    "experience": {
        "division": (1, 0, None), "organization": (1, 1, None), "procuring_entity": (1, -1, None), "procurement_nature": (2, 0, None), "procurement_type": (2, 1, None), "procurement_method": (2, 2, None),
        "tender_id": (3, 0, r"^(\d+),"), "title": (3, 0, r"^(?:\d+,\s*)?(.*)$"), "awarded_to": (4, 0, None), "company_unique_id": (5, 0, None), "experience_certificate_no": (6, 0, None), "contract_amount": (7, 0, None),
        "contract_start_date": (8, 0, None), "contract_end_date": (8, 1, None), "work_status": (9, 0, None),
    },
    "plan": {"ministry": (0, 0, None), "division": (1, 0, None), "organization": (2, 0, None), "project": (3, 0, None)},
    "plan_items": {
        "app_id": (1, 0, None), "app_code": (2, 0, None), "procurement_nature": (3, 0, None), "project_name": (3, 1, None), "package_no": (4, 0, None), "package_description": (4, 1, None), "estimated_cost": (5, 0, None), "planned_method": (5, 1, None),
    },
    "bans": {"company": (1, 0, None), "country": (2, 0, None), "address": (3, 0, None), "debarred_by": (4, 0, None), "period": (5, 0, None), "scope": (6, 0, None), "reason": (7, 0, None)},
}


def html_cells(df: DataFrame, html: str) -> DataFrame:
    """Like ``html_rows``, with each cell as the array of its non-empty lines between breaks."""
    rows = F.regexp_extract_all(html, F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), F.lit(1))
    lines = lambda c: F.filter(broken_lines(c), lambda x: x != "")
    cells = F.transform(F.regexp_extract_all(F.col("_r"), F.lit(r"(?is)<td\b[^>]*>(.*?)</td>"), F.lit(1)), lines)
    out = df.select(*[c for c in df.columns if c != html], F.posexplode(rows).alias("row_no", "_r"))
    return out.withColumn("cells", cells).drop("_r").filter(F.size("cells") > 0)


def parse_layout(rows: DataFrame, layout: dict[str, tuple[int, int, str | None]]) -> DataFrame:
    """Fields of a layout from ``html_cells`` rows; rows with too few cells are left out, missing lines are null."""
    def read(cell: int, line: int, pattern: str | None) -> Column:
        c = F.get("cells", F.lit(cell))
        text = F.get(c, F.lit(line) if line >= 0 else F.size(c) + line)
        return F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")) if pattern else text

    full = rows.filter(F.size("cells") > max(cell for cell, _, _ in layout.values()))
    return full.withColumns({name: read(*where) for name, where in layout.items()}).drop("cells")


def owner_table(df: DataFrame, html: str) -> DataFrame:
    """Adds ``owners``: (name, designation, share, country) structs of the table rows with four cells."""
    rows = F.regexp_extract_all(html, F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), F.lit(1))
    cells = F.transform(rows, lambda r: F.transform(F.regexp_extract_all(r, F.lit(r"(?is)<td\b[^>]*>(.*?)</td>"), F.lit(1)), cell_text))
    four = F.filter(cells, lambda c: F.size(c) >= 4)
    return df.withColumn("owners", F.transform(four, lambda c: F.struct(c[0].alias("name"), c[1].alias("designation"), c[2].alias("ownership_pct"), c[3].alias("country"))))


# Headings around the owners of an award's detail page; labels of the page, as patterns; field -> label of the cell before the value.
OWNER_BLOCK = ("Beneficial Ownership Information", "Business Address")
DETAIL_LABELS = {
    "tenderer_id": r"Tenderer ID of the Economic Operator[^:<]*",
    "business_address": r"Business Address of the Economic Operator",
    "budget_source": r"Budget and Source of Funds",
    "development_partner": r"Development Partner[^:<]*",
    "project_code": r"Project/Program Code[^:<]*",
    "project_name": r"Project/Program Name[^:<]*",
    "delivery_location": r"Location of Delivery/Works/Service Delivery",
}


def award_details(df: DataFrame, html: str, labels: Mapping[str, str] = DETAIL_LABELS, block: tuple[str, str] = OWNER_BLOCK) -> DataFrame:
    """Adds the labelled fields of a detail page (null where a label is missing) and ``beneficial_owners`` (name, designation, ownership_pct, country).

    Owners are the numbered rows of five cells between the two headings; rows without a name are left out.
    """
    value = lambda label: F.nullif(cell_text(F.regexp_extract(html, rf"(?s){label}:\s*</td>\s*<td[^>]*>([^<]*)", 1)), F.lit(""))
    part = F.regexp_extract(html, rf"(?s){block[0]}(.*?){block[1]}", 1)
    rows = F.regexp_extract_all(part, F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), F.lit(1))
    cells = F.transform(rows, lambda r: F.transform(F.regexp_extract_all(r, F.lit(r"(?is)<td\b[^>]*>(.*?)</td>"), F.lit(1)), cell_text))
    owners = F.filter(cells, lambda c: (F.size(c) >= 5) & F.get(c, F.lit(0)).rlike("^[0-9]+$") & ~F.lower(F.get(c, F.lit(1))).isin("", "name"))
    told = lambda c: F.struct(c[1].alias("name"), c[2].alias("designation"), F.nullif(c[3], F.lit("")).alias("ownership_pct"), c[4].alias("country"))
    return df.withColumns({name: value(label) for name, label in labels.items()}).withColumn("beneficial_owners", F.transform(owners, told))
