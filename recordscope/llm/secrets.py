"""Secret scans with corpus-wide ownership, in DataFrame and SQL functions only.

Fixed patterns give the base spans; further patterns (provider tokens, web tokens, private key blocks) give candidates. The value of
every span is hashed, and the hash is counted over the whole corpus by distinct repositories and distinct owners: a value
under many owners or in many repositories is a copied example, a value of one or two owners that looks random is a live credential. Candidates of the
further patterns become spans when they are live; base spans stay, and their verdicts come beside them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordscope.llm.common import durable
from recordscope.llm.spans import find_spans, let, masked

BASE_KINDS = ("assign", "access", "hex")
ADDED_KINDS = ("provider", "webtoken", "keyblock")
KINDS = BASE_KINDS + ADDED_KINDS
# Fixed values of the base patterns.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]++"""
ASSIGN_VALUE = r"""^(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$"""
ACCESS = r"AKIA[A-Z0-9]{14,}+"
HEX = r"[0-9a-f]{16,}+"
#: Candidate patterns of the added kinds.
PROVIDER = r"(?<![A-Za-z0-9_-])(?:gh[pousr]_[A-Za-z0-9]{30,}+|xox[abprs]-[A-Za-z0-9-]{16,}+|sk_(?:live|test)_[A-Za-z0-9]{16,}+|AIza[A-Za-z0-9_-]{30,}+)"
WEBTOKEN = r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+"
KEYBLOCK = r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----[A-Za-z0-9+/=\s]++"
#: A value under more owners, or in more repositories, than this is a copied example.
LIVE_OWNERS = 2
LIVE_REPOSITORIES = 6
#: Distinct characters that a live value has at least, or fewer where a random value of its length and alphabet can have fewer.
LIVE_CHARS = 8
#: Chance that a random value is under the floor.
UNDER_FLOOR = 1e-6
#: Characters, and digits among them, that the rest of a value with a placeholder's sign must have to look random.
REST_CHARS = 10
REST_DIGITS = 2
#: Alphabets from small to large: pattern of a value and number of characters.
ALPHABETS = ((r"^[0-9]+$", 10), (r"^(?:[0-9a-f]+|[0-9A-F]+)$", 16), (None, 62))
#: Signs of a placeholder. They do not excuse the rest of a value: without them it is judged again.
PLACEHOLDER = r"(?i)example|sample|dummy|changeme|placeholder|your[_-]|xxxx|(.)\1{7}|0123456789|123456789|abcdef0123"


def _secret(kind: str, hit: Column) -> Column:
    return F.regexp_extract(hit, ASSIGN_VALUE, 1) if kind == "assign" else hit


def scan(text: Column) -> Column:
    """Array of (start, kind number, kind, end, value) of base spans and candidates, ordered by start, then kind as listed."""
    found = {
        "assign": find_spans(text, ASSIGN, lambda h: F.length(_secret("assign", h)) >= 12, text.rlike(r"(?i)passw|secret|token|api_?key")),
        "access": find_spans(text, ACCESS, only_if=F.contains(text, F.lit("AKIA"))),
        "hex": find_spans(text, HEX, only_if=text.rlike("[0-9a-f]{16}")),
        "provider": find_spans(text, PROVIDER, only_if=text.rlike(r"gh[pousr]_|xox[abprs]-|sk_|AIza")),
        "webtoken": find_spans(text, WEBTOKEN, only_if=F.contains(text, F.lit("eyJ"))),
        "keyblock": find_spans(text, KEYBLOCK, only_if=F.contains(text, F.lit("PRIVATE KEY"))),
    }
    one = lambda kind, n: lambda s: F.struct(s["start"].alias("start"), F.lit(n).alias("n"), F.lit(kind).alias("kind"), s["end"].alias("end"), _secret(kind, s["hit"]).alias("value"))
    return F.array_sort(F.concat(*[F.transform(found[k], one(k, n)) for n, k in enumerate(KINDS)]))


def floor_of(length: int, alphabet: int) -> int:
    """Most distinct characters, up to ``LIVE_CHARS``, that a random value has but for the chance ``UNDER_FLOOR``."""
    return max(k for k in range(1, LIVE_CHARS + 1) if k == 1 or math.comb(alphabet, k - 1) * ((k - 1) / alphabet) ** length <= UNDER_FLOOR)


def _floor(value: Column) -> Column:
    out = F.lit(LIVE_CHARS)
    for pattern, size in reversed(ALPHABETS):
        one = F.lit(LIVE_CHARS)
        for n in range(48, 0, -1):
            if floor_of(n, size) < floor_of(n + 1, size):
                one = F.when(F.length(value) <= n, floor_of(n, size)).otherwise(one)
        out = one if pattern is None else F.when(value.rlike(pattern), one).otherwise(out)
    return out


def looks_live(value: Column, kind: Column) -> Column:
    """Enough distinct characters, and a digit too but for assigned values and access keys; a value with signs of a placeholder must
    have a rest that looks random without them."""
    distinct = lambda v: F.size(F.array_distinct(F.split(v, "")))
    named = kind.isin("assign", "access")
    plain = (distinct(value) >= _floor(value)) & (named | value.rlike("[0-9]"))
    random = lambda rest: (F.length(rest) >= REST_CHARS) & (distinct(rest) >= LIVE_CHARS) & (F.length(F.regexp_replace(rest, "[^0-9]", "")) >= REST_DIGITS)
    return F.when(value.rlike(PLACEHOLDER), let(F.regexp_replace(value, PLACEHOLDER, ""), random)).otherwise(plain)


def find_secrets(docs: DataFrame, keep: tuple[str, ...] = (), **options) -> DataFrame:
    """(doc_id, ``keep`` columns, spans: array of (start, n, kind, end, repositories, owners, live)) for each row of ``docs``.

    ``spans`` holds all base spans, and candidates of the added kinds that are live. A value is live when it looks random and
    stands under few owners and in few repositories. Without columns of their own, a document's owner is its source and its
    repository source and language. A null text is empty; null owners and repositories count as one. Rows are told apart by
    place, not by id: repeated and null ids each get their row and their own spans. Repeated rows count as one owner. Only rows
    with a candidate are shuffled. ``options`` are the columns ``owner`` and ``repository`` and the bounds ``live_owners`` and
    ``live_repositories``.
    """
    return _found(docs, keep, **options).select("doc_id", *[F.col(f"keep_{c}").alias(c) for c in keep], "spans")


def _found(docs: DataFrame, keep: tuple[str, ...], repository: Column | None = None, owner: Column | None = None, live_owners: int = LIVE_OWNERS, live_repositories: int = LIVE_REPOSITORIES) -> DataFrame:
    """doc_id, the ``keep`` columns with keep_ before their names, spans."""
    owner = F.col("source") if owner is None else owner
    repository = F.concat_ws("/", F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit(""))) if repository is None else repository
    text = F.coalesce(F.col("text"), F.lit(""))
    kept = [F.col(c).alias(f"keep_{c}") for c in keep]
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), *kept, F.coalesce(owner, F.lit("")).alias("owner"), F.coalesce(repository, F.lit("")).alias("repository"), scan(text).alias("found"))
    hashed = F.transform("found", lambda s: F.struct(s["start"].alias("start"), s["n"].alias("n"), s["kind"].alias("kind"), s["end"].alias("end"), F.sha2(s["value"], 256).alias("hash"), looks_live(s["value"], s["kind"]).alias("random")))
    # written once: the rows keep their numbers, and texts are scanned a single time
    found = durable(rows.withColumn("found", hashed))
    each = found.select("row", "owner", "repository", F.explode("found").alias("s")).select("row", "owner", "repository", "s.*")
    # distinct counts in two steps: (hash, place) first, so that a value copied everywhere is merged before it meets itself
    places = each.groupBy("hash", "owner", "repository").agg(F.count("*").alias("times"))
    owners = places.groupBy("hash", "owner").agg(F.count("*").alias("r"))
    repositories = places.select("hash", "repository").distinct().groupBy("hash").agg(F.count("*").alias("repositories"))
    seen = owners.groupBy("hash").agg(F.count("*").alias("owners")).join(repositories, "hash")
    few = (F.col("owners") <= live_owners) & (F.col("repositories") <= live_repositories)
    judged = each.join(durable(seen), "hash").withColumn("live", F.col("random") & few)
    stay = judged.filter(F.col("live") | (F.col("n") < len(BASE_KINDS)))
    per_row = stay.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "n", "kind", "end", "repositories", "owners", "live"))).alias("spans"))
    none = F.array().cast("array<struct<start:int,n:int,kind:string,end:int,repositories:bigint,owners:bigint,live:boolean>>")
    columns = ["doc_id", *[f"keep_{c}" for c in keep]]
    some = found.filter(F.size("found") > 0).select("row", *columns).join(per_row, "row", "left").select(*columns, F.coalesce("spans", none).alias("spans"))
    return found.filter(F.size("found") == 0).select(*columns, none.alias("spans")).unionByName(some)


#: What every text with a candidate holds somewhere.
HINTS = r"(?i:passw|secret|token|api_?key|private key)|AKIA|[0-9a-f]{16}|gh[pousr]_|xox[abprs]-|sk_|AIza|eyJ"


def mask_secrets(docs: DataFrame, mark: str = "[SECRET]", **options) -> DataFrame:
    """The rows of ``docs`` with all their columns, live secrets in ``text`` replaced by ``mark``; ``n_chars``, if there, counts anew.

    Spans and verdicts follow from a text and the counts of the whole corpus, so rows take the spans of their text, whatever their
    ids; null texts stay null. Only texts that hold some hint of a secret are shuffled. ``options`` go to ``find_secrets``.
    """
    told = F.md5(F.col("text").cast("binary"))
    marked = _found(docs.withColumn("_text", told), ("_text",), **options)
    live = F.filter("spans", lambda s: s["live"])
    spans = durable(marked.select(F.col("keep__text").alias("_text"), live.alias("_live")).filter((F.size("_live") > 0) & F.col("_text").isNotNull()).dropDuplicates(["_text"]))
    hint = F.coalesce(F.col("text").rlike(HINTS), F.lit(False))
    some = docs.filter(hint).withColumn("_text", told).join(spans, "_text", "left")
    changed = F.col("_live").isNotNull()
    out = some.withColumn("text", F.when(changed, masked(F.col("text"), F.col("_live"), mark)).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(changed, F.length("text").cast(dict(docs.dtypes)["n_chars"])).otherwise(F.col("n_chars")))
    return docs.filter(~hint).unionByName(out.select(docs.columns))


def op9_secret_scan(spark, sf_dir: str) -> DataFrame:
    """Query: secrets in all ``documents``; ``ownership`` names each span's repositories and owners, ``live_spans`` the live ones."""
    found = find_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source"))
    place = lambda s: [s["kind"], s["start"].cast("string"), s["end"].cast("string")]
    said = lambda c, more=lambda s: []: F.array_join(F.transform(c, lambda s: F.concat_ws(":", *place(s), *more(s))), ",")
    base = F.filter("spans", lambda s: s["n"] < len(BASE_KINDS))
    of = lambda kind: lambda s: s["kind"] == kind
    counts = [F.size(F.filter("spans", of(k))).cast("long").alias(f"n_{k}") for k in BASE_KINDS]
    counted = said(F.col("spans"), lambda s: [s["repositories"].cast("string"), s["owners"].cast("string")])
    live = F.filter("spans", lambda s: s["live"])
    return found.select("doc_id", *counts, F.sha2(said(base), 256).alias("base_sha256"), said(F.col("spans")).alias("spans"), said(live).alias("live_spans"), counted.alias("ownership"))
