"""Text cleaning as Column functions: names, references, amounts, tags."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Legal forms, honorifics, scopes, reasons and causes of the published rules.
LEGAL_FORMS = r"\b(ltd|limited|pvt|private|co|company|m/s)\b"
HONORIFICS = r"^(md|mr|mrs|ms|dr|mohammad|mohammed|engr|eng)\.?\s+"
SCOPES = (
    ("e-GP Portal", 4, "Nationwide (e-GP Portal)"),
    ("Procuring Agency/Organization", 3, "Organization-wide"),
    ("Procuring Entity", 2, "Procuring Entity"),
    ("Project", 2, "Project"),
    ("Package", 1, "Package"),
    ("Single Tender", 1, "Single Tender"),
)
REASONS = (
    ("collusion", ("collusive", "collusion", "cartel")),
    ("forgery_false_document", ("forged", "forgery", "false document", "fake document", "fabricat")),
    ("fraud", ("fraud", "fraudulent")),
    ("corruption", ("corrupt", "bribe", "bribery")),
    ("non_performance", ("fail to perform", "non-performance", "failed to complete", "abandon")),
    ("misrepresentation", ("misrepresent", "false information", "false statement")),
)
CAUSES = (
    (r"gas\s*(shortage|short|crisis)|low\s*gas|gas\s*pressure|gas\s*\(rms\)|no\s*gas|gas\s*supply", "gas_shortage"),
    (r"liquid\s*fuel|fuel\s*shortage|hfo\s*shortage|no\s*fuel|oil\s*shortage", "fuel_shortage"),
    (r"overhaul|maintenance|outage|repair|inspection|shutdown|s/d|servicing", "maintenance"),
    (r"fault|trip|problem|damage|defect|breakdown|failure|leak", "fault"),
    (r"contract\s*expire|expired|decommission|retire|not\s*in\s*operation", "contract_ended"),
    (r"reserve|standby|stand\s*by|backing\s*down|low\s*demand|shut\s*down\s*for\s*low", "not_needed"),
)
# Digits of the reports' other script, and administrative words at the end of place names.
BENGALI_DIGITS = "০১২৩৪৫৬৭৮৯"
PLACE_SUFFIXES = r"(?i)\s*(জেলা|উপজেলা|থানা|সিটি কর্পোরেশন|district|upazila|thana|city corporation)\s*$"
# Spellings of one sound, replaced in this order when a name is reduced to its consonants.
SOUNDS = (
    ("ksh|kkh", "k"), ("chh|ch", "c"), ("sh|ss", "s"), ("kh", "k"), ("gh", "g"), ("jh", "j"), ("th", "t"), ("dh", "d"),
    ("ph", "f"), ("bh", "b"), ("zh", "j"), ("ng|nk", "n"), ("ee|ii", "i"), ("oo|uu", "u"),
    ("c|q", "k"), ("z", "j"), ("[vw]", "b"), ("x", "ks"), ("y", "i"), ("h", ""), ("[aeiou]", ""),
)


def squeeze(c: Column) -> Column:
    """Runs of white space become one space; both ends are trimmed."""
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def company_key(c: Column, least: int = 4) -> Column:
    """Lower-cased name without dots, commas and legal forms; '' for null and for keys shorter than ``least``."""
    key = squeeze(F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[.,]", ""), LEGAL_FORMS, ""))
    return F.when(F.length(key) >= least, key).otherwise(F.lit(""))


def owner_key(c: Column) -> Column:
    """Lower-cased, squeezed name without one leading honorific; '' for null."""
    return F.regexp_replace(squeeze(F.lower(F.coalesce(c, F.lit("")))), HONORIFICS, "")


def has_tokens(c: Column, least: int = 3) -> Column:
    return F.size(F.split(c, " ")) >= least


def reference_key(c: Column) -> Column:
    return F.lower(F.trim(F.coalesce(c, F.lit(""))))


def crore_to_units(c: Column) -> Column:
    """Text of crores -> amount rounded to 2 places; null if it is no number."""
    return F.round(c.try_cast("double") * 1e7, 2)


def amount(c: Column) -> Column:
    return F.round(F.regexp_replace(c, ",", "").try_cast("double"), 2)


def clean_ministry(c: Column) -> Column:
    """Name without a trailing ' and'."""
    return F.regexp_replace(F.trim(c), r"\s+and$", "")


def truncate_words(c: Column, n: int = 160) -> Column:
    """At most ``n`` characters, cut back to a word's end and marked with an ellipsis; shorter texts stay."""
    head = F.substring(c, 1, n)
    cut = F.when(F.contains(head, F.lit(" ")), F.regexp_replace(head, " [^ ]*$", "")).otherwise(head)
    return F.when(F.length(c) > n, F.concat(cut, F.lit("…"))).otherwise(c)


def western_digits(c: Column) -> Column:
    return F.translate(c, BENGALI_DIGITS, "0123456789")


def bengali_digits(c: Column) -> Column:
    return F.translate(c, "0123456789", BENGALI_DIGITS)


def tolerant_number(c: Column) -> Column:
    """First number in a text with either digits and thousands commas; null for blanks, dashes and N/A."""
    t = F.trim(F.regexp_replace(western_digits(c), ",", ""))
    return F.when(~t.isin("", "-", "--", "N/A", "n/a"), F.regexp_extract(t, r"-?\d+(?:\.\d+)?", 0).try_cast("double"))


def tags(c: Column, rules: Sequence[tuple[str, Sequence[str]]] = REASONS) -> Column:
    """All tags one of whose words occurs, in rule order; ['unspecified'] if none does."""
    low = F.lower(F.coalesce(c, F.lit("")))
    hit = F.array_compact(F.array(*[F.when(F.greatest(*[F.contains(low, F.lit(w)) for w in (*words, words[0])]), tag) for tag, words in rules]))
    return F.when(F.size(hit) > 0, hit).otherwise(F.array(F.lit("unspecified")))


def scope(text: Column, by: Column, rules: Sequence[tuple[str, int, str]] = SCOPES) -> Column:
    """STRUCT<score, label> of the first scope named in either text; (1, Unspecified) if none is."""
    low = F.lower(F.concat_ws(" ", F.coalesce(text, F.lit("")), F.coalesce(by, F.lit(""))))
    pair = lambda score, label: F.struct(F.lit(score).alias("score"), F.lit(label).alias("label"))
    out = pair(1, "Unspecified")
    for needle, score, label in reversed(rules):
        out = F.when(F.contains(low, F.lit(needle.lower())), pair(score, label)).otherwise(out)
    return out


def severity(score: Column, days: Column, repeats: Column) -> Column:
    """Four tiers from scope points, length (a year, two years) and repetition."""
    points = score + F.when(days >= 730, 2).when(days >= 365, 1).otherwise(0) + F.when(repeats > 1, 2).otherwise(0)
    return F.when(points >= 6, "critical").when(points >= 4, "high").when(points >= 2, "medium").otherwise("low")


def cause(c: Column, rules: Sequence[tuple[str, str]] = CAUSES) -> Column:
    """First matching class of a remark; 'none' for blanks, 'other' without a match."""
    t = F.lower(F.trim(F.coalesce(c, F.lit(""))))
    out = F.lit("other")
    for pattern, name in reversed(rules):
        out = F.when(t.rlike(pattern), name).otherwise(out)
    return F.when(t.isin("", "-", "--", "n/a"), "none").otherwise(out)


def place_name(c: Column) -> Column:
    """Place name without an administrative word at its end."""
    return F.trim(F.regexp_replace(c, PLACE_SUFFIXES, ""))


def address_tail(c: Column) -> Column:
    """Last part of an address after its commas, lower-cased; full stops and blanks at the end go first."""
    return F.lower(F.trim(F.element_at(F.split(F.regexp_replace(F.coalesce(c, F.lit("")), r"[.\s]+$", ""), ","), -1)))


def contains_either(q: str, *columns: Column) -> Column:
    """Whether ``q`` occurs in any of the columns, whatever the case."""
    return F.greatest(*[F.contains(F.lower(F.coalesce(c, F.lit(""))), F.lit(q.lower())) for c in (*columns, columns[0])])


def name_tokens(c: Column, stop: Sequence[str] = ()) -> Column:
    """Distinct lower-case words of over 2 letters: brackets dropped, joined words split at a capital, stop words out."""
    t = F.regexp_replace(F.coalesce(c, F.lit("")), r"\(.*?\)", " ")
    t = F.lower(F.regexp_replace(F.regexp_replace(t, "(?<=[a-z])(?=[A-Z])", " "), r"[^A-Za-z\s]", " "))
    words = F.filter(F.split(t, r"\s+"), lambda w: F.length(w) > 2)
    return F.array_distinct(F.array_except(words, F.array(*[F.lit(s) for s in stop])) if stop else words)


@lru_cache(maxsize=1)
def _folds() -> tuple[str, str]:
    """Small Latin letters with marks, and the letters that Unicode decomposes them to."""
    pairs = [(chr(k), unicodedata.normalize("NFKD", chr(k))[0]) for k in (*range(0xDF, 0x250), *range(0x1E00, 0x1F00))]
    pairs = [(x, to) for x, to in pairs if "a" <= to <= "z" and len(unicodedata.normalize("NFKD", x).rstrip("".join(map(chr, range(0x300, 0x370))))) == 1]
    return "".join(x for x, _ in pairs), "".join(to for _, to in pairs)


def unmarked(c: Column) -> Column:
    """Small Latin letters without their diacritics."""
    return F.translate(c, *_folds())


def phonetic(c: Column) -> Column:
    """Consonant skeleton of a Latin-script name; letters with diacritics count as their base letters."""
    t = F.regexp_replace(unmarked(F.lower(F.coalesce(c, F.lit("")))), r"[^a-z\s]", "")
    for pattern, to in SOUNDS:
        t = F.regexp_replace(t, pattern, to)
    return F.regexp_replace(F.regexp_replace(t, r"(.)\1+", "$1"), r"\s+", "")


def repaired_count(c: Column) -> Column:
    """STRUCT<value, note> of a scanned count: clean number first, bar-like marks as ones, else the digits; negatives refused."""
    s = F.trim(c)
    number = s.try_cast("double")
    whole = number.isNotNull() & (number == F.floor(number))
    digits = F.regexp_replace(s, "[^0-9]", "")
    ones = F.translate(s, "Il|", "111")
    out = lambda value, note: F.struct(value.cast("long").alias("value"), note.cast("string").alias("note"))
    none = F.lit(None)
    read = lambda to: F.concat(F.lit("scan "), s, F.lit(" counts as "), to)
    refuse = F.concat(F.lit("no count below zero: "), s)
    return (
        F.when(s.isNull() | F.lower(s).isin("", "nan", "none"), out(none, none))
        .when(s.rlike("^[Il|]+$"), out(ones.try_cast("long"), read(ones)))
        .when(whole & (number >= 0), out(number.try_cast("long"), none))
        .when(whole, out(none, refuse))
        .when(digits == "", out(none, none))
        .when(s.startswith("-"), out(none, refuse))
        .otherwise(out(digits.try_cast("long"), read(digits.try_cast("long").cast("string"))))
    )


def undoubled(cells: Column) -> Column:
    """Cells of a row whose letters were printed twice: if any cell is a doubled text, every cell is halved."""
    bare = lambda c: F.regexp_replace(c, r"\s", "")
    doubled = F.exists(cells, lambda c: (F.length(bare(c)) >= 8) & bare(c).rlike("[A-Za-z]") & bare(c).rlike(r"^(?:(.)\1)+$"))
    return F.when(doubled, F.transform(cells, lambda c: F.regexp_replace(c, r"(\S)\1|\S", "$1"))).otherwise(cells)


def units_sum(c: Column) -> Column:
    """Capacity of a unit expression: '2x120+1*50' is 290, a plain number itself, null without a number."""
    term = r"(\d+(?:\.\d+)?)(?:\s*[xX*×]\s*(\d+(?:\.\d+)?))?"
    a, b = F.regexp_extract_all(c, F.lit(term), F.lit(1)), F.regexp_extract_all(c, F.lit(term), F.lit(2))
    product = F.zip_with(a, b, lambda x, y: x.try_cast("double") * F.coalesce(y.try_cast("double"), F.lit(1.0)))
    return F.when(F.size(a) > 0, F.aggregate(product, F.lit(0.0), lambda s, x: s + x))
