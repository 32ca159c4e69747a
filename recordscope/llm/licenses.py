"""Licence scans by a positional index of rare words, in DataFrame and SQL functions only.

Each template is a notice with a mandatory key phrase. A first pass counts, over all files, in how many of them each licence word
stands. The index then posts, for each template, the rarest words of its key phrase with their places in the notice. A file looks up
its occurrences of posted words only; occurrences that name the same template at the same relative position are intersected, and
where all posted words of a template agree its key phrase is verified word by word and the share of the notice that stands there
is measured. Posted words are parts of the key phrase, so the index loses no place, whatever the counts are.

Fixed phrases (the base) are templates that are their own key phrase. Everything happens inside a file's row: no shuffle but the
counts of a fixed vocabulary, and times grow with the words of a text and the occurrences of posted words in it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordscope.llm.spans import let

# Fixed values of the base: phrase and label.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
# Fixed values, wordings of public licences: label, words of a notice, its mandatory key phrase.
NOTICES = (
    ("agpl", "under the terms of the gnu affero general public license", "gnu affero general public license"),
    ("apache", "licensed under the apache license version 2 0", "apache license version 2"),
    ("boost", "distributed under the boost software license version 1 0", "boost software license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution and use in source and binary forms"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", "creative commons attribution 4 0 international"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license", "creative commons attribution noncommercial"),
    ("cc-by-nd", "licensed under cc by nd 4 0", "cc by nd"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license", "creative commons attribution sharealike"),
    ("cc0", "dedicated to the public domain under cc0 1 0 universal", "cc0 1 0 universal"),
    ("epl", "under the terms of the eclipse public license v 2 0", "eclipse public license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gnu general public license"),
    ("gpl-3", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "permission to use copy modify and or distribute this software for any purpose"),
    ("lgpl", "under the terms of the gnu lesser general public license", "gnu lesser general public license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered software released into the public domain"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable", "provided as is without any express or implied warranty"),
)
#: What separates words of lower-cased texts.
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words of a key phrase that are posted.
POSTED = 2
#: Share of a notice, in percent, that must stand around its key phrase.
LEAST = 50
#: Score of a file that holds base phrases alone.
BASE_SCORE = 0.5
#: Template number and first word's place in one long; places from -PLACES on are told apart.
PLACES = 1 << 20
SHIFT = 40


def templates() -> list[tuple[str, list[str], list[str], int, bool]]:
    """(label, words, key phrase, place of the key phrase, base) of all templates, those of the base first."""
    out = [(label, phrase.split(), phrase.split(), 0, True) for phrase, label in BASE.items()]
    for label, notice, key in NOTICES:
        words, part = notice.split(), key.split()
        at = next(i for i in range(len(words)) if words[i : i + len(part)] == part)
        out.append((label, words, part, at, False))
    return out


def file_words(text: Column) -> Column:
    """Array of the words of a text in lower case; null gives an empty array."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), GAPS), "")


def document_counts(worded: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """In how many rows of (words) each word of a small fixed vocabulary stands."""
    found = worded.select(F.explode(F.array_intersect("words", F.array(*[F.lit(w) for w in vocabulary]))).alias("w"))
    return {r["w"]: r["n"] for r in found.groupBy("w").agg(F.count("*").alias("n")).collect()}


def rare_places(key: list[str], at: int, counts: dict[str, int], posted: int = POSTED) -> list[tuple[int, str]]:
    """(place in the notice, word) of the rarest distinct words of a key phrase, each at its first place."""
    order = sorted(dict.fromkeys(key), key=lambda w: (counts.get(w, 0), -len(w), w))
    return [(at + key.index(w), w) for w in order[:posted]]


def _strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _alignments(words: Column, index: list[tuple[int, int, str]]) -> Column:
    """Array of template * 2**SHIFT + first word's place + PLACES, where all posted words of a template agree. ``index`` has (template, place, word)."""
    first: dict[str, list[tuple[int, int]]] = {}
    rest: dict[int, list[tuple[int, str]]] = {}
    for template, place, word in index:
        if template in rest:
            rest[template].append((place, word))
        else:
            rest[template] = []
            first.setdefault(word, []).append((template, place))
    posting = lambda t, o: F.struct(F.lit(t).alias("t"), F.lit(o).alias("o"))
    postings = F.create_map(*[x for w, ps in first.items() for x in (F.lit(w), F.array(*[posting(t, o) for t, o in ps]))])
    # the rarest word of each template proposes places, the next ones must stand where it says
    # places are filtered as plain numbers; a struct for each word of a text would be much garbage
    places = F.when(F.size(words) > 0, F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.get(words, i).isin(*first))).otherwise(F.array().cast("array<int>"))
    hits = F.transform(places, lambda i: F.struct(i.alias("i"), F.get(words, i).alias("w")))
    agree = lambda t, start: reduce(lambda a, b: a & b, [F.when(t == k, F.coalesce(reduce(lambda a, b: a & b, [F.get(words, start + o) == w for o, w in more]), F.lit(False))).otherwise(True) for k, more in rest.items() if more], F.lit(True))

    def proposed(h: Column) -> Column:
        starts = F.transform(postings[h["w"]], lambda p: F.struct(p["t"].alias("t"), (h["i"] - p["o"]).alias("start")))
        return F.transform(F.filter(starts, lambda s: agree(s["t"], s["start"])), lambda s: F.shiftleft(s["t"].cast("long"), SHIFT) + s["start"] + PLACES)

    return F.flatten(F.transform(hits, proposed))


def scan_licenses(docs: DataFrame, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, found: array of (start, label, base, share)) for each row of ``docs``, ordered by start.

    ``start`` is the word at which a base phrase, or the key phrase of a notice, begins (words from 0); ``share`` is the share of the
    notice's words that stand around it, 1 for base phrases. Key phrases with less than ``least`` percent of their notice are left out.
    Null and empty texts have no words; repeated rows and shared or null ids come out row by row; very long texts are scanned
    whole; an empty table gives no rows. Other columns are ignored.
    """
    worded = docs.select(F.col(id_col).cast("long").alias("doc_id"), file_words(F.col(text_col)).alias("words"))
    every = templates()
    counts = document_counts(worded, sorted({w for _, _, key, _, _ in every for w in key}))
    index = [(t, place, word) for t, (_, _, key, at, _) in enumerate(every) for place, word in rare_places(key, at, counts)]
    table = F.array(*[F.struct(F.lit(label).alias("label"), _strings(words).alias("words"), _strings(key).alias("key"), F.lit(at).alias("at"), F.lit(base).alias("base")) for label, words, key, at, base in every])
    words = F.col("words")

    def told(code: Column) -> Column:
        """The place of a template, null where its key phrase is not there."""

        def one(x: Column) -> Column:
            t, start = x["t"], x["start"]
            at = start + t["at"]
            key = F.when(at >= 0, F.slice(words, F.greatest(at, F.lit(0)) + 1, F.size(t["key"])) == t["key"])
            same = F.size(F.filter(t["words"], lambda w, i: F.coalesce(F.get(words, start + i) == w, F.lit(False))))
            share = same.cast("double") / F.size(t["words"])
            ok = key & (100 * same >= least * F.size(t["words"]))
            return F.when(ok, F.struct(at.alias("start"), t["label"].alias("label"), t["base"].alias("base"), share.alias("share")))

        start = (F.pmod(code, F.lit(1 << SHIFT)) - PLACES).cast("int")
        return let(F.struct(F.get(table, F.shiftright(code, SHIFT).cast("int")).alias("t"), start.alias("start")), one)

    placed = worded.select("doc_id", "words", _alignments(words, index).alias("codes"))
    found = F.array_sort(F.filter(F.transform("codes", told), lambda x: x.isNotNull()))
    return placed.select("doc_id", F.size("words").cast("long").alias("n_words"), found.alias("found"))


def op13_license_scan(spark, sf_dir: str) -> DataFrame:
    """Query: base phrases and licence notices in all ``documents``; ``places`` has label:start of every place found."""
    found = scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    base = F.filter("found", lambda x: x["base"])
    starts = F.transform(base, lambda x: x["start"].cast("long"))
    labels = lambda c: F.array_join(F.array_sort(F.array_distinct(F.transform(c, lambda x: x["label"]))), ",")
    shares = F.transform(F.filter("found", lambda x: ~x["base"]), lambda x: x["share"])
    score = F.greatest(F.coalesce(F.array_max(shares), F.lit(0.0)), F.when(F.size(base) > 0, BASE_SCORE).otherwise(0.0))
    places = F.array_join(F.transform("found", lambda x: F.concat_ws(":", x["label"], x["start"].cast("string"))), ",")
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"), labels(base).alias("base_labels"), labels(F.col("found")).alias("labels"), score.alias("score"), places.alias("places")
    )
