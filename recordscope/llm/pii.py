"""Personal data by weak supervision, in DataFrame and SQL functions only.

Fixed patterns give the base spans. Wider patterns give candidates (written-out mail addresses, numbers without a country code,
national ids, account numbers, names), on which labelers vote for, against or not at all: form, gazetteers, words before the span,
and placeholder signs. Spark counts vote patterns by kind; expectation-maximisation over this small table (at most 3^4 patterns a
kind, whatever the corpus) estimates how reliable each labeler is and so the chance that each pattern is personal data. These
chances are the soft labels of the final span classifier, which sees what the labelers do not: the shape and length of a span, the
characters on both sides, the word before it and its place in the line. Its weights of evidence are sums over all candidates. The
votes enter its score only as a bounded prior, so surroundings can overrule them. Spans that it accepts are added; base spans stay.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordscope.llm.common import durable
from recordscope.llm.spans import described, digits_of, find_spans, luhn

#: The base patterns' kinds, in the order of their spans.
BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("mail_text", "local_phone", "national_id", "account", "name")
LABELERS = ("form", "gazetteer", "context", "placeholder")

# Fixed values of the base patterns.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

#: Candidate patterns of the added kinds.
MAIL_TEXT = r"(?i)(?<![a-z0-9._-])[a-z0-9][a-z0-9._-]++\x20?[\[(<{]\x20?at\x20?[\])>}]\x20?[a-z0-9-]++(?:\x20?[\[(<{]\x20?dot\x20?[\])>}]\x20?[a-z0-9-]{2,}+)++"
LOCAL_PHONE = r"(?<![0-9+(.-])(?<!\+[0-9]{1,3}\x20)\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9.-])"
NATIONAL_ID = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
ACCOUNT = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
TITLES = r"Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Monsieur|Madame|Mme|Señora|Señor|Sra|Sr"

#: Gazetteers: common given and family names of the four languages, top-level names of mail hosts, countries that have account numbers.
GIVEN_NAMES = (
    "james", "mary", "john", "patricia", "robert", "jennifer", "michael", "linda", "david", "elizabeth", "william", "barbara",
    "richard", "susan", "joseph", "jessica", "thomas", "sarah", "charles", "karen", "daniel", "nancy", "matthew", "lisa",
    "anthony", "betty", "mark", "margaret", "donald", "sandra", "steven", "ashley", "andrew", "emily", "kenneth", "donna",
    "joshua", "michelle", "kevin", "carol", "brian", "amanda", "george", "melissa", "edward", "deborah", "ronald", "stephanie",
    "hans", "klaus", "peter", "wolfgang", "jürgen", "dieter", "stefan", "andreas", "uwe", "heinz", "anna", "ursula",
    "monika", "petra", "sabine", "renate", "helga", "karin", "brigitte", "ingrid", "lukas", "leon", "felix", "lena",
    "jean", "pierre", "michel", "andré", "philippe", "alain", "jacques", "bernard", "marie", "nathalie", "isabelle", "sylvie",
    "catherine", "françoise", "valérie", "christine", "nicolas", "julien", "louis", "camille", "chloé", "manon", "hugo", "luc",
    "josé", "jose", "juan", "carlos", "luis", "antonio", "manuel", "francisco", "javier", "miguel", "pedro", "pablo",
    "maria", "maría", "carmen", "ana", "isabel", "dolores", "pilar", "teresa", "rosa", "lucía", "paula", "sofía",
    "paul", "martin", "simon", "alexander", "laura", "julia", "claudia", "sophia", "emma", "olivia", "oliver", "ethan",
    "ahmed", "mohamed", "fatima", "ali", "omar", "chen", "wei", "yuki", "raj", "priya", "olga", "ivan",
)
FAMILY_NAMES = (
    "smith", "johnson", "williams", "brown", "jones", "miller", "davis", "wilson", "anderson", "taylor", "thomas", "moore",
    "jackson", "thompson", "harris", "clark", "lewis", "robinson", "walker", "wright", "hughes", "evans", "roberts", "murphy",
    "müller", "schmidt", "schneider", "fischer", "weber", "meyer", "wagner", "becker", "schulz", "hoffmann", "koch", "bauer",
    "richter", "klein", "schröder", "neumann", "schwarz", "zimmermann", "braun", "krüger", "hartmann", "lange", "krause", "lehmann",
    "martin", "durand", "dubois", "moreau", "laurent", "lefebvre", "leroy", "roux", "fournier", "girard", "bonnet", "lambert",
    "fontaine", "rousseau", "vincent", "faure", "mercier", "blanc", "guérin", "boyer", "garnier", "chevalier", "gauthier", "perrin",
    "garcía", "rodríguez", "gonzález", "fernández", "lópez", "martínez", "sánchez", "pérez", "gómez", "jiménez", "ruiz", "hernández",
    "díaz", "moreno", "álvarez", "muñoz", "romero", "alonso", "gutiérrez", "navarro", "torres", "domínguez", "vázquez", "ramos",
)
HOST_ENDS = (
    "com", "org", "net", "edu", "gov", "mil", "int", "info", "biz", "io", "co", "dev", "app", "ai", "me", "eu", "uk", "ie", "us", "ca",
    "au", "nz", "in", "de", "at", "ch", "li", "fr", "be", "lu", "mc", "es", "mx", "ar", "cl", "pe", "it", "pt", "br", "nl",
)
ACCOUNT_PLACES = ("AD", "AT", "BE", "BG", "CH", "CY", "CZ", "DE", "DK", "EE", "ES", "FI", "FR", "GB", "GR", "HR", "HU", "IE", "IS", "IT", "LI", "LT", "LU", "LV", "MC", "MT", "NL", "NO", "PL", "PT", "RO", "SE", "SI", "SK", "SM")
#: Words before a person's name, and verbs that may stand between.
PERSON_CUES = r"name|named|contact|signed|sincerely|regards|patient|customer|employee|heißt|unterzeichnet|grüßen|kunde|nom|appelle|signé|cordialement|client\p{L}?|nombre|llamo|firmado|atentamente|paciente"
COPULAS = "is|ist|est|es"
#: Words before a span that speak for it, in the four languages.
CUES = {
    "mail_text": r"(?:mail|e-mail|contact|write|reach|address|kontakt|schreib\p{L}*|adresse|erreich\p{L}*|courriel|écri\p{L}*|contacte\p{L}*|correo|escri\p{L}*|dirección)\W*(?:\p{L}+\W+){0,3}$",
    "local_phone": r"(?:phone|call|tel|mobile|cell|fax|dial|number|telefon|handy|mobil|nummer|ruf\p{L}*|téléphone|portable|appel\p{L}*|numéro|teléfono|móvil|llam\p{L}*|número)\W*(?:\p{L}+\W+){0,3}$",
    "national_id": r"(?:ssn|social|security|national|identity|taxpayer|ausweis\p{L}*|steuer\p{L}*|sozial\p{L}*|sécurité|identité|fiscal|seguridad|identidad|documento)\W*(?:\p{L}+\W+){0,3}$",
    "account": r"(?:iban|account|bank|transfer|pay|konto|überweis\p{L}*|compte|virement|cuenta|banco|transferencia)\W*(?:\p{L}+\W+){0,3}$",
    "name": rf"(?:{PERSON_CUES})\W*(?:(?:{COPULAS})\W+)?$",
}
AGAINST = r"(?:version|order|isbn|issn|invoice|item|sku|page|figure|table|section|chapter|build|ticket|bestellung|rechnung|seite|kapitel|commande|facture|chapitre|pedido|factura|página|capítulo)\W*(?:\p{L}+\W+){0,1}$"
EM_STEPS = 50
#: Share of a labeler's votes on true candidates without data (turned round on false ones), candidates that this belief is worth, and
#: the believed share of true candidates.
BELIEF = {1: 0.5, 0: 0.4, -1: 0.1}
BELIEVED = 100
SHARE = 0.1
#: Buckets of words and shapes, and the most that votes count in a score.
BUCKETS = 256
PRIOR = 2.0


def either(words: tuple[str, ...]) -> str:
    """A pattern for any of the words, parted by first letter so that a matcher tries few of them."""
    first: dict[str, list[str]] = {}
    for w in words:
        first.setdefault(w[0], []).append(w[1:])
    return "(?:" + "|".join(f"{a}(?:{'|'.join(sorted(rest, key=len, reverse=True))})" for a, rest in sorted(first.items())) + ")"


def base_spans(text: Column) -> dict[str, Column]:
    """Arrays of spans by base kind."""
    small = lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.coalesce(F.ltrim(p, F.lit("0")).try_cast("int"), F.lit(0)) <= 255)
    n = lambda h: F.length(digits_of(h))
    return {
        "email": find_spans(text, EMAIL, only_if=F.contains(text, F.lit("@"))),
        "ip": find_spans(text, IP, lambda h: F.forall(F.split(h, r"\."), small), text.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]")),
        "card": find_spans(text, CARD, lambda h: n(h).between(16, 19) & F.when(n(h).between(16, 19), luhn(digits_of(h))).otherwise(F.lit(False)), text.rlike(r"[0-9](?:[\x20-]?[0-9]){15}")),
        "phone": find_spans(text, PHONE, lambda h: n(h).between(8, 15), F.contains(text, F.lit("+"))),
    }


def _account_check(hit: Column) -> Column:
    """Whether an account number passes its check: turned and spelled in digits it leaves 1 when divided by 97."""
    plain = F.replace(hit, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))

    def fold(s: Column, c: Column) -> Column:
        value = F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
        return F.pmod(s * F.when(value > 9, 100).otherwise(10) + value, F.lit(97))

    return F.aggregate(F.split(turned, ""), F.lit(0), fold) == 1


def _votes(kind: str, s: Column) -> Column:
    """One candidate with its votes (1 for, -1 against, 0 none) and its features."""
    hit, low = s["hit"], F.lower(s["hit"])
    before = F.lower(s["before"])
    digits = digits_of(hit)
    context = F.when(before.rlike(AGAINST), -1).when(before.rlike(CUES[kind]), 1).otherwise(0)
    if kind == "mail_text":
        form = F.when(low.rlike(r"[\[(<{]\x20?dot\x20?[\])>}]\x20?[a-z]{2,6}$"), 1).otherwise(-1)
        gazetteer = F.when(F.regexp_extract(low, r"([a-z0-9-]+)$", 1).isin(*HOST_ENDS), 1).otherwise(0)
        placeholder = F.when(low.rlike(r"example|domain|yourname|user\x20?[\[(]"), -1).otherwise(0)
    elif kind == "local_phone":
        form = F.when(hit.rlike(r"^(?:\([0-9]{3}\)\x20|[0-9]{3}([.-]))[0-9]{3}[.-][0-9]{4}$"), 1).otherwise(-1)
        gazetteer = F.when(F.substring(digits, 1, 1).isin("0", "1"), -1).otherwise(1)
        placeholder = F.when(digits.rlike(r"^(?:0123|1234|000)|([0-9])\1{5}"), -1).otherwise(0)
    elif kind == "national_id":
        form = F.when(digits.rlike(r"^(?:000|666|9)|^.{3}00|0000$"), -1).otherwise(1)
        gazetteer = F.lit(0)
        placeholder = F.when(digits.isin("123456789", "078051120") | digits.rlike(r"([0-9])\1{5}"), -1).otherwise(0)
    elif kind == "account":
        form = F.when(_account_check(hit), 1).otherwise(-1)
        gazetteer = F.when(F.substring(hit, 1, 2).isin(*ACCOUNT_PLACES), 1).otherwise(-1)
        placeholder = F.when(digits.rlike(r"([0-9])\1{7}|0123456789"), -1).otherwise(0)
    else:
        form = F.when(hit.rlike(rf"^(?:{TITLES})\b"), 1).otherwise(0)
        first = F.regexp_extract(low, r"(\p{L}+)\x20\p{L}+$", 1)
        last = F.regexp_extract(low, r"\x20(\p{L}+)$", 1)
        # the lists are short, so a name that they lack is no sign against it
        gazetteer = F.when(first.isin(*GIVEN_NAMES) | last.isin(*FAMILY_NAMES), 1).otherwise(0)
        placeholder = F.when(low.rlike(r"john doe|jane doe|max mustermann|erika mustermann|jean dupont|juan pérez|lorem ipsum"), -1).otherwise(0)
    tidy = lambda c: c.cast("int")
    bucket = lambda c: F.pmod(F.xxhash64(c), F.lit(BUCKETS)).cast("int")
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(hit, r"\p{Lu}+", "A"), r"\p{Ll}+", "a"), "[0-9]", "9")
    return F.struct(
        F.lit(kind).alias("kind"), F.lit(ADDED_KINDS.index(kind)).alias("kind_no"), s["start"].alias("start"), s["end"].alias("end"),
        tidy(form).alias("form"), tidy(gazetteer).alias("gazetteer"), tidy(context).alias("context"), tidy(placeholder).alias("placeholder"),
        F.least(F.length(hit) / 4, F.lit(16)).cast("int").alias("length_step"),
        F.least(F.length(digits), F.lit(24)).alias("digit_count"),
        bucket(shape).alias("shape"),
        bucket(F.regexp_extract(before, r"(\p{L}+)[^\p{L}]*$", 1)).alias("word_before"),
        F.when(before.rlike(r"[:=]\s*$"), 2).when(before.rlike(r"(?:^|[.!?\n])\s*$"), 0).when(before.rlike(r"[\p{L}0-9]\x20$"), 1).when(before.rlike(r"[(\[<\"']$"), 3).otherwise(4).alias("left_side"),
        F.when(s["after"].rlike(r"^\s*\n|^$"), 0).when(s["after"].rlike(r"^[.,;:!?]"), 1).when(s["after"].rlike(r"^\x20\p{L}"), 2).when(s["after"].rlike(r"^[)\]>\"']"), 3).otherwise(4).alias("right_side"),
    )


#: What the classifier sees beside the votes.
FEATURES = ("length_step", "digit_count", "shape", "word_before", "left_side", "right_side")


def candidates(text: Column) -> Column:
    """Array of candidates of the added kinds with votes and features.

    Capitalised words are a candidate name with any one sign for it: a title, a listed given or family name, or a cue before them. No
    sign is common to all candidates, so each labeler has some to vote for and some on which it is silent.
    """
    given, family = (either(tuple(n.capitalize() for n in names)) for names in (GIVEN_NAMES, FAMILY_NAMES))
    word, left = r"\p{Lu}\p{Ll}++", r"(?<![\p{L}.])"
    cued = rf"(?=\p{{Lu}}\p{{Ll}})(?<=(?i:{PERSON_CUES})\W{{1,3}}(?:(?i:{COPULAS})\W{{1,3}})?)"
    name = rf"(?:{left}(?:(?:{TITLES})\.?\x20(?:{word}\x20)?{word}|{given}\x20{word}|{word}\x20{family})|{cued}{word}\x20{word})(?!\p{{L}})"
    sign = rf"(?<!\p{{L}})(?:{TITLES}|{given})\.?\x20\p{{Lu}}|\p{{Ll}}\x20{family}(?!\p{{L}})|(?i:{PERSON_CUES})\W{{1,3}}(?:(?i:{COPULAS})\W{{1,3}})?{word}\x20\p{{Lu}}"
    found = {
        "mail_text": find_spans(text, MAIL_TEXT, only_if=text.rlike(r"(?i)[\[(<{]\x20?at\x20?[\])>}]"), around=True),
        "local_phone": find_spans(text, LOCAL_PHONE, only_if=text.rlike(r"[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}"), around=True),
        "national_id": find_spans(text, NATIONAL_ID, only_if=text.rlike(r"[0-9]-[0-9]{2}-[0-9]"), around=True),
        "account": find_spans(text, ACCOUNT, only_if=text.rlike(r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}"), around=True),
        "name": find_spans(text, name, only_if=text.rlike(sign), around=True),
    }
    vote = lambda kind: lambda s: _votes(kind, s)
    return F.concat(*[F.transform(spans, vote(kind)) for kind, spans in found.items()])


def estimate_reliability(patterns: list[tuple[tuple[int, ...], int]], steps: int = EM_STEPS) -> dict[tuple[int, ...], float]:
    """Chance that each vote pattern is true, by EM over two classes with independent labelers.

    Starts from, and is smoothed by, what is believed of a labeler without data (``BELIEF``, worth ``BELIEVED`` candidates) and of the
    share of true candidates (``SHARE``). A few candidates leave the belief as it is: two votes for a span, none against, are needed.
    """
    believed = lambda: ({x: BELIEVED * p for x, p in BELIEF.items()}, {x: BELIEVED * BELIEF[-x] for x in BELIEF})
    share = lambda c: {x: n / sum(c.values()) for x, n in c.items()}
    labelers = range(len(patterns[0][0]))
    prior, rate = SHARE, [tuple(map(share, believed())) for _ in labelers]
    chance: dict[tuple[int, ...], float] = {}
    for _ in range(steps):
        for v, _ in patterns:
            odds = math.log(prior / (1 - prior)) + sum(math.log(t[x] / f[x]) for (t, f), x in zip(rate, v, strict=True))
            chance[v] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
        whole = sum(n for _, n in patterns)
        prior = (sum(chance[v] * n for v, n in patterns) + BELIEVED * SHARE) / (whole + BELIEVED)
        for k in labelers:
            true, false = believed()
            for v, n in patterns:
                true[v[k]] += chance[v] * n
                false[v[k]] += (1 - chance[v]) * n
            rate[k] = (share(true), share(false))
    return chance


def _all_votes() -> list[tuple[int, ...]]:
    """All vote patterns, the first labeler's vote changing fastest."""
    return [tuple(n // 3**k % 3 - 1 for k in range(len(LABELERS))) for n in range(3 ** len(LABELERS))]


def _odds(p: float) -> float:
    p = min(1 - 1e-9, max(1e-9, p))
    return math.log(p / (1 - p))


def find_personal_data(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, ``keep`` columns, email, ip, card, phone: arrays of spans, added: array of (kind, start, end)) for each row.

    A null text is empty. Repeated rows each get a row, whatever their ids. Without candidates nothing is added. What the driver
    sees is bounded: vote patterns, and sums of features by at most ``BUCKETS`` values each.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    base = base_spans(text)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *keep, *[base[k].alias(k) for k in BASE_KINDS], candidates(text).alias("candidates"))
    found = durable(rows)
    each = found.select(F.explode("candidates").alias("c")).select("c.*")
    patterns: dict[str, list] = {}
    for r in each.groupBy("kind", *LABELERS).count().collect():
        patterns.setdefault(r["kind"], []).append((tuple(r[k] for k in LABELERS), r["count"]))
    chance = {(kind, *v): p for kind, rows in patterns.items() for v, p in estimate_reliability(sorted(rows)).items()}
    if not chance:
        return found.select("doc_id", *keep, *BASE_KINDS, F.array().cast("array<struct<kind:string,start:int,end:int>>").alias("added"))
    # tables are arrays by kind and value, so that a lookup is one step
    at = lambda c: sum((F.lit(3**k) * (c(name) + 1) for k, name in enumerate(LABELERS)), F.lit(0))
    table = lambda rows: F.from_json(F.lit(json.dumps(rows)), "array<array<double>>")
    by_votes = lambda value: table([[value(kind, v) for v in _all_votes()] for kind in ADDED_KINDS])
    look = lambda rows, c, i: F.get(F.get(rows, c("kind_no")), i)
    truth = look(by_votes(lambda kind, v: chance.get((kind, *v), 0.0)), F.col, at(F.col))
    facts = F.explode(F.array(*[F.struct(F.lit(k).alias("feature"), F.col(f).alias("value")) for k, f in enumerate(FEATURES)])).alias("fact")
    sums = each.withColumn("p", truth).select("kind", "p", facts).groupBy("kind", "fact.feature", "fact.value").agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no")).collect()
    totals = {kind: [0.0, 0.0] for kind in ADDED_KINDS}
    for r in sums:
        totals[r["kind"]][0] += r["yes"] / len(FEATURES)
        totals[r["kind"]][1] += r["no"] / len(FEATURES)
    weight = {(r["kind"], r["feature"], r["value"]): math.log((r["yes"] + 0.5) / (totals[r["kind"]][0] + 1) / ((r["no"] + 0.5) / (totals[r["kind"]][1] + 1))) for r in sums}
    prior = {k: math.log((yes + 0.5) / (no + 0.5)) for k, (yes, no) in totals.items()}
    weights = [table([[weight.get((kind, k, v), 0.0) for v in range(BUCKETS)] for kind in ADDED_KINDS]) for k in range(len(FEATURES))]
    # the votes count as their log odds against the kind's own, no more than PRIOR either way
    voted = by_votes(lambda kind, v: prior[kind] + max(-PRIOR, min(PRIOR, _odds(chance.get((kind, *v), 0.5)) - prior[kind])))
    score = lambda c: sum((look(weights[k], c.__getitem__, c[f]) for k, f in enumerate(FEATURES)), look(voted, c.__getitem__, at(c.__getitem__)))
    taken = F.filter("candidates", lambda c: score(c) > 0)
    plain = F.transform(taken, lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end")))
    return found.select("doc_id", *keep, *BASE_KINDS, plain.alias("added"))


def op7_personal_data(spark, sf_dir: str) -> DataFrame:
    """Query: personal data in all ``documents``."""
    found = find_personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    base = F.concat(*[described(k, F.col(k)) for k in BASE_KINDS])
    extra = F.transform("added", lambda c: F.concat_ws(":", c["kind"], c["start"].cast("string"), c["end"].cast("string")))
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(F.array_join(base, ","), 256).alias("base_sha256"), F.array_join(F.concat(base, extra), ",").alias("spans"), F.size("added").cast("long").alias("n_added"))
