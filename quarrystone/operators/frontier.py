"""Generators: domain guesses and search queries per company."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrystone.functions.names import fold_text, name_tokens

ENDINGS = ["it", "com", "eu"]
# Ordered sound changes of a guess, and sector suffixes.
SOUNDS = [("ph", "f"), ("k", "c"), ("y", "i"), ("x", "s"), ("w", "v"), ("j", "i")]
SECTORS = [("idraulico", ["impianti", "idraulica", "termo"]), ("elettricista", ["impianti", "elettrica"]), ("ristorante", ["ristorante", "food"]), ("meccanica", ["officina", "auto"]), ("edilizia", ["costruzioni", "edil"]), ("fabbro", ["ferro", "serramenti"])]


def base_strategy(tokens: Column, city: Column, province: Column, category: Column) -> Column:
    return F.array(F.array_join(tokens, ""), F.array_join(tokens, "-"), F.get(tokens, F.lit(0)), F.array_join(F.slice(tokens, 1, 2), ""), F.array_join(F.slice(tokens, 1, 2), "-"))


def phonetic_strategy(tokens: Column, city: Column, province: Column, category: Column) -> Column:
    joined = F.array_join(tokens, "")
    return F.array(*[F.replace(joined, F.lit(a), F.lit(b)) for a, b in SOUNDS])


def acronym_strategy(tokens: Column, city: Column, province: Column, category: Column) -> Column:
    initials = F.array_join(F.transform(tokens, lambda t: F.substring(t, 1, 1)), "")
    return F.when(F.size(tokens) >= 2, F.array(initials, F.concat(initials, F.element_at(tokens, -1)), F.concat(initials, F.lit("-"), F.element_at(tokens, -1)))).otherwise(F.array().cast("array<string>"))


def sector_strategy(tokens: Column, city: Column, province: Column, category: Column) -> Column:
    joined, c = F.array_join(tokens, ""), F.lower(F.coalesce(category, F.lit("")))
    suffixes = F.coalesce(*[F.when((c != "") & (F.contains(c, F.lit(k)) | F.contains(F.lit(k), c)), F.array(*[F.lit(x) for x in v])) for k, v in SECTORS], F.array().cast("array<string>"))
    return F.concat(F.transform(suffixes, lambda s: F.concat(joined, s)), F.transform(suffixes, lambda s: F.concat_ws("-", joined, s)))


def location_strategy(tokens: Column, city: Column, province: Column, category: Column) -> Column:
    joined, place = F.array_join(tokens, ""), F.replace(fold_text(city), F.lit(" "), F.lit(""))
    p = F.lower(F.coalesce(province, F.lit("")))
    return F.array(F.concat(joined, place), F.concat_ws("-", joined, place), F.concat_ws("-", F.array_join(tokens, "-"), place), F.concat(joined, p), F.concat_ws("-", joined, p))


STRATEGIES = [base_strategy, phonetic_strategy, acronym_strategy, sector_strategy, location_strategy]


def domain_candidates(df: DataFrame, strategies: list[Callable] = STRATEGIES, most: int = 80, row_id: str = "row_id") -> DataFrame:
    """(row_id, place, domain): guesses of all strategies, each ending, with and without www, up to 70 characters; .it first,
    then shorter, then fewer dashes. Cut within the row, before rows are multiplied."""
    tokens = name_tokens(F.col("company_name"))
    stems = F.array_distinct(F.flatten(F.array(*[s(F.col("_t"), F.col("city"), F.col("province"), F.col("category")) for s in strategies])))
    stems = F.filter(stems, lambda s: s.rlike("^[a-z0-9][a-z0-9-]*[a-z0-9]$"))
    hosts = F.flatten(F.transform(stems, lambda s: F.array(*[F.concat(F.lit(w), s, F.lit("." + e)) for e in ENDINGS for w in ("", "www.")])))
    key = lambda h: F.struct(F.when(h.endswith(".it"), 0).otherwise(1).alias("i"), F.length(h).alias("n"), F.regexp_count(h, F.lit("-")).alias("d"), h.alias("h"))
    ranked = F.slice(F.array_sort(F.transform(F.filter(hosts, lambda h: F.length(h) <= 70), key)), 1, most)
    rows = df.select(row_id, "company_name", "city", "province", "category", tokens.alias("_t")).where(F.size("_t") > 0)
    return rows.select(row_id, F.posexplode(ranked).alias("p", "x")).select(row_id, (F.col("p") + 1).alias("place"), F.col("x.h").alias("domain"))


def guess_domains(name: Column) -> Column:
    """Eight plain guesses."""
    t = name_tokens(name)
    a, b = F.array_join(t, ""), F.array_join(t, "-")
    return F.array_distinct(F.array(*[F.concat(x, F.lit(e)) for x in (a, b) for e in (".it", ".com", ".eu", ".net")]))


# Sites that a search for an official site leaves out: all of them, and those of a short query.
EXCLUDED = [
    "facebook.com", "instagram.com", "linkedin.com", "twitter.com", "youtube.com", "tiktok.com", "paginegialle.it", "paginebianche.it", "virgilio.it", "yelp.it", "yelp.com", "tripadvisor.it", "kompass.com", "europages.com",
    "prontopro.it", "misterimprese.it", "registroimprese.it", "reteimprese.it", "informazione-aziende.it", "guidatitolari.it", "infojobs.it", "indeed.com", "subito.it", "glassdoor.it", "amazon.it", "ebay.it", "groupon.it",
    "wikipedia.org", "trustpilot.com",
]
EXCLUDED_SHORT = ["facebook.com", "paginegialle.it", "linkedin.com", "instagram.com", "prontopro.it", "yelp.it", "europages.com"]
# Words that are no query by themselves, and mail hosts that are no company's own.
QUERY_STOP_WORDS = ["srl", "spa", "snc", "sas", "scarl", "srls", "di", "e", "il", "la", "le", "i", "un", "una", "da", "per", "con", "su"]
SHARED_MAIL = ["gmail", "yahoo", "hotmail", "pec.it"]


def _value(name: str) -> Column:
    return F.trim(F.coalesce(F.col(name), F.lit("")))


def _form(text: str, **parts: Column) -> Column:
    """``text`` with each {part} put in; empty quotes and the blanks beside them off."""
    pieces, rest = [], text
    while "{" in rest:
        plain, _, rest = rest.partition("{")
        name, _, rest = rest.partition("}")
        pieces += [F.lit(plain), parts[name]]
    made = F.concat(*pieces, F.lit(rest))
    return F.trim(F.regexp_replace(F.regexp_replace(made, r'\s""', ""), r'""\s', ""))


def search_frontier(df: DataFrame, row_id: str = "row_id") -> DataFrame:
    """(row_id, place, query, kind, precision): search strings by falling precision; those that lack a part are left out."""
    parts = {x: _value(x) for x in ("company_name", "city", "phone", "address", "category", "province", "email")}
    vat = F.regexp_replace(_value("vat"), "[^0-9]", "")
    parts |= {"vat": vat, "mail": F.substring_index(parts["email"], "@", -1)}
    mail_own = F.contains(parts["email"], F.lit("@")) & (parts["mail"] != "")
    for host in SHARED_MAIL:
        mail_own = mail_own & ~F.contains(parts["mail"], F.lit(host))
    always, has_vat = F.lit(True), F.length(vat) == 11
    rows = [
        ('"P.IVA {vat}"', "vat_anchor", 0.95, has_vat), ('"{vat}" site:.it', "vat_anchor", 0.9, has_vat), ("site:{mail}", "domain_probe", 0.88, mail_own),
        ('"{phone}" "{company_name}"', "contact_vector", 0.82, F.length(parts["phone"]) >= 7), ('"{company_name}" "{city}" ' + " ".join(f"-site:{x}" for x in EXCLUDED), "exclusionary", 0.8, always),
        ('intitle:"{company_name}" "contatti" "{city}"', "contact_vector", 0.78, always), ('"{address}" "{city}" "{company_name}"', "contact_vector", 0.75, F.length(parts["address"]) > 5),
        ('"{company_name}" "{city}" "privacy policy" OR "note legali"', "contact_vector", 0.72, always), ('site:.it "{company_name}" "{city}"', "domain_probe", 0.65, always),
        ('"{company_name}" "{category}" {city} sito', "standard", 0.62, F.length(parts["category"]) > 2), ('"{company_name}" "{province}" sito ufficiale', "standard", 0.58, (F.length(parts["province"]) >= 2) & (parts["province"] != parts["city"])),
        ('"{company_name}" {city} sito ufficiale', "standard", 0.55, always),
    ]
    plan = F.array_compact(F.array(*[F.when(when, F.struct(_form(text, **parts).alias("query"), F.lit(kind).alias("kind"), F.lit(p).alias("precision"))) for text, kind, p, when in rows]))
    return df.select(row_id, F.posexplode(plan).alias("p", "x")).select(row_id, (F.col("p") + 1).alias("place"), "x.query", "x.kind", "x.precision")


def sanitized(c: Column) -> Column:
    """Quotes off, special characters to blanks, squeezed, cut at 200 characters: safe inside a query."""
    c = F.regexp_replace(F.coalesce(c, F.lit("")), "[\"'«»‹›„“”‘’]", "")
    c = F.trim(F.regexp_replace(F.regexp_replace(c, r"[()\[\]{}<>|&!^~*?:/\\]", " "), r"\s+", " "))
    return F.trim(F.substring(c, 1, 200))


def query_forms(df: DataFrame, form: str) -> Column:
    """Array of the search strings of a form, without those that lack a part: initial, fallback, phone, exclusionary, contact,
    nuclear, vat, legal_name, site, company, profile, registry, balance."""
    name, city, province, vat, phone, address = (_value(x) for x in ("company_name", "city", "province", "vat", "phone", "address"))
    plain = F.trim(F.regexp_replace(name, r"(?i)\b(srl|snc|sas|spa)\b", ""))
    digits = F.regexp_replace(phone, "[^0-9]", "")
    clean, place = sanitized(name), sanitized(city)
    wordy = (clean != "") & ~F.forall(F.split(F.lower(clean), " "), lambda w: w.isin(QUERY_STOP_WORDS))
    quoted = lambda c: F.when(c != "", F.concat(F.lit(' "'), c, F.lit('"'))).otherwise(F.lit(""))
    parts = {"name": name, "city": city, "province": province, "vat": vat, "phone": phone, "plain": plain, "digits": digits, "short": F.substring(digits, 3, 30), "clean": clean, "place": place, "_city": quoted(city), "_address": quoted(address), "loc": F.when(city != "", F.concat(F.lit(" "), city)).otherwise(F.lit(""))}
    has = lambda c: c != ""
    always = F.lit(True)
    no_place = F.when(place == "", F.concat(F.lit('"'), clean, F.lit('"')))
    forms: dict[str, list[tuple[str, Column]]] = {
        "initial": [('"{name}" {city}', has(name))],
        "fallback": [('"{name}" {city} sito ufficiale', has(name)), ("{name} {city} website", has(name))],
        "phone": [('"{phone}" "{name}"', F.length(digits) >= 7), ('"{digits}" {city} sito', F.length(digits) >= 7), ('"{short}" {city} "{name}"', digits.startswith("39") & (F.length(digits) > 10))],
        "exclusionary": [('"{name}" "{city}" ' + " ".join(f"-site:{x}" for x in EXCLUDED_SHORT), always)],
        "contact": [('"{name}" "{city}" ("chi siamo" OR "contatti" OR "about us")', always)],
        "nuclear": [
            *[(t, always) for t in ('"{plain}" {city} sito ufficiale', '"{plain}" {province} website', "{plain} {city} contatti", '{plain} {city} "chi siamo"', '"{name}" {city}', 'site:it "{plain}" {city}', 'intitle:"{plain}" {city}', '"{plain}" "cookie policy"', '"{plain}" "privacy policy"')],
            ("{vat} sito", has(vat)), ('"P.IVA {vat}"', has(vat)), ('"{phone}" sito', has(phone)), *[(f'site:{x} "{{plain}}" {{city}}', always) for x in ("facebook.com", "instagram.com", "linkedin.com")],
        ],
        "vat": [(t, has(vat)) for t in ('"{vat}" site:.it', '"{vat}" (contatti OR "contattaci")', '"{vat}" ("privacy policy" OR "note legali")', '"{vat}" filetype:pdf')],
        "legal_name": [(t, has(name)) for t in ('"{name}"{_city}', '"{name}"{_address}', '"{name}" "contattaci"', 'intitle:"{name}"{_city}', '"{name}" "sito ufficiale"', '"{name}" ("P. IVA" OR "Partita IVA")')],
        "site": [(t, has(name)) for t in ('"{name}"{loc} sito ufficiale', '"{name}"{loc} site:.it', '"{name}"{loc}')],
        "company": [('"{clean}" {place}', wordy & has(place)), ("{clean} {place}", wordy & has(place)), ('"{clean}" site:.it', wordy)],
        "profile": [('site:linkedin.com/in "{clean}" Titolare OR CEO OR Amministratore {place}', wordy)],
        "registry": [('site:registroimprese.it OR site:informazione-aziende.it "{clean}" {place}', wordy)],
        "balance": [('"{clean}" {place} filetype:pdf bilancio OR "stato patrimoniale"', wordy)],
    }
    cut = lambda q: F.trim(F.substring(F.regexp_replace(q, r"\s+", " "), 1, 200)) if form in ("profile", "registry", "balance") else q
    made = [F.when(when, cut(_form(text, **parts))) for text, when in forms[form]]
    if form == "company":
        made.insert(0, F.when(wordy, no_place))
    return F.array_distinct(F.array_compact(F.array(*made)))


def url_plan(url: Column) -> Column:
    """Found URL, https root and http root, distinct."""
    h = F.regexp_extract(url, "^https?://([^/?#]+)", 1)
    return F.array_distinct(F.array(url, F.concat(F.lit("https://"), h), F.concat(F.lit("http://"), h)))
