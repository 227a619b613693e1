"""Company names, places and addresses: Column -> Column."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Legal forms, trade words and articles that a name is stripped of.
LEGAL_FORM = r"s\.?r\.?l\.?|s\.?p\.?a\.?|s\.?n\.?c\.?|s\.?a\.?s\.?|s\.?s\.?|soc\.?|coop\.?|societ[aà]'?\s+cooperativa|s\.?c\.?r\.?l\.?|s\.?c\.?|s\.?r\.?s\.?"
TRADE_WORDS = ["ristorante", "pizzeria", "hotel", "albergo", "caffe", "osteria", "trattoria", "impresa", "ditta", "studio"]
ARTICLES = ["il", "lo", "la", "i", "gli", "le", "un", "uno", "una"]
TRAILING_FORM = r"\s*(s\.?r\.?l\.?|s\.?p\.?a\.?|s\.?n\.?c\.?|s\.?a\.?s\.?|s\.?s\.?)\.?\s*$"
# Words that are no part of a name when it is matched.
FILLER_WORDS = ["srl", "srls", "spa", "snc", "sas", "sapa", "societa", "ditta", "impresa", "soc", "co", "ltd", "llc", "inc", "group", "holding", "the", "and", "di", "dei", "della", "delle", "del", "de", "e"]
ADDRESS_NOISE = ["via", "viale", "piazza", "pzza", "corso", "strada", "s", "snc", "n", "nr", "numero", "interno", "int"]
STREET_TYPES = ["via", "viale", "piazza", "corso", "vicolo", "strada", "piazzale", "largo"]
# Cities with a province of their own name.
PROVINCE_OF = {"milano": "MI", "roma": "RM", "torino": "TO", "napoli": "NA", "brescia": "BS", "bergamo": "BG", "bologna": "BO", "firenze": "FI", "venezia": "VE", "verona": "VR", "genova": "GE", "padova": "PD"}


def _decompositions() -> tuple[str, str]:
    """For ``translate``: letters whose full canonical decomposition is an ASCII letter and marks, by that letter; and the combining
    marks themselves, which have no counterpart and so go. After it, text is as NFD without marks wherever it is a-z or 0-9."""
    marks = [chr(c) for c in range(0x300, 0x370)]
    known = {chr(c): unicodedata.normalize("NFD", chr(c)) for c in [*range(0xC0, 0x2000), 0x212A, 0x212B]}
    letters = {c: d[0] for c, d in known.items() if d != c and "a" <= d[0].lower() <= "z" and all(m in marks for m in d[1:])}
    return "".join([*letters, *marks]), "".join(letters.values()).lower()


ACCENTED, PLAIN = _decompositions()
# The Italian provinces, code and name.
PROVINCE_NAMES = {
    "AG": "Agrigento", "AL": "Alessandria", "AN": "Ancona", "AO": "Aosta", "AR": "Arezzo", "AP": "Ascoli Piceno", "AT": "Asti", "AV": "Avellino", "BA": "Bari", "BT": "Barletta-Andria-Trani",
    "BL": "Belluno", "BN": "Benevento", "BG": "Bergamo", "BI": "Biella", "BO": "Bologna", "BZ": "Bolzano", "BS": "Brescia", "BR": "Brindisi", "CA": "Cagliari", "CL": "Caltanissetta",
    "CB": "Campobasso", "CE": "Caserta", "CT": "Catania", "CZ": "Catanzaro", "CH": "Chieti", "CO": "Como", "CS": "Cosenza", "CR": "Cremona", "KR": "Crotone", "CN": "Cuneo",
    "EN": "Enna", "FM": "Fermo", "FE": "Ferrara", "FI": "Firenze", "FG": "Foggia", "FC": "Forlì-Cesena", "FR": "Frosinone", "GE": "Genova", "GO": "Gorizia", "GR": "Grosseto",
    "IM": "Imperia", "IS": "Isernia", "SP": "La Spezia", "AQ": "L'Aquila", "LT": "Latina", "LE": "Lecce", "LC": "Lecco", "LI": "Livorno", "LO": "Lodi", "LU": "Lucca",
    "MC": "Macerata", "MN": "Mantova", "MS": "Massa-Carrara", "MT": "Matera", "ME": "Messina", "MI": "Milano", "MO": "Modena", "MB": "Monza e Brianza", "NA": "Napoli", "NO": "Novara",
    "NU": "Nuoro", "OR": "Oristano", "PD": "Padova", "PA": "Palermo", "PR": "Parma", "PV": "Pavia", "PG": "Perugia", "PU": "Pesaro e Urbino", "PE": "Pescara", "PC": "Piacenza",
    "PI": "Pisa", "PT": "Pistoia", "PN": "Pordenone", "PZ": "Potenza", "PO": "Prato", "RG": "Ragusa", "RA": "Ravenna", "RC": "Reggio Calabria", "RE": "Reggio Emilia", "RI": "Rieti",
    "RN": "Rimini", "RM": "Roma", "RO": "Rovigo", "SA": "Salerno", "SS": "Sassari", "SV": "Savona", "SI": "Siena", "SR": "Siracusa", "SO": "Sondrio", "SU": "Sud Sardegna",
    "TA": "Taranto", "TE": "Teramo", "TR": "Terni", "TO": "Torino", "TP": "Trapani", "TN": "Trento", "TV": "Treviso", "TS": "Trieste", "UD": "Udine", "VA": "Varese",
    "VE": "Venezia", "VB": "Verbano-Cusio-Ossola", "VC": "Vercelli", "VR": "Verona", "VV": "Vibo Valentia", "VI": "Vicenza", "VT": "Viterbo",
}
# Provinces that are no more, still found in records.
FORMER_PROVINCES = {"CI": "Carbonia-Iglesias", "VS": "Medio Campidano", "OG": "Ogliastra", "OT": "Olbia-Tempio"}
PROVINCES = [*PROVINCE_NAMES, *FORMER_PROVINCES]
# Legal endings of a name, in the order they are tried.
SUFFIXES = [("srls", r"s\.?r\.?l\.?s\.?"), ("srl", r"s\.?r\.?l\.?"), ("spa", r"s\.?p\.?a\.?"), ("snc", r"s\.?n\.?c\.?"), ("sas", r"s\.?a\.?s\.?"), ("ss", r"s\.?s\.?")]


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def normalize_company(c: Column) -> Column:
    """Lower case without legal forms, punctuation, trade words and articles; '' for null."""
    n = F.trim(F.lower(_text(c)))
    n = F.regexp_replace(n, rf"(^|\s)({LEGAL_FORM})(?=\s|$)", " ")
    n = F.regexp_replace(n, r"[.,/\-&()]", " ")
    n = F.regexp_replace(n, rf"\b({'|'.join(TRADE_WORDS)})\b", "")
    return squeeze(F.regexp_replace(n, rf"\b({'|'.join(ARTICLES)})\b", ""))


def clean_company_name(c: Column) -> Column:
    """Lower case without the trailing legal form and without anything but word characters."""
    return squeeze(F.regexp_replace(F.regexp_replace(F.lower(_text(c)), TRAILING_FORM, ""), r"[^a-z0-9_\s]", ""))


def fold_text(c: Column) -> Column:
    """Lower case, accents and combining marks off as by NFD, runs of anything but a-z and 0-9 to one space."""
    return F.trim(F.regexp_replace(F.translate(F.lower(_text(c)), ACCENTED, PLAIN), "[^a-z0-9]+", " "))


def folded_tokens(c: Column) -> Column:
    return F.filter(F.split(fold_text(c), " "), lambda t: t != "")


def name_tokens(c: Column) -> Column:
    """Folded words of two characters and more that are no filler."""
    return F.filter(folded_tokens(c), lambda t: (F.length(t) >= 2) & ~t.isin(FILLER_WORDS))


@F.pandas_udf(StringType())
def composed(c: pd.Series) -> pd.Series:
    """Canonical composition (NFC)."""
    return c.map(lambda x: unicodedata.normalize("NFC", x), na_action="ignore")


def clean_input(c: Column) -> Column:
    """Composed (NFC), zero-width characters and quotes off, dashes to '-', blanks squeezed."""
    c = F.regexp_replace(composed(_text(c)), r"[\x{200B}\x{200C}\x{200D}\x{FEFF}]", "")
    c = F.regexp_replace(c, r"[\x{2010}-\x{2015}\x{2212}]", "-")
    return squeeze(F.regexp_replace(c, "[\"'`«»‘’“”]", ""))


def legal_suffix(c: Column) -> tuple[Column, Column]:
    """(core, suffix) of a name; suffix '' if it has none of the table."""
    low = F.trim(F.lower(_text(c)))
    core, suffix = low, F.lit("")
    for name, pattern in reversed(SUFFIXES):
        end = rf"\s+{pattern}$"
        core = F.when(low.rlike(end), F.regexp_replace(low, end, "")).otherwise(core)
        suffix = F.when(low.rlike(end), F.lit(name)).otherwise(suffix)
    return core, suffix


def name_variants(c: Column) -> Column:
    """Stripped name, the same with SRL and with S.R.L., and the original; distinct, in this order."""
    core = squeeze(F.regexp_replace(_text(c), "(?i)" + TRAILING_FORM, ""))
    return F.array_distinct(F.array(core, F.concat(core, F.lit(" SRL")), F.concat(core, F.lit(" S.R.L.")), _text(c)))


def profile_slugs(name: Column, vat: Column) -> Column:
    """Slugs that a registry profile may have: core, core and suffix, either with the VAT number."""
    core, suffix = legal_suffix(name)
    slug = lambda x: F.regexp_replace(fold_text(x), " ", "-")
    full = F.when(suffix != "", F.concat_ws("-", slug(core), suffix))
    with_vat = lambda x: F.when(vat.isNotNull() & x.isNotNull(), F.concat_ws("-", x, vat))
    return F.array_distinct(F.array_compact(F.array(slug(core), full, with_vat(slug(core)), with_vat(full))))


def split_province(city: Column, name: Column) -> tuple[Column, Column]:
    """(city, code) of 'City (BS)', 'City - BS' or 'City/BS'; the code must be known, else it is looked for in the name."""
    found = F.regexp_extract(_text(city), r"^\s*(.*?)\s*(?:\(([A-Za-z]{2})\)|\s-\s*([A-Za-z]{2})|/\s*([A-Za-z]{2}))\s*$", 0)
    code = F.upper(F.regexp_extract(found, r"([A-Za-z]{2})\)?\s*$", 1))
    in_name = F.upper(F.regexp_extract(_text(name), r"\(([A-Za-z]{2})\)", 1))
    known = (found != "") & code.isin(PROVINCES)
    bare = F.trim(F.regexp_replace(_text(city), r"\s*(\([A-Za-z]{2}\)|\s-\s*[A-Za-z]{2}|/\s*[A-Za-z]{2})\s*$", ""))
    return F.when(known, bare).otherwise(F.trim(_text(city))), F.when(known, code).when(in_name.isin(PROVINCES), in_name)


def normalize_province(c: Column) -> Column:
    """Code of a known city, two letters upper, anything else as it is."""
    codes = F.create_map(*[F.lit(x) for pair in PROVINCE_OF.items() for x in pair])
    return F.coalesce(F.try_element_at(codes, F.lower(F.trim(c))), F.when(F.length(c) == 2, F.upper(c)).otherwise(c))


def _looked_up(pairs: dict[str, str], c: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair]), c)


def province_code(c: Column) -> Column:
    """Code of a province given by code or name, whatever the case; anything else upper."""
    bare = F.trim(c)
    named = _looked_up({n.lower(): k for k, n in (PROVINCE_NAMES | FORMER_PROVINCES).items()}, F.lower(bare))
    return F.when(F.upper(bare).isin(PROVINCES), F.upper(bare)).otherwise(F.coalesce(named, F.upper(bare)))


def province_name(c: Column) -> Column:
    """Name of a province given by code or name; null for any other."""
    return _looked_up(PROVINCE_NAMES | FORMER_PROVINCES, province_code(c))


def province_current(c: Column) -> Column:
    """Whether a province given by code or name is one today; null if it never was."""
    code = province_code(c)
    return F.when(code.isin([*PROVINCE_NAMES]), True).when(code.isin([*FORMER_PROVINCES]), False)


def normalize_cap(c: Column) -> Column:
    digits = F.regexp_replace(c, "[^0-9]", "")
    return F.when(F.length(digits) == 5, digits)


def normalize_city(c: Column) -> Column:
    return F.regexp_replace(F.trim(F.lower(_text(c))), "[.,]", "")


def address_tokens(c: Column) -> Column:
    """Words over two characters, without the street type and the number after a comma."""
    a = F.regexp_replace(F.lower(_text(c)), rf"^({'|'.join(STREET_TYPES)})\s+", "")
    return F.filter(F.split(F.regexp_replace(a, r",\s*\d+.*$", ""), r"\s+"), lambda t: F.length(t) > 2)


def fingerprint(name: Column, phone: Column, city: Column) -> Column:
    return F.md5(F.concat_ws("|", _text(name), _text(phone), _text(city)))


def slug(c: Column) -> Column:
    return F.regexp_replace(F.lower(_text(c)), "[^a-z0-9]", "")


def name_city_slug(name: Column, city: Column) -> Column:
    return F.concat_ws("_", slug(name), slug(city))


def input_quality(name: Column, city: Column, phone: Column, address: Column, email_domain: Column) -> Column:
    """0.5 for name and city, 0.2 for a business mail domain, 0.15 each for phone and address; 1 if all, 0.1 at least."""
    has = lambda c: F.length(F.trim(_text(c))) > 0
    score = lambda cond, p: F.when(cond, F.lit(p)).otherwise(F.lit(0.0))
    total = score(has(name) & has(city), 0.5) + score(has(email_domain), 0.2) + score(has(phone), 0.15) + score(has(address), 0.15)
    return F.when(has(name) & has(city) & has(email_domain) & has(phone) & has(address), F.lit(1.0)).otherwise(F.greatest(F.lit(0.1), F.round(total, 4)))


def normalize_entity(df: DataFrame) -> DataFrame:
    """Add the normalised columns that matching builds on: company, city, tokens, phones, VAT digits, fingerprint."""
    from quarrystone.functions.contacts import normalize_phones

    formatted, raw = normalize_phones(F.col("phone"))
    company, city = normalize_company(F.col("company_name")), normalize_city(F.col("city"))
    return df.withColumns(
        {
            "company": company,
            "city_norm": city,
            "address_tokens": address_tokens(F.col("address")),
            "phones": formatted,
            "raw_phones": raw,
            "vat_digits": F.regexp_replace(F.coalesce("vat", F.lit("")), "[^0-9]", ""),
            "fingerprint": fingerprint(company, F.coalesce(F.get(formatted, F.lit(0)), F.lit("")), city),
        }
    )
