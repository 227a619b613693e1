"""Phones, VAT numbers, e-mail addresses and URLs: Column -> Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mail providers that say nothing about a company, and certified-mail providers.
PUBLIC_MAIL = ["gmail.com", "hotmail.com", "hotmail.it", "yahoo.com", "yahoo.it", "libero.it", "virgilio.it", "tiscali.it", "alice.it", "tin.it", "outlook.com", "outlook.it", "live.it", "icloud.com"]
CERTIFIED_MAIL = ["pec.it", "legalmail.it", "arubapec.it", "postecert.it", "pecimprese.it", "cert.it"]
# Sites that are no company's own.
DIRECTORIES = [
    "paginegialle.it", "paginebianche.it", "yelp.it", "tripadvisor.it", "facebook.com", "instagram.com", "linkedin.com", "twitter.com", "virgilio.it", "kompass.com", "europages.com", "misterimprese.it",
    "prontopro.it", "habitissimo.it", "infojobs.it", "indeed.com", "glassdoor.it", "trovalavoro.it", "bakeca.it", "subito.it", "wikipedia.org", "amazon.it", "ebay.it", "groupon.it",
    "guidatitolari.it", "registroimprese.it", "ufficiocamerale.it", "informazione-aziende.it", "trovanumeri.com", "reteimprese.it", "area-clienti.com", "pagineimprese.it", "aziende.virgilio.it", "yelp.com", "linkedin.it",
]
BLACKLIST = ["facebook.com", "fb.com", "instagram.com", "twitter.com", "x.com", "linkedin.com", "youtube.com", "tiktok.com", "amazon.it", "amazon.com", "ebay.it", "ebay.com", "paginegialle.it", "paginebianche.it", "subito.it", "wikipedia.org", "google.com", "google.it", "bing.com"]
KEY_JUNK = ["facebook.com", "linkedin.com", "instagram.com", "twitter.com", "paginegialle.it", "paginebianche.it", "virgilio.it", "kompass.com", "europages.co", "tripadvisor.it", "consodata.it"]
SEARCH_ENGINES = ["google.com", "google.it", "bing.com", "duckduckgo.com"]

EMAIL = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
PHONE = r"(?:\+|00)?[0-9][0-9 ./()-]{6,18}[0-9]"
VAT_LABELLED = r"(?i)(?:P\.?\s*I\.?\s*V\.?\s*A\.?|Partita\s*Iva)[:\s]*(?:IT)?\s?(\d{11})"


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def digits(c: Column) -> Column:
    return F.regexp_replace(_text(c), "[^0-9]", "")


def normalize_phones(c: Column) -> tuple[Column, Column]:
    """(formatted, raw) arrays of a field's numbers, split at ';' and ' / ': 0039 to +39, +39 before 0 and 3; under five digits dropped."""
    cleaned = F.transform(F.split(_text(c), r";|\s/\s"), lambda p: F.regexp_replace(p, "[^0-9+]", ""))
    cleaned = F.transform(cleaned, lambda p: F.when(p.startswith("0039"), F.concat(F.lit("+"), F.substring(p, 3, 1000))).otherwise(p))
    kept = F.filter(cleaned, lambda p: F.length(F.regexp_replace(p, "[+]", "")) >= 5)
    formatted = F.transform(kept, lambda p: F.when(p.startswith("0") | p.startswith("3"), F.concat(F.lit("+39"), p)).otherwise(p))
    return F.array_distinct(formatted), F.array_distinct(F.transform(kept, lambda p: F.regexp_replace(p, "[+]", "")))


def phone_e164(c: Column) -> tuple[Column, Column]:
    """(+39 number, valid): a rule subset for Italy, mobile 3 and 8 or 9 digits, landline 0 and 5 to 10 digits."""
    bare = F.regexp_replace(F.regexp_replace(_text(c), "[^0-9+]", ""), r"^(\+39|0039)", "")
    valid = bare.rlike(r"^(3[0-9]{8,9}|0[0-9]{5,10})$")
    return F.when(valid, F.concat(F.lit("+39"), bare)), valid


def extract_phones(text: Column) -> Column:
    """Distinct digit strings of 9 to 15 digits that look like Italian numbers, in order of appearance."""
    found = F.transform(F.regexp_extract_all(_text(text), F.lit(PHONE), F.lit(0)), lambda p: F.regexp_replace(F.regexp_replace(p, "[^0-9]", ""), "^00", ""))
    return F.array_distinct(F.filter(found, lambda p: F.length(p).between(9, 15) & p.rlike("^(39|0|3)")))


def phone_variants(c: Column) -> Column:
    """A number's digits with and without 39 and the leading 0."""
    d = F.regexp_replace(digits(c), "^00", "")
    bare = F.regexp_replace(d, "^39", "")
    return F.array_distinct(F.filter(F.array(d, bare, F.concat(F.lit("39"), bare), F.regexp_replace(bare, "^0", "")), lambda x: F.length(x) > 0))


def phones_match(a: Column, b: Column) -> Column:
    """Some variants are equal, or one ends with the other, of eight digits at least."""
    va, vb = phone_variants(a), phone_variants(b)
    tail = F.exists(va, lambda x: F.exists(vb, lambda y: (F.least(F.length(x), F.length(y)) >= 8) & (x.endswith(y) | y.endswith(x))))
    return F.arrays_overlap(va, vb) | tail


def vat_checksum(c: Column) -> Column:
    """Eleven digits that pass the Luhn check; false for null."""
    d = digits(c)
    return (F.length(d) == 11) & F.call_function("luhn_check", F.when(F.length(d) == 11, d).otherwise(F.lit("1")))


def normalize_vat(c: Column, strict_reference: bool = False) -> Column:
    """Letters and digits, upper case; IT off before eleven digits (with ``strict_reference`` only if longer than that)."""
    v = F.upper(F.regexp_replace(_text(c), "[^A-Za-z0-9]", ""))
    if strict_reference:
        v = F.when(v.startswith("IT") & (F.length(v) > 13), F.substring(v, 3, 1000)).otherwise(v)
    else:
        v = F.regexp_replace(v, "^IT([0-9]{11})$", "$1")
    return F.when(F.length(v) >= 5, v)


def extract_vats(text: Column) -> Column:
    """Distinct numbers: standalone with a known office code, labelled, and with the prefix IT."""
    t = _text(text)
    office = lambda v: F.substring(v, 8, 3).cast("int")
    alone = F.filter(F.regexp_extract_all(t, F.lit(r"\b(\d{11})\b"), F.lit(1)), lambda v: office(v).between(1, 100) | office(v).isin(120, 121, 888, 999))
    return F.array_distinct(F.concat(alone, F.regexp_extract_all(t, F.lit(VAT_LABELLED), F.lit(1)), F.regexp_extract_all(t, F.lit(r"\bIT\s?(\d{11})\b"), F.lit(1))))


def extract_emails(text: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(_text(text), F.lit(EMAIL), F.lit(0)), F.lower))


def extract_pec(text: Column) -> Column:
    """The first address at a certified-mail provider."""
    return F.get(F.filter(extract_emails(text), lambda m: F.exists(F.array(*[F.lit(p) for p in CERTIFIED_MAIL]), lambda p: m.endswith(p))), F.lit(0))


def business_email_domain(c: Column) -> Column:
    """Domain of a valid address, unless public or certified mail."""
    m = F.lower(F.trim(_text(c)))
    domain = F.substring_index(m, "@", -1)
    certified = F.lit(False)
    for p in CERTIFIED_MAIL:
        certified = certified | (domain == p) | domain.endswith("." + p)
    return F.when(m.rlike(f"^{EMAIL}$") & ~domain.isin(PUBLIC_MAIL) & ~certified, domain)


def email_candidates(first: Column, last: Column, domain: Column) -> Column:
    """Eleven usual patterns for a person's address."""
    f, s = F.regexp_replace(F.lower(_text(first)), "[^a-z]", ""), F.regexp_replace(F.lower(_text(last)), "[^a-z]", "")
    fi, si = F.substring(f, 1, 1), F.substring(s, 1, 1)
    parts = [F.concat(f, F.lit("."), s), F.concat(s, F.lit("."), f), F.concat(f, s), F.concat(s, f), F.concat(fi, F.lit("."), s), F.concat(fi, s), F.concat(f, F.lit("."), si), F.concat(f, si), f, s, F.concat(f, F.lit("_"), s)]
    return F.transform(F.array(*parts), lambda x: F.concat(x, F.lit("@"), domain))


def host(url: Column) -> Column:
    """Host of a URL (with or without scheme), lower case, leading www. off; null if it has none."""
    u = F.trim(_text(url))
    h = F.lower(F.regexp_extract(u, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*://)?(?:[^/?#@]*@)?([^/?#:@]+)", 1))
    h = F.regexp_replace(h, r"^www\.", "")
    return F.when(h.rlike(r"^[a-z0-9\x{A1}-\x{FFFF}-]+(\.[a-z0-9\x{A1}-\x{FFFF}-]+)+$"), h)


def root_domain(url: Column) -> Column:
    return host(url)


def canonical_url(url: Column) -> Column:
    """Scheme, host and path without a trailing slash; the text itself if it is no URL."""
    u = F.trim(_text(url))
    got = F.regexp_extract(u, r"^(https?://[^/?#]+[^?#]*)", 1)
    return F.when(got == "", u).otherwise(F.regexp_replace(got, "/+$", ""))


def site_root(url: Column) -> Column:
    """Scheme and host; null for search engines and PDFs."""
    got = F.regexp_extract(F.trim(_text(url)), r"^(https?://[^/?#]+)", 1)
    bad = is_listed(url, SEARCH_ENGINES) | F.lower(_text(url)).rlike(r"\.pdf($|[?#])")
    return F.when((got != "") & ~bad, got)


def url_key(url: Column) -> Column:
    """Host and path in lower case as a merge key; null for junk sites and what is no domain."""
    u = F.regexp_replace(F.lower(F.trim(_text(url))), "/$", "")
    u = F.regexp_replace(F.regexp_replace(u, "^https?://", ""), r"^www\.", "")
    junk = F.lit(False)
    for d in KEY_JUNK:
        junk = junk | u.contains(d)
    return F.when(u.contains(".") & (F.length(u) >= 4) & ~junk, u)


def nav_targets(url: Column) -> Column:
    """https and http, without and with www, in the order they are tried."""
    h = host(url)
    return F.when(h.isNotNull(), F.array(*[F.concat(F.lit(p), h) for p in ("https://", "https://www.", "http://", "http://www.")]))


def host_suffixes(url: Column) -> Column:
    """The host and every parent domain of two labels at least: a key for suffix joins."""
    labels = F.split(host(url), r"\.")
    return F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def is_listed(url: Column, domains: list[str]) -> Column:
    """The host is one of the domains or a subdomain of one; false without a host."""
    return F.coalesce(F.arrays_overlap(host_suffixes(url), F.array(*[F.lit(d) for d in domains])), F.lit(False))


def is_directory_or_social(url: Column) -> Column:
    """Listed directory or social site; what is no URL counts as one."""
    return host(url).isNull() | is_listed(url, DIRECTORIES)


def is_domain_blacklisted(url: Column) -> Column:
    return is_listed(url, BLACKLIST)
