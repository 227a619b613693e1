"""Predicates and extraction on page texts, titles, messages: Column -> Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarrystone.functions.contacts import extract_emails, extract_phones, extract_vats, host, is_listed
from quarrystone.functions.similarity import any_of

# Phrases that mark a page or title.
DIRECTORY_TITLES = ["elenco aziende", "elenco imprese", "trova aziende", "directory aziende", "directory imprese", "imprese in", "recensioni di", "scheda azienda -", "professionisti nella tua zona", "preventivo gratuito", "richiedi preventivo online"]
PARKING = ["domain is for sale", "buy this domain", "questo dominio è in vendita", "domain parked", "godaddy", "sedo", "dan.com", "afternic", "huge domains", "domain name is available", "acquista questo dominio", "is available for purchase", "under verification", "sito in costruzione"]
PARKED_START = ["domain is for sale", "sedo.com", "is parked", "this domain name", "hugedomains", "dan.com", "domain name has been registered"]
CONSTRUCTION = ["coming soon", "lavori in corso", "sito in manutenzione", "website under construction", "stiamo arrivando", "work in progress", "sito in allestimento", "torneremo presto"]
STOP_WORDS = {"it": [" il ", " lo ", " la ", " i ", " gli ", " le ", " di ", " a ", " da ", " in ", " con ", " su ", " per ", " tra ", " fra ", " è ", " sono ", " siamo ", " azienda ", " contatti ", " chi siamo ", " dove siamo ", " home ", " servizi ", " prodotti "]}
CAPTCHA = ["captcha", "recaptcha", "hcaptcha", "turnstile", "unusual traffic", "traffico insolito", "/sorry/", "verify you are human", "verifica di essere umano", "challenge-platform", "cf-challenge", "challenge-form"]
CHALLENGE = ["access denied", "accesso negato", "forbidden", "please enable javascript", "checking your browser", "just a moment", "attention required", "bot detection", "automated access"]
SOCIAL_SITES = ["facebook.com", "instagram.com", "linkedin.com", "twitter.com", "x.com", "youtube.com", "tiktok.com"]
DIRECTORY_SITES = ["paginegialle.it", "paginebianche.it", "virgilio.it", "kompass.com", "europages.com", "tripadvisor.it", "yelp.it"]
MARKETPLACES = ["amazon.it", "amazon.com", "ebay.it", "ebay.com", "subito.it", "etsy.com"]
CORPORATE_SIGNS = ["p.iva", "partita iva", "chi siamo", "contatti", "privacy"]


def _low(c: Column) -> Column:
    return F.lower(F.coalesce(c, F.lit("")))


def first_of(text: Column, phrases: list[str]) -> Column:
    """The first phrase of the list that the text holds, else null."""
    return F.coalesce(*[F.when(F.contains(text, F.lit(p)), F.lit(p)) for p in phrases])


def is_directory_title(title: Column) -> Column:
    return any_of(_low(title), DIRECTORY_TITLES)


def content_validity(text: Column) -> tuple[Column, Column]:
    """(valid, reason): a parking phrase, or in a text under 500 characters a construction phrase, makes it invalid."""
    low = _low(text)
    parked, built = first_of(low, PARKING), F.when(F.length(low) < 500, first_of(low, CONSTRUCTION))
    reason = F.coalesce(F.concat(F.lit("Parking Page detected: "), parked), F.concat(F.lit("Under Construction detected: "), built))
    return reason.isNull(), reason


def is_parked(html: Column, body: Column | None = None) -> Column:
    """Signatures in the first 2048 characters, parking phrases in the first 5000, or a body under 100 characters."""
    body = html if body is None else body
    low = _low(html)
    return any_of(F.substring(low, 1, 2048), PARKED_START) | any_of(F.substring(low, 1, 5000), PARKING) | (F.length(F.coalesce(body, F.lit(""))) < 100)


def trap_check(html: Column, links: int = 500) -> tuple[Column, Column]:
    """(link farm, parked)"""
    return F.regexp_count(_low(html), F.lit("<a\\s")) > links, any_of(_low(html), PARKING)


def stopword_language(text: Column, lang: str = "it") -> Column:
    """Under 120 characters: true; else four of the stop words (three in texts over 2000 characters)."""
    low = _low(text)
    hits = sum(F.contains(low, F.lit(w)).cast("int") for w in STOP_WORDS[lang])
    return (F.length(low) < 120) | (hits >= F.when(F.length(low) > 2000, F.lit(3)).otherwise(F.lit(4)))


def keyword_relevance(text: Column, keywords: list[str]) -> tuple[Column, Column, Column]:
    """(match, matched keywords, share); an empty text or list matches with 1."""
    if not keywords:
        return F.lit(True), F.array().cast("array<string>"), F.lit(1.0)
    empty = F.length(F.coalesce(text, F.lit(""))) == 0
    found = F.array_compact(F.array(*[F.when(F.contains(_low(text), F.lit(k.lower())), F.lit(k)) for k in keywords]))
    return empty | (F.size(found) > 0), found, F.when(empty, F.lit(1.0)).otherwise(F.size(found) / len(keywords))


def classify_site(url: Column, content: Column) -> tuple[Column, Column]:
    """(site type, parking phrases): listed directory, social site or marketplace; two parking phrases; two corporate
    signs; a text under 200 characters is unknown; else corporate."""
    low = _low(content)
    parked = sum(F.contains(low, F.lit(p)).cast("int") for p in PARKING)
    corporate = sum(F.contains(low, F.lit(p)).cast("int") for p in CORPORATE_SIGNS)
    kind = (
        F.when(is_listed(url, DIRECTORY_SITES), "DIRECTORY")
        .when(is_listed(url, SOCIAL_SITES), "SOCIAL")
        .when(is_listed(url, MARKETPLACES), "MARKETPLACE")
        .when(parked >= 2, "PARKED")
        .when(corporate >= 2, "CORPORATE")
        .when(F.length(low) < 200, "UNKNOWN")
        .otherwise("CORPORATE")
    )
    return kind, parked


def classify_block(status: Column, body: Column) -> tuple[Column, Column]:
    """(block type, raw signal) of a response."""
    low, length = _low(body), F.length(F.coalesce(body, F.lit("")))
    captcha, challenge = any_of(low, CAPTCHA), any_of(low, CHALLENGE)
    blank = (length < 200) & status.between(200, 299)
    kind = (
        F.when(status == 429, "RATE_LIMIT_429").when((status == 403) & captcha, "CAPTCHA").when(status == 403, "WAF_403").when(status == 0, "CONNECTION_REFUSED")
        .when(captcha, "CAPTCHA").when(challenge, "CHALLENGE_PAGE").when(blank, "EMPTY_RESPONSE").otherwise("NONE")
    )
    signal = (
        F.when(status == 429, "429").when((status == 403) & captcha, "403+captcha_signals").when(status == 403, "403").when(status == 0, "connection_error")
        .when(captcha, "captcha_in_body").when(challenge, "challenge_page").when(blank, F.concat(F.lit("body_len="), length.cast("string")))
    )
    return kind, signal


def block_domain(url: Column) -> Column:
    return F.coalesce(host(url), F.lit("unknown"))


def classify_fetch_error(message: Column) -> Column:
    low = _low(message)
    return F.when(any_of(low, ["timeout", "timed out", "navigation timeout"]), "TIMEOUT").when(any_of(low, ["econnrefused", "econnreset", "enotfound"]), "CONNECTION_REFUSED").otherwise("CHALLENGE_PAGE")


def error_category(message: Column) -> Column:
    low = _low(message)
    return (
        F.when(any_of(low, ["timeout", "econnrefused", "enotfound", "socket"]), "NETWORK")
        .when(any_of(low, ["browser", "puppeteer", "target closed", "detached"]), "BROWSER")
        .when(any_of(low, ["parse", "unexpected token", "json"]), "PARSING")
        .when(any_of(low, ["validation", "zod", "invalid"]), "VALIDATION")
        .when(any_of(low, ["401", "403", "429", "api key", "rate limit"]), "AUTH")
        .otherwise("LOGIC")
    )


# Reason codes of error categories, and of phrases in a message in the order they are looked for.
REASON_OF_CATEGORY = {"NETWORK": "ERROR_TIMEOUT_FETCH", "AUTH": "ERROR_PROVIDER_RATE_LIMIT", "BROWSER": "ERROR_BROWSER_FAILURE", "PARSING": "ERROR_PARSING", "VALIDATION": "ERROR_VALIDATION"}
REASON_OF_ERROR = [(["timeout"], "ERROR_TIMEOUT_FETCH"), (["403", "blocked", "captcha"], "ERROR_BLOCKED_403"), (["dns", "enotfound"], "REJECTED_NO_MATCHING_SIGNALS"), (["429", "rate"], "ERROR_PROVIDER_RATE_LIMIT")]
REASON_OF_EXCEPTION = [
    (["timeout", "timed out"], "ERROR_TIMEOUT_FETCH"), (["429", "rate limit"], "ERROR_PROVIDER_RATE_LIMIT"), (["403", "blocked", "captcha"], "ERROR_BLOCKED_403"), (["busy"], "ERROR_DB_BUSY"),
    (["config", "invalid"], "ERROR_CONFIG_INVALID"),
]
REASON_OF_VERIFICATION = [
    (["directory", "social"], "REJECTED_DIRECTORY_OR_SOCIAL"), (["browser verification disabled"], "ERROR_BROWSER_DISABLED"), (["timeout", "navigation"], "ERROR_TIMEOUT_FETCH"),
    (["403", "blocked", "captcha"], "ERROR_BLOCKED_403"), (["rate"], "ERROR_PROVIDER_RATE_LIMIT"),
]
REASON_OF_STATUS = {
    "OK": "OK_LIKELY_NAME_CITY_MATCH", "OK_LIKELY": "OK_LIKELY_NAME_CITY_MATCH", "REJECTED_DIRECTORY": "REJECTED_DIRECTORY_OR_SOCIAL", "ERROR_TIMEOUT": "ERROR_TIMEOUT_FETCH", "ERROR_BLOCKED": "ERROR_BLOCKED_403",
    "ERROR_DNS": "REJECTED_NO_MATCHING_SIGNALS", "ERROR_FETCH": "ERROR_TIMEOUT_FETCH",
}


def _by_phrase(text: Column, rules: list[tuple[list[str], str]]) -> Column:
    return F.coalesce(*[F.when(any_of(text, phrases), F.lit(code)) for phrases, code in rules])


def _by_value(c: Column, codes: dict[str, str]) -> Column:
    return F.coalesce(*[F.when(c == k, F.lit(v)) for k, v in codes.items()])


def reason_of_category(category: Column) -> Column:
    return F.coalesce(_by_value(category, REASON_OF_CATEGORY), F.lit("ERROR_INTERNAL"))


def reason_of_error(message: Column) -> Column:
    return F.coalesce(_by_phrase(_low(message), REASON_OF_ERROR), F.lit("ERROR_INTERNAL"))


def reason_of_exception(message: Column) -> Column:
    return F.coalesce(_by_phrase(_low(message), REASON_OF_EXCEPTION), F.lit("ERROR_INTERNAL"))


def reason_of_status(status: Column, reason: Column) -> Column:
    """Reason code of a decision's status; without a domain it depends on whether there were candidates."""
    none = F.when(F.contains(_low(reason), F.lit("no candidates")), "NOT_FOUND_NO_CANDIDATES").otherwise("REJECTED_NO_MATCHING_SIGNALS")
    return F.coalesce(F.when(status == "NO_DOMAIN_FOUND", none), _by_value(status, REASON_OF_STATUS), F.lit("ERROR_INTERNAL"))


def reason_of_verification(reason: Column, confidence: Column, vat: Column, phone: Column, schema: Column, least: float = 0.75) -> Column:
    """Reason code of a checked site: the proof it has, else what went wrong, else by its confidence."""
    c = F.coalesce(confidence, F.lit(0.0))
    proof = F.when(vat, "OK_CONFIRMED_VAT_MATCH").when(phone, "OK_CONFIRMED_PHONE_MATCH").when(schema, "OK_CONFIRMED_SCHEMAORG_URL")
    rest = F.when(c >= least, "OK_LIKELY_NAME_CITY_MATCH").when(c > 0, "REJECTED_NO_MATCHING_SIGNALS").otherwise("NOT_FOUND_NO_CANDIDATES")
    return F.coalesce(proof, _by_phrase(_low(reason), REASON_OF_VERIFICATION), rest)


def is_valid_company_page(html: Column) -> Column:
    low = _low(html)
    return F.contains(low, F.lit("fatturato")) & any_of(low, ["partita iva", "p.iva", "codice fiscale"])


def likely_official_url(href: Column, directory: str) -> Column:
    return F.coalesce(F.lower(href).rlike("^https?://"), F.lit(False)) & ~is_listed(href, [directory]) & host(href).isNotNull()


def contacts_from_text(text: Column) -> Column:
    return F.struct(extract_emails(text).alias("emails"), extract_phones(text).alias("phones"), extract_vats(text).alias("vats"))


def _first(text: Column, patterns: list[str]) -> Column:
    return F.coalesce(*[F.nullif(F.trim(F.regexp_extract(F.coalesce(text, F.lit("")), p, 1)), F.lit("")) for p in patterns])


# Patterns of figures in a text, in the order they are tried.
REVENUE = [
    r"(?i)fatturato\s*(?:\(\d{4}\))?\s*(?:di)?\s*(?:circa)?\s*[:\s]*€?\s*([\d.,]+\s*(?:mln|milioni|mila|k|M|€)?)",
    r"(?i)ricavi\s*[:\s]*€?\s*([\d.,]+\s*(?:mln|milioni|mila|k|M|€)?)",
    r"(?i)volume\s*d['’]affari\s*[:\s]*€?\s*([\d.,]+\s*(?:mln|milioni|mila|k|M|€)?)",
]
EMPLOYEES = [r"(?i)(?:dipendenti|numero\s*dipendenti)\s*(?:\(\d{4}\))?\s*[:\s]*([\d\-.]+)", r"(?i)organico\s*[:\s]*([\d\-.]+)", r"(?i)addetti\s*[:\s]*([\d\-.]+)", r"(?i)(\d+(?:-\d+)?)\s*dipendenti"]


def financials(text: Column) -> Column:
    """Struct of revenue, employees, year: the first match of ordered patterns, as written."""
    year = _first(text, [r"(?i)fatturato[^\n]{0,40}?\b(20[12]\d)\b", r"\b(20[12]\d)\b"])
    return F.struct(_first(text, REVENUE).alias("revenue"), _first(text, EMPLOYEES).alias("employees"), year.alias("year"))


def snippet_revenue(text: Column) -> tuple[Column, Column]:
    """(amount, year) of a result snippet: an amount with '.' thousands, and a year of 2010 to 2029."""
    amount = F.regexp_extract(F.coalesce(text, F.lit("")), r"(\d{1,3}(?:\.\d{3})+)", 1)
    return F.regexp_replace(amount, r"\.", "").try_cast("long"), F.regexp_extract(F.coalesce(text, F.lit("")), r"\b(20[12]\d)\b", 1).try_cast("int")


def clean_currency(c: Column) -> Column:
    return F.nullif(F.regexp_replace(c, "[^0-9,-]", ""), F.lit(""))


def title_parts(c: Column) -> tuple[Column, Column]:
    """First two parts of a title split at '|' and ' - '; null if shorter than two or longer than 80 characters."""
    parts = F.transform(F.split(F.coalesce(c, F.lit("")), r"\||\s[-–]\s"), lambda p: F.trim(p))
    guard = lambda p: F.when(F.length(p).between(2, 80), p)
    return guard(F.get(parts, F.lit(0))), guard(F.get(parts, F.lit(1)))


def embedded_site(title: Column, html: Column, own: list[str]) -> Column:
    """The site named after 'sito' or 'web' in a title, else the first outbound link that is no listed site."""
    named = F.nullif(F.regexp_extract(_low(title), r"(?:sito|web)\s*:?\s*((?:www\.)?[a-z0-9-]+(?:\.[a-z0-9-]+)+)", 1), F.lit(""))
    links = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit("(?i)href=[\"'](https?://[^\"']+)[\"']"), F.lit(1))
    return F.coalesce(named, F.get(F.filter(links, lambda x: ~is_listed(x, [*own, *SOCIAL_SITES])), F.lit(0)))


def first_line_title(text: Column) -> Column:
    """First line that isn't blank, without leading '#'."""
    return F.nullif(F.trim(F.regexp_extract(F.coalesce(text, F.lit("")), r"(?s)^\s*#*[ \t]*([^\n]*)", 1)), F.lit(""))


def minify_html(html: Column) -> Column:
    """Scripts, styles, comments and tags off, blanks squeezed."""
    h = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<(script|style|noscript)[^>]*>.*?</(script|style|noscript)>|<!--.*?-->", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(h, r"(?s)<[^>]*>", " "), r"\s+", " "))


def evidence_links(links: Column, base: Column) -> Column:
    """Links of the same host with a contact or privacy word."""
    return F.filter(links, lambda x: (host(x) == host(base)) & F.lower(x).rlike("contatt|contact|privacy|chi-siamo|about"))
