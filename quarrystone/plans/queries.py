"""Registered queries over the given tables, and the same in SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrystone.functions import contacts as C
from quarrystone.functions import content as P
from quarrystone.functions import names as N
from quarrystone.functions import scoring as S
from quarrystone.functions import similarity as M
from quarrystone.functions.sql import register
from quarrystone.operators import frontier as G
from quarrystone.operators import joins as J
from quarrystone.operators import pages as H
from quarrystone.operators import ranking as W
from quarrystone.operators import resolve as D
from quarrystone.operators import telemetry as A
from quarrystone.plans.roles import role, role_sql
from quarrystone.session import materialize, shared_dir
from quarrystone.sources import files as IO
from quarrystone.sources import tables as IO_TABLES
from quarrystone.streaming import jobs as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    def register(f: Callable) -> Callable:
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return register


def joined(c: Column) -> Column:
    return F.array_join(F.sort_array(c), ",")


COMPANIES, CANDIDATES, LEDGER, LEADS, REPORTS, RESPONSES, PROFILES = (role_sql(x) for x in ("companies", "candidates", "ledger", "leads", "reports", "responses", "profiles"))
q = lambda s: s.replace("'", "''")
words = lambda xs: "[" + ", ".join(f"'{q(x)}'" for x in xs) + "]"
alternatives = "|".join
squeeze = lambda x: f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"
list_join = lambda x: f"coalesce(array_to_string(list_sort({x}), ','), '')"
sql_fold = lambda x: f"trim(regexp_replace(translate(lower(coalesce({x}, '')), '{N.ACCENTED}', '{N.PLAIN}'), '[^a-z0-9]+', ' ', 'g'))"
sql_tokens = lambda x: f"list_filter(string_split({sql_fold(x)}, ' '), lambda t: length(t) >= 2 AND NOT list_contains({words(N.FILLER_WORDS)}, t))"
sql_clean = lambda x: squeeze(f"regexp_replace(regexp_replace(lower({x}), '{N.TRAILING_FORM}', ''), '[^a-z0-9_\\s]', '', 'g')")
sql_slug = lambda x: f"regexp_replace(lower(coalesce({x}, '')), '[^a-z0-9]', '', 'g')"
sql_digits = lambda x: f"regexp_replace(coalesce({x}, ''), '[^0-9]', '', 'g')"
sql_host = lambda x: f"regexp_replace(lower(regexp_extract({x}, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*://)?([^/?#:@]+)', 1)), '^www\\.', '')"
listed = lambda h, xs: "(" + " OR ".join(f"{h} = '{d}' OR {h} LIKE '%.{d}'" for d in xs) + ")"
sql_norm = squeeze(
    "regexp_replace(regexp_replace(regexp_replace(regexp_replace(' ' || regexp_replace(trim(lower(company_name)), '\\s+', '  ', 'g') || ' ', "
    f"'\\s({q(N.LEGAL_FORM)})\\s', '  ', 'g'), '[.,/\\-&()]', ' ', 'g'), '\\b({alternatives(N.TRADE_WORDS)})\\b', '', 'g'), '\\b({alternatives(N.ARTICLES)})\\b', '', 'g')"
)


# --- names -----------------------------------------------------------------------------------------------------------
@query(
    "names",
    f"""SELECT row_id, {sql_norm} AS normalized, {sql_clean("company_name")} AS cleaned, {sql_fold("company_name")} AS folded, {list_join(sql_tokens("company_name"))} AS tokens,
      {squeeze("regexp_replace(company_name, '(?i)" + N.TRAILING_FORM + "', '')")} AS variant, {sql_slug("company_name")} || '_' || {sql_slug("city")} AS slug,
      md5({sql_norm} || '||' || replace(replace(lower(trim(city)), '.', ''), ',', '')) AS fingerprint FROM {COMPANIES}""",
)
def names(spark, d):
    name, city = F.col("company_name"), F.col("city")
    return role(spark, d, "companies").select(
        "row_id", N.normalize_company(name).alias("normalized"), N.clean_company_name(name).alias("cleaned"), N.fold_text(name).alias("folded"), joined(N.name_tokens(name)).alias("tokens"),
        N.name_variants(name)[0].alias("variant"), N.name_city_slug(name, city).alias("slug"), N.fingerprint(N.normalize_company(name), F.lit(""), N.normalize_city(city)).alias("fingerprint"),
    )


@query(
    "places",
    f"""SELECT row_id, CASE WHEN city LIKE '%(BS)' THEN 'Brescia' ELSE city END AS bare_city, CASE WHEN city LIKE '%(BS)' THEN 'BS' END AS code,
      CASE province WHEN 'MI' THEN 'MI' WHEN 'rm' THEN 'RM' WHEN 'Torino' THEN 'TO' END AS province, lower(category) || ',' AS address,
      CASE WHEN row_id % 3 = 0 THEN '20' || lpad((row_id % 1000)::VARCHAR, 3, '0') WHEN row_id >= 10000 AND row_id < 100000 THEN row_id::VARCHAR END AS cap, replace(replace(lower(trim(city)), '.', ''), ',', '') AS city_norm FROM {COMPANIES}""",
)
def places(spark, d):
    bare, code = N.split_province(F.col("city"), F.col("company_name"))
    return role(spark, d, "companies").select(
        "row_id", bare.alias("bare_city"), code.alias("code"), N.normalize_province(F.col("province")).alias("province"), F.concat(F.array_join(N.address_tokens(F.concat(F.lit("Via "), "category", F.lit(" "), (F.col("row_id") % 90 + 1).cast("string"))), ","), F.lit(",")).alias("address"),
        N.normalize_cap(F.when(F.col("row_id") % 3 == 0, F.concat(F.lit(" 20"), F.lpad((F.col("row_id") % 1000).cast("string"), 3, "0"))).otherwise(F.col("row_id").cast("string"))).alias("cap"), N.normalize_city(F.col("city")).alias("city_norm"),
    )


_provinces = "(VALUES " + ", ".join(f"('{k}', '{q(n)}')" for k, n in N.PROVINCE_NAMES.items()) + ") v(code, name)"


@query(
    "provinces",
    f"""SELECT row_id, coalesce((SELECT code FROM {_provinces} WHERE code = upper(trim(province))), (SELECT code FROM {_provinces} WHERE lower(name) = lower(trim(province))), upper(trim(province))) AS code,
      (SELECT code FROM {_provinces} WHERE lower(name) = lower(trim(city))) AS code_of_city, (SELECT name FROM {_provinces} WHERE code = upper(trim(province)) OR lower(name) = lower(trim(province))) AS name FROM {COMPANIES}""",
)
def provinces(spark, d):
    of_city = F.when(F.lower(F.trim("city")).isin([n.lower() for n in N.PROVINCE_NAMES.values()]), N.province_code(F.col("city")))
    return role(spark, d, "companies").select("row_id", N.province_code(F.col("province")).alias("code"), of_city.alias("code_of_city"), N.province_name(F.col("province")).alias("name"))


_stated = "CASE row_id % 7 WHEN 0 THEN 'OG' WHEN 1 THEN ' su' WHEN 2 THEN 'Olbia-Tempio' WHEN 3 THEN 'vs' WHEN 4 THEN 'ZZ' WHEN 5 THEN city ELSE 'Milano' END"


@query(
    "province_flags",
    f"""SELECT row_id, company_name, coalesce(v.code, upper(trim(p))) AS code, v.name AS name, v.current AS current FROM (SELECT row_id, company_name, {_stated} AS p FROM {COMPANIES}) c
      LEFT JOIN (SELECT *, true AS current FROM {_provinces} UNION ALL SELECT *, false FROM (VALUES {", ".join(f"('{k}', '{q(n)}')" for k, n in N.FORMER_PROVINCES.items())}) f(code, name)) v ON v.code = upper(trim(p)) OR lower(v.name) = lower(trim(p))""",
)
def province_flags(spark, d):
    """Provinces as records state them: of today, of former times, by name, by a city's name, and none."""
    p = F.expr(_stated)
    return role(spark, d, "companies").select("row_id", "company_name", N.province_code(p).alias("code"), N.province_name(p).alias("name"), N.province_current(p).alias("current"))


@query("clean_inputs", f"SELECT row_id, trim(regexp_replace(company_name, '\\s+', ' ', 'g')) AS name, replace(regexp_replace(nfc_normalize(city), '\\s+', ' ', 'g'), '\"', '') AS city FROM {COMPANIES}")
def clean_inputs(spark, d):
    """Names are given decomposed, as some exports are."""
    c = role(spark, d, "companies")
    apart = F.replace(F.col("company_name"), F.lit("ì"), F.lit("i\u0300"))
    return c.select("row_id", N.clean_input(F.concat(F.lit("\u200b"), apart, F.lit('"'))).alias("name"), N.clean_input(F.col("city")).alias("city"))


# --- contacts --------------------------------------------------------------------------------------------------------
_parts = "list_filter(list_transform(list_transform(string_split_regex(coalesce(phone, ''), ';|\\s/\\s'), lambda p: regexp_replace(p, '[^0-9+]', '', 'g')), lambda p: CASE WHEN starts_with(p, '0039') THEN '+' || substr(p, 3) ELSE p END), lambda p: length(replace(p, '+', '')) >= 5)"
_luhn = lambda v: f"list_sum(list_transform(range(1, 12), lambda i: CASE WHEN i % 2 = 1 THEN substr({v}, i::INT, 1)::INT ELSE (CASE WHEN 2 * substr({v}, i::INT, 1)::INT > 9 THEN 2 * substr({v}, i::INT, 1)::INT - 9 ELSE 2 * substr({v}, i::INT, 1)::INT END) END)) % 10 = 0"
_junk = " OR ".join(f"contains(k, '{d}')" for d in C.KEY_JUNK)


@query(
    "contacts",
    f"""SELECT row_id, {list_join(f"list_distinct(list_transform({_parts}, lambda p: CASE WHEN starts_with(p, '0') OR starts_with(p, '3') THEN '+39' || p ELSE p END))")} AS phones,
      {list_join(f"list_distinct(list_transform({_parts}, lambda p: replace(p, '+', '')))")} AS raw_phones,
      regexp_matches(regexp_replace(regexp_replace(phone, '[^0-9+]', '', 'g'), '^(\\+39|0039)', ''), '^(3[0-9]{{8,9}}|0[0-9]{{5,10}})$') AS e164_valid,
      regexp_replace(vat, '^IT', '') AS vat_norm, coalesce({_luhn("regexp_replace(vat, '^IT', '')")}, false) AS vat_ok,
      CASE WHEN row_id % 3 <> 1 THEN split_part(email, '@', 2) END AS business_domain FROM {COMPANIES}""",
)
def contacts(spark, d):
    formatted, raw = C.normalize_phones(F.col("phone"))
    return role(spark, d, "companies").select(
        "row_id", joined(formatted).alias("phones"), joined(raw).alias("raw_phones"), C.phone_e164(F.col("phone"))[1].alias("e164_valid"), C.normalize_vat(F.col("vat")).alias("vat_norm"),
        C.vat_checksum(F.col("vat")).alias("vat_ok"), C.business_email_domain(F.col("email")).alias("business_domain"),
    )


@query(
    "urls",
    f"""SELECT row_id, h AS root_domain, CASE WHEN {_junk} OR NOT contains(k, '.') OR length(k) < 4 THEN NULL ELSE k END AS url_key, regexp_replace(regexp_extract(website, '^(https?://[^/?#]+[^?#]*)', 1), '/+$', '') AS canonical,
      regexp_extract(website, '^(https?://[^/?#]+)', 1) AS site_root, {listed("h", C.DIRECTORIES)} AS is_directory, {listed("h", C.BLACKLIST)} AS is_blacklisted,
      'https://' || h || ',https://www.' || h || ',http://' || h || ',http://www.' || h AS targets
      FROM (SELECT *, {sql_host("website")} AS h, regexp_replace(regexp_replace(regexp_replace(lower(trim(website)), '/$', ''), '^https?://', ''), '^www\\.', '') AS k FROM {COMPANIES} WHERE website IS NOT NULL)""",
)
def urls(spark, d):
    u = F.col("website")
    return role(spark, d, "companies").where("website is not null").select(
        "row_id", C.root_domain(u).alias("root_domain"), C.url_key(u).alias("url_key"), C.canonical_url(u).alias("canonical"), C.site_root(u).alias("site_root"),
        C.is_directory_or_social(u).alias("is_directory"), C.is_domain_blacklisted(u).alias("is_blacklisted"), F.array_join(C.nav_targets(u), ",").alias("targets"),
    )


@query(
    "email_candidates",
    f"""SELECT row_id, unnest([f || '.' || s, s || '.' || f, f || s, s || f, f[1] || '.' || s, f[1] || s, f || '.' || s[1], f || s[1], f, s, f || '_' || s]) || '@' || 'x' || row_id || '.it' AS email
      FROM (SELECT row_id, 'mario' AS f, lower(regexp_replace(category, '[^A-Za-z]', '', 'g')) AS s FROM {COMPANIES})""",
)
def email_candidates(spark, d):
    c = C.email_candidates(F.lit("Mario"), F.col("category"), F.concat(F.lit("x"), F.col("row_id").cast("string"), F.lit(".it")))
    return role(spark, d, "companies").select("row_id", F.explode(c).alias("email"))


@query(
    "extract_contacts",
    f"""SELECT doc_id, {list_join(f"list_distinct(list_transform(regexp_extract_all(coalesce(text, ''), '{C.EMAIL}'), lambda m: lower(m)))")} AS emails,
      {list_join(f"list_distinct(list_filter(list_transform(regexp_extract_all(coalesce(text, ''), '{C.PHONE}'), lambda p: regexp_replace(regexp_replace(p, '[^0-9]', '', 'g'), '^00', '')), lambda p: length(p) BETWEEN 9 AND 15 AND regexp_matches(p, '^(39|0|3)')))")} AS phones
      FROM {REPORTS}""",
)
def extract_contacts(spark, d):
    found = P.contacts_from_text(F.col("text"))
    return role(spark, d, "reports").select("doc_id", found.alias("x")).select("doc_id", joined(F.col("x.emails")).alias("emails"), joined(F.col("x.phones")).alias("phones"))


def _docs(spark, d):
    return spark.read.parquet(f"{d}/documents.parquet")


# --- content ---------------------------------------------------------------------------------------------------------
_any = lambda t, xs: "(" + " OR ".join(f"contains({t}, '{q(x)}')" for x in xs) + ")"
_count = lambda t, xs: "(" + " + ".join(f"contains({t}, '{q(x)}')::INT" for x in xs) + ")"


@query(
    "content_checks",
    f"""SELECT doc_id, NOT ({_any("t", P.PARKING)} OR length(t) < 500 AND {_any("t", P.CONSTRUCTION)}) AS valid, length(t) < 120 OR {_count("t", P.STOP_WORDS["it"])} >= CASE WHEN length(t) > 2000 THEN 3 ELSE 4 END AS italian,
      {_any("t", P.DIRECTORY_TITLES)} AS directory_title, {_count("t", ["the", "der", "tion"])} / 3 AS relevance, {_any("substr(t, 1, 2048)", P.PARKED_START)} OR {_any("substr(t, 1, 5000)", P.PARKING)} OR length(t) < 100 AS parked
      FROM (SELECT doc_id, lower(coalesce(text, '')) AS t FROM {REPORTS})""",
)
def content_checks(spark, d):
    t = F.col("text")
    return role(spark, d, "reports").select(
        "doc_id", P.content_validity(t)[0].alias("valid"), P.stopword_language(t).alias("italian"), P.is_directory_title(t).alias("directory_title"), P.keyword_relevance(t, ["The", "der", "tion"])[2].alias("relevance"), P.is_parked(t).alias("parked")
    )


_captcha, _challenge = _any("lower(body)", P.CAPTCHA), _any("lower(body)", P.CHALLENGE)
_m = "lower(message)"


@query(
    "classify_blocks",
    f"""SELECT event_id, CASE WHEN http_status = 429 THEN 'RATE_LIMIT_429' WHEN http_status = 403 AND {_captcha} THEN 'CAPTCHA' WHEN http_status = 403 THEN 'WAF_403' WHEN http_status = 0 THEN 'CONNECTION_REFUSED'
        WHEN {_captcha} THEN 'CAPTCHA' WHEN {_challenge} THEN 'CHALLENGE_PAGE' WHEN length(body) < 200 AND http_status BETWEEN 200 AND 299 THEN 'EMPTY_RESPONSE' ELSE 'NONE' END AS block_type,
      CASE WHEN {_any(_m, ["timeout", "timed out"])} THEN 'TIMEOUT' WHEN {_any(_m, ["econnrefused", "econnreset", "enotfound"])} THEN 'CONNECTION_REFUSED' ELSE 'CHALLENGE_PAGE' END AS fetch_error,
      CASE WHEN {_any(_m, ["timeout", "econnrefused", "enotfound", "socket"])} THEN 'NETWORK' WHEN {_any(_m, ["browser", "puppeteer", "target closed", "detached"])} THEN 'BROWSER' WHEN {_any(_m, ["parse", "unexpected token", "json"])} THEN 'PARSING'
        WHEN {_any(_m, ["validation", "zod", "invalid"])} THEN 'VALIDATION' WHEN {_any(_m, ["401", "403", "429", "api key", "rate limit"])} THEN 'AUTH' ELSE 'LOGIC' END AS category FROM {LEDGER}""",
)
def classify_blocks(spark, d):
    kind, _ = P.classify_block(F.col("http_status"), F.col("body"))
    return role(spark, d, "ledger").select("event_id", kind.alias("block_type"), P.classify_fetch_error(F.col("message")).alias("fetch_error"), P.error_category(F.col("message")).alias("category"))


def _coded(text: str, rules: list) -> str:
    return " ".join(f"WHEN {_any(text, phrases)} THEN '{code}'" for phrases, code in rules)


_status = "CASE event_id % 10 WHEN 0 THEN 'OK' WHEN 1 THEN 'OK_LIKELY' WHEN 2 THEN 'NO_DOMAIN_FOUND' WHEN 3 THEN 'REJECTED_DIRECTORY' WHEN 4 THEN 'ERROR_TIMEOUT' WHEN 5 THEN 'ERROR_BLOCKED' WHEN 6 THEN 'ERROR_DNS' WHEN 7 THEN 'ERROR_FETCH' ELSE provider END"


@query(
    "reason_codes",
    f"""SELECT event_id, CASE category {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in P.REASON_OF_CATEGORY.items())} ELSE 'ERROR_INTERNAL' END AS of_category, CASE {_coded("m", P.REASON_OF_ERROR)} ELSE 'ERROR_INTERNAL' END AS of_error,
      CASE {_coded("m", P.REASON_OF_EXCEPTION)} ELSE 'ERROR_INTERNAL' END AS of_exception,
      CASE WHEN status = 'NO_DOMAIN_FOUND' THEN CASE WHEN contains(m, 'no candidates') THEN 'NOT_FOUND_NO_CANDIDATES' ELSE 'REJECTED_NO_MATCHING_SIGNALS' END {" ".join(f"WHEN status = '{k}' THEN '{v}'" for k, v in P.REASON_OF_STATUS.items())} ELSE 'ERROR_INTERNAL' END AS of_status,
      CASE WHEN success AND cache_hit THEN 'OK_CONFIRMED_VAT_MATCH' WHEN success AND http_status = 200 THEN 'OK_CONFIRMED_PHONE_MATCH' WHEN success THEN 'OK_CONFIRMED_SCHEMAORG_URL' {_coded("m", P.REASON_OF_VERIFICATION)}
        WHEN duration_ms / 10000 >= 0.75 THEN 'OK_LIKELY_NAME_CITY_MATCH' WHEN duration_ms > 0 THEN 'REJECTED_NO_MATCHING_SIGNALS' ELSE 'NOT_FOUND_NO_CANDIDATES' END AS of_verification
      FROM (SELECT *, lower(message) AS m, {_status} AS status FROM {LEDGER}) JOIN ({ORACLES["classify_blocks"]}) USING (event_id)""",
)
def reason_codes(spark, d):
    ledger, message, ok = role(spark, d, "ledger").withColumn("status", F.expr(_status)), F.col("message"), F.col("success")
    return ledger.select(
        "event_id", P.reason_of_category(P.error_category(message)).alias("of_category"), P.reason_of_error(message).alias("of_error"), P.reason_of_exception(message).alias("of_exception"), P.reason_of_status(F.col("status"), message).alias("of_status"),
        P.reason_of_verification(message, F.col("duration_ms") / 10000, ok & F.col("cache_hit"), ok & (F.col("http_status") == 200), ok).alias("of_verification"),
    )


@query(
    "classify_sites",
    f"""SELECT row_id, CASE WHEN {listed("h", P.DIRECTORY_SITES)} THEN 'DIRECTORY' WHEN {listed("h", P.SOCIAL_SITES)} THEN 'SOCIAL' WHEN {listed("h", P.MARKETPLACES)} THEN 'MARKETPLACE' WHEN {_count("t", P.PARKING)} >= 2 THEN 'PARKED'
        WHEN {_count("t", P.CORPORATE_SIGNS)} >= 2 THEN 'CORPORATE' WHEN length(t) < 200 THEN 'UNKNOWN' ELSE 'CORPORATE' END AS site_type
      FROM (SELECT row_id, {sql_host("website")} AS h, lower(company_name || ' contatti privacy') AS t FROM {COMPANIES} WHERE website IS NOT NULL)""",
)
def classify_sites(spark, d):
    kind, _ = P.classify_site(F.col("website"), F.concat("company_name", F.lit(" contatti privacy")))
    return role(spark, d, "companies").where("website is not null").select("row_id", kind.alias("site_type"))


# --- similarity and scores -------------------------------------------------------------------------------------------
_words_of = lambda x: f"list_distinct(list_filter(string_split_regex(regexp_replace(lower({x}), '[^a-z0-9_\\s]', '', 'g'), '\\s+'), lambda t: length(t) > 2))"


@query(
    "similarities",
    f"""SELECT p_partkey, CASE WHEN len(a) = 0 AND len(b) = 0 THEN 1.0 ELSE len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) END AS jaccard, round(1 - levenshtein(lower(p_name), lower(p_type)) / greatest(length(p_name), length(p_type)), 9) AS lev
      FROM (SELECT *, {_words_of("p_name || ' ' || p_brand")} AS a, {_words_of("p_type || ' ' || p_brand || ' ring'")} AS b FROM part)""",
)
def similarities(spark, d):
    part = spark.read.parquet(f"{d}/part.parquet")
    a, b = F.concat_ws(" ", "p_name", "p_brand"), F.concat_ws(" ", "p_type", "p_brand", F.lit("ring"))
    return part.select("p_partkey", M.jaccard_tokens(a, b).alias("jaccard"), F.round(M.levenshtein_similarity(F.lower("p_name"), F.lower("p_type")), 9).alias("lev"))


_variants_of = lambda d: f"list_filter([{d}, regexp_replace({d}, '^39', ''), '39' || regexp_replace({d}, '^39', ''), regexp_replace(regexp_replace({d}, '^39', ''), '^0', '')], lambda v: length(v) > 0)"
_same_phone = lambda x, y: f"len(list_filter({_variants_of(x)}, lambda a1: len(list_filter({_variants_of(y)}, lambda b1: a1 = b1 OR (least(length(a1), length(b1)) >= 8 AND (ends_with(a1, b1) OR ends_with(b1, a1))))) > 0)) > 0"
_found_phones = lambda t: f"list_distinct(list_filter(list_transform(regexp_extract_all({t}, '{C.PHONE}'), lambda p: regexp_replace(regexp_replace(p, '[^0-9]', '', 'g'), '^00', '')), lambda p: length(p) BETWEEN 9 AND 15 AND regexp_matches(p, '^(39|0|3)')))"
_found_vats = lambda t: f"list_concat(list_concat(list_filter(regexp_extract_all({t}, '\\b([0-9]{{11}})\\b', 1), lambda v: substr(v, 8, 3)::INT BETWEEN 1 AND 100 OR substr(v, 8, 3)::INT IN (120, 121, 888, 999)), regexp_extract_all({t}, '{C.VAT_LABELLED}', 1)), regexp_extract_all({t}, '\\bIT\\s?([0-9]{{11}})\\b', 1))"
_cover = lambda name, folded: f"CASE WHEN len({sql_tokens(name)}) = 0 THEN 0 ELSE len(list_filter({sql_tokens(name)}, lambda t: contains(' ' || {folded} || ' ', ' ' || t || ' ') OR (length(t) >= 4 AND contains({folded}, t)))) / len({sql_tokens(name)}) END"
_word_in = lambda t, f: f"(contains(' ' || {f} || ' ', ' ' || {t} || ' ') AND {f} <> {t})"
_street = f"list_filter(string_split({sql_fold('address')}, ' '), lambda t: t <> '' AND ((regexp_matches(t, '^[0-9]+$') AND length(t) >= 2) OR (NOT regexp_matches(t, '^[0-9]+$') AND length(t) >= 3 AND NOT list_contains({words(M.ADDRESS_NOISE)}, t))))[1:6]"
_places = f"list_filter(string_split({sql_fold('city')}, ' '), lambda t: length(t) >= 3)"
_in_host = f"""CASE WHEN length(array_to_string({sql_tokens("company_name")}, '')) >= 3 AND contains(h, array_to_string({sql_tokens("company_name")}, '')) THEN 1 WHEN len({sql_tokens("company_name")}) = 0 THEN 0
  ELSE len(list_filter({sql_tokens("company_name")}, lambda t: contains(h, t))) / len({sql_tokens("company_name")}) END"""
_step = lambda c, *levels: f"CASE {' '.join(f'WHEN {c} >= {at} THEN {v}' for at, v in levels)} ELSE 0 END"


@query(
    "match_confidence",
    f"""WITH c AS (SELECT *, concat_ws(' ', CASE WHEN row_id % 2 = 0 THEN company_name ELSE category END, 'contatti', CASE WHEN row_id % 3 = 0 THEN city END, CASE WHEN row_id % 5 = 0 THEN phone END, CASE WHEN row_id % 7 = 0 AND vat IS NOT NULL THEN 'P.IVA ' || vat END, address) AS page FROM {COMPANIES}),
      f AS (SELECT *, {sql_fold("page")} AS folded, {sql_fold("company_name")} AS head, coalesce(regexp_replace({sql_host("website")}, '[^a-z0-9]', '', 'g'), '') AS h FROM c),
      s AS (SELECT row_id, {sql_digits("vat")} <> '' AND list_contains({_found_vats("page")}, {sql_digits("vat")}) AS vat, len(list_filter({_found_phones("page")}, lambda p0: length(coalesce(phone, '')) > 0 AND {_same_phone("regexp_replace(" + sql_digits("phone") + ", '^00', '')", "p0")})) > 0 AS phone,
        {_cover("company_name", "folded")} AS name, len({_places}) > 0 AND len(list_filter({_places}, lambda t: NOT {_word_in("t", "folded")})) = 0 AS city, CASE WHEN len({_street}) = 0 THEN 0 ELSE len(list_filter({_street}, lambda t: {_word_in("t", "folded")})) / len({_street}) END AS address,
        {_in_host} AS domain, {_any("head || ' ' || folded", M.CONTACT_WORDS)} AS contact, {_cover("company_name", "head")} AS title, length(folded) AS n FROM f),
      a AS (SELECT *, 0.05 + CASE WHEN phone THEN 0.65 ELSE 0 END + {_step("name", (0.85, 0.26), (0.65, 0.2), (0.4, 0.12))} + CASE WHEN city THEN 0.08 ELSE 0 END + {_step("address", (0.8, 0.18), (0.65, 0.14), (0.45, 0.08))} + {_step("domain", (0.8, 0.2), (0.5, 0.1), (0.3, 0.05))}
        + CASE WHEN contact THEN 0.08 ELSE 0 END - CASE WHEN n < 160 AND name < 0.6 AND domain < 0.6 AND title < 0.8 THEN 0.1 ELSE 0 END AS x FROM s),
      b AS (SELECT *, CASE WHEN NOT phone AND name < 0.4 AND domain < 0.5 THEN least(x, 0.35) ELSE x END + CASE WHEN domain >= 0.8 AND name >= 0.4 THEN 0.06 ELSE 0 END + CASE WHEN (address >= 0.6)::INT + (domain >= 0.7)::INT + (title >= 0.6)::INT + city::INT >= 3 THEN 0.1 ELSE 0 END AS y FROM a)
      SELECT row_id, round(CASE WHEN vat THEN 1.0 ELSE greatest(0, least(0.99, CASE WHEN phone AND name < 0.25 AND domain < 0.25 THEN least(y, 0.68) ELSE y END)) END, 6)::DOUBLE AS confidence, round(name, 6) AS name, round(domain, 6)::DOUBLE AS domain, phone, vat FROM b""",
)
def match_confidence(spark, d):
    """Companies against the text of a page made of their own and other fields."""
    c = role(spark, d, "companies")
    page = F.concat_ws(" ", F.when(F.col("row_id") % 2 == 0, F.col("company_name")).otherwise(F.col("category")), F.lit("contatti"), F.when(F.col("row_id") % 3 == 0, F.col("city")), F.when(F.col("row_id") % 5 == 0, F.col("phone")), F.when(F.col("row_id") % 7 == 0, F.concat(F.lit("P.IVA "), F.col("vat"))), "address")
    signals = M.match_signals(*[F.col(x) for x in ("company_name", "city", "address", "phone", "vat")], F.col("website"), F.col("page"), F.col("company_name"))
    return c.withColumn("page", page).withColumn("s", signals).select("row_id", F.round(M.match_confidence(F.col("s")), 6).alias("confidence"), F.round("s.name", 6).alias("name"), F.round("s.domain", 6).alias("domain"), "s.phone", "s.vat")


_generic = "regexp_matches(email, '(?i)^(info|contact|admin|support|hello|sales)@')"


@query(
    "lead_scores",
    f"""SELECT row_id, contact, data, website_, contact + data + website_ AS total, CASE WHEN contact + data + website_ >= 70 THEN 'HOT' WHEN contact + data + website_ >= 45 THEN 'WARM' WHEN contact + data + website_ >= 20 THEN 'COLD' ELSE 'DEAD' END AS category, v1
      FROM (SELECT row_id, least(40, CASE WHEN {_generic} THEN 5 ELSE 15 END + CASE WHEN regexp_matches(phone, '^\\+?39\\s*3') THEN 15 ELSE 5 END + CASE WHEN ceo_name IS NULL THEN 0 ELSE 10 END) AS contact,
        least(35, CASE WHEN regexp_matches(coalesce(vat, ''), '^[0-9]{{11}}$') THEN 15 ELSE 0 END + CASE WHEN pec IS NULL THEN 0 ELSE 10 END + CASE WHEN revenue IS NULL THEN 0 ELSE 5 END + CASE WHEN employees IS NULL THEN 0 ELSE 5 END) AS data,
        CASE WHEN website IS NULL THEN 0 ELSE 10 + CASE WHEN ssl_valid THEN 5 ELSE 0 END + CASE WHEN coalesce(dns_valid, true) THEN 5 ELSE 0 END + 5 END AS website_,
        30 + CASE WHEN website IS NULL THEN 0 ELSE 30 END + CASE WHEN vat IS NULL THEN 0 ELSE 20 END + 10 + CASE WHEN balance / 10000 > 0.8 THEN 10 ELSE 0 END AS v1 FROM {LEADS})""",
)
def lead_scores(spark, d):
    leads = role(spark, d, "leads")
    v1 = S.lead_score_v1(*[F.col(x) for x in ("phone", "website", "vat", "address")], F.col("balance") / 10000)
    return leads.withColumn("s", S.lead_score_v2(leads)).select("row_id", "s.contact", "s.data", F.col("s.website").alias("website_"), "s.total", "s.category", v1.alias("v1"))


@query(
    "lead_report",
    f"""SELECT count(*) AS total, count(*) FILTER (category = 'HOT') AS hot, count(*) FILTER (category = 'WARM') AS warm, count(*) FILTER (category = 'COLD') AS cold, count(*) FILTER (category = 'DEAD') AS dead, round(avg(score), 4) AS mean_score,
      count(website) AS with_website, count(vat) AS with_vat, count(email) AS with_email, count(phone) AS with_phone
      FROM (SELECT l.*, s.total AS score, s.category FROM (SELECT row_id, website, vat, email, phone FROM {LEADS}) l JOIN ({ORACLES["lead_scores"]}) s USING (row_id))""",
)
def lead_report(spark, d):
    leads = role(spark, d, "leads")
    return A.lead_report(leads.withColumn("s", S.lead_score_v2(leads)).drop("category").select("*", "s.total", "s.category"))


@query("hot_leads", f"SELECT row_id, total FROM ({ORACLES['lead_scores']}) WHERE total >= 50 ORDER BY total DESC, row_id")
def hot_leads(spark, d):
    return lead_scores(spark, d).select("row_id", "total").where("total >= 50").orderBy(F.desc("total"), "row_id")


_numbers = f"list_distinct(list_transform({_parts}, lambda p: CASE WHEN starts_with(p, '0') OR starts_with(p, '3') THEN '+39' || p ELSE p END))"


@query(
    "site_scores",
    f"""WITH c AS (SELECT row_id, {sql_norm} AS company, company_name AS title, len({_numbers}) > 0 AND row_id % 3 = 0 AS phone_hit, row_id % 5 >= 3 AS common, (row_id % 10) / 10 AS near, row_id % 4 = 0 AS vat_hit, row_id % 2 = 0 AS contact, row_id % 5 = 0 AS privacy FROM {COMPANIES}),
      j AS (SELECT *, CASE WHEN len({_words_of("company")}) = 0 AND len({_words_of("title")}) = 0 THEN 1.0 ELSE len(list_intersect({_words_of("company")}, {_words_of("title")})) / len(list_distinct(list_concat({_words_of("company")}, {_words_of("title")}))) END AS name FROM c),
      s AS (SELECT row_id, CASE WHEN phone_hit AND common THEN 25 WHEN phone_hit THEN 45 ELSE 0 END AS s1, CASE WHEN near > 0.5 THEN 25 * near WHEN near > 0.3 THEN 7.5 ELSE 0 END AS s2, CASE WHEN name > 0.8 THEN 20 WHEN name > 0.5 THEN 14 WHEN name > 0.3 THEN 8 ELSE 0 END AS s3,
        CASE WHEN vat_hit THEN 100 ELSE 0 END AS s4, CASE WHEN contact::INT + privacy::INT + vat_hit::INT >= 2 THEN 8 ELSE 0 END AS c3, CASE WHEN contact THEN 5 ELSE 0 END AS c4, CASE WHEN row_id % 13 = 0 THEN 100 ELSE 0 END AS p1, CASE WHEN row_id % 17 = 0 THEN 35 ELSE 0 END AS p3 FROM j)
      SELECT row_id, round(greatest(0, least(100, s1 + s2 + s3 + s4 + 10 + c3 + c4 + 2 - p1 - p3)), 4)::DOUBLE AS final_score,
        array_to_string(list_filter([CASE WHEN s1 > 0 THEN 'S1' END, CASE WHEN s2 > 0 THEN 'S2' END, CASE WHEN s3 > 0 THEN 'S3' END, CASE WHEN s4 > 0 THEN 'S4' END, 'C1', CASE WHEN c3 > 0 THEN 'C3' END, CASE WHEN c4 > 0 THEN 'C4' END, 'C5', CASE WHEN p1 > 0 THEN 'P1' END, CASE WHEN p3 > 0 THEN 'P3' END], lambda x: x IS NOT NULL), ',') AS details FROM s""",
)
def site_scores(spark, d):
    c = N.normalize_entity(role(spark, d, "companies"))
    e = F.struct(
        F.when(F.col("row_id") % 3 == 0, F.col("phones")).otherwise(F.array().cast("array<string>")).alias("phones_found"), F.when(F.col("row_id") % 4 == 0, F.array("vat_digits")).otherwise(F.array().cast("array<string>")).alias("vat_ids_found"),
        F.array("email").alias("emails_found"), F.lit(None).cast("array<string>").alias("structured_data"), F.col("company_name").alias("meta_title"), ((F.col("row_id") % 10) / 10).alias("address_match_score"), F.lit(None).cast("double").alias("name_match_score"),
        (F.col("row_id") % 2 == 0).alias("has_contact_page"), (F.col("row_id") % 5 == 0).alias("has_privacy_policy"), F.lit(True).alias("is_https"), F.when(F.col("row_id") % 13 == 0, "DIRECTORY").otherwise("CORPORATE").alias("site_type"), F.lit(True).alias("dns_ok"), (F.col("row_id") % 17 != 0).alias("http_ok"),
    )
    scored = c.withColumn("s", S.site_score(e, F.col("company"), F.col("phones"), F.col("vat_digits"), F.col("row_id") % 5))
    return scored.select("row_id", F.round("s.final_score", 4).alias("final_score"), F.array_join("s.details", ",").alias("details"))


# --- records ---------------------------------------------------------------------------------------------------------
FIELDS = ["company_name", "vat", "website", "phone", "email", "address", "city", "province", "category"]
_vat_key = "regexp_replace(vat, '^IT', '')"
_keyed = f"""(SELECT *, list_filter(['VAT:' || {_vat_key}, 'WEBSITE:' || CASE WHEN {_junk} OR NOT contains(k, '.') OR length(k) < 4 THEN NULL ELSE k END,
  CASE WHEN length(company_name) > 2 AND length(city) > 2 THEN 'NAME_CITY:' || {sql_slug("company_name")} || '|' || {sql_slug("city")} END], lambda x: x IS NOT NULL) AS ks
  FROM (SELECT *, regexp_replace(regexp_replace(regexp_replace(lower(trim(website)), '/$', ''), '^https?://', ''), '^www\\.', '') AS k FROM {COMPANIES}))"""
_entities = f"""keyed AS {_keyed}, members AS (SELECT DISTINCT row_id, unnest(ks) AS key FROM keyed),
  links AS (SELECT DISTINCT a.row_id AS a, b.row_id AS b FROM members a JOIN members b USING (key)),
  reach AS (SELECT row_id AS node, row_id AS root FROM keyed UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.node),
  entities AS (SELECT node AS row_id, min(root) AS entity_id FROM reach GROUP BY node)"""
_real = lambda f: f"length(trim({f})) > 0 AND {f} NOT IN ('undefined', 'null')"


@query("resolve_entities", f"WITH RECURSIVE {_entities} SELECT row_id, entity_id FROM entities")
def resolve_entities(spark, d):
    return D.resolve_entities(role(spark, d, "companies")).select("row_id", "entity_id")


@query(
    "consolidate_campaigns",
    f"""WITH RECURSIVE {_entities} SELECT entity_id, {", ".join(f"coalesce((array_agg({f} ORDER BY length({f}) DESC, row_id) FILTER ({_real(f)}))[1], '') AS {f}" for f in FIELDS)}, count(*) AS n_records, string_agg(DISTINCT source, ';' ORDER BY source) AS source_file
      FROM keyed JOIN entities USING (row_id) GROUP BY entity_id""",
)
def consolidate_campaigns(spark, d):
    """Flagship: keys, entities by shared keys, one merged record per entity."""
    return D.merge_records_longest(D.resolve_entities(role(spark, d, "companies")), FIELDS, source="source")


@query(
    "merge_stats",
    f"""WITH RECURSIVE {_entities} SELECT count(*) AS n_rows, count(DISTINCT entity_id) AS n_unique, count(*) - count(DISTINCT entity_id) AS n_merged, count(*) FILTER (starts_with(ks[1], 'VAT')) AS by_vat,
      count(*) FILTER (starts_with(ks[1], 'WEBSITE')) AS by_website, count(*) FILTER (starts_with(ks[1], 'NAME')) AS by_name_city FROM keyed JOIN entities USING (row_id)""",
)
def merge_stats(spark, d):
    return D.merge_stats(D.resolve_entities(role(spark, d, "companies")))


@query("dedup_exact", f"SELECT min(row_id) AS row_id, vat, city FROM {COMPANIES} GROUP BY vat, city")
def dedup_exact(spark, d):
    return D.dedup_exact(role(spark, d, "companies"), ["vat", "city"]).select("row_id", "vat", "city")


@query("company_ids", f"SELECT row_id, CASE WHEN row_id % 2 = 0 THEN company_id ELSE md5(lower(trim(company_name)) || '|' || {sql_digits('phone')} || '|' || lower(trim(city)) || '|' || lower(trim(address))) END AS company_id FROM {COMPANIES}")
def company_ids(spark, d):
    c = role(spark, d, "companies").withColumn("company_id", F.when(F.col("row_id") % 2 == 0, F.col("company_id")))
    return D.deterministic_company_id(c)[0].select("row_id", "company_id")


_slugged = f"{sql_slug('company_name')} || '_' || {sql_slug('city')}"


@query("overlay", f"SELECT k, max(row_id) AS row_id, min(CASE WHEN NOT late THEN row_id END) AS place FROM (SELECT {_slugged} AS k, row_id, false AS late FROM {COMPANIES} UNION ALL SELECT {_slugged}, row_id + 1000000000, true FROM {COMPANIES} WHERE balance < 0) GROUP BY k")
def overlay(spark, d):
    """All companies, and the results of a second run over those in the red."""
    c = role(spark, d, "companies").withColumn("k", N.name_city_slug(F.col("company_name"), F.col("city")))
    retry = c.where("balance < 0").withColumn("row_id", F.col("row_id") + 1000000000)
    return D.overlay(c.select("k", "row_id"), retry.select("k", "row_id"), ["k"]).select("k", "row_id", "place")


@query(
    "merge_by_phone",
    f"""SELECT merge_key, row_id FROM (SELECT *, row_number() OVER (PARTITION BY merge_key ORDER BY (website IS NOT NULL) DESC, (website IS NOT NULL)::INT + (vat IS NOT NULL)::INT + (province IS NOT NULL)::INT DESC, row_id % 2, row_id) AS n
      FROM (SELECT *, trim(phone) AS merge_key FROM {COMPANIES})) WHERE n = 1""",
)
def merge_by_phone(spark, d):
    c = role(spark, d, "companies")
    return D.merge_by_phone(c.where("row_id % 2 = 0"), c.where("row_id % 2 = 1"), ["website", "vat", "province"]).select("merge_key", "row_id")


_trusted = lambda f: f"(array_agg({f} ORDER BY CASE source WHEN 'REGISTRY' THEN 100 WHEN 'WEBSITE' THEN 80 ELSE 50 END DESC, row_id) FILTER ({f} IS NOT NULL))[1]"
_trusted_source = lambda f: f"(array_agg(source ORDER BY CASE source WHEN 'REGISTRY' THEN 100 WHEN 'WEBSITE' THEN 80 ELSE 50 END DESC, row_id) FILTER ({f} IS NOT NULL))[1]"


@query("merge_by_trust", f"SELECT address, {', '.join(f'{_trusted(f)} AS {f}' for f in ('vat', 'website', 'province'))}, {_trusted_source('website')} AS website_source FROM {COMPANIES} GROUP BY address")
def merge_by_trust(spark, d):
    return D.merge_by_trust(role(spark, d, "companies"), "address", ["vat", "website", "province"]).withColumn("website_source", F.col("sources")["website"]).drop("sources")


_bare = lambda x: f"regexp_replace({x}, '[^a-z0-9_]', '', 'g')"
_first = lambda c: f"(array_agg({c} ORDER BY row_id) FILTER (length(trim({c})) > 0))[1]"
_unformed = "regexp_replace(lower(company_name), 's\\.r\\.l\\.|s\\.p\\.a\\.|s\\.n\\.c\\.|srl|spa|snc', '', 'g')"


@query(
    "dedup_cascade",
    f"""WITH RECURSIVE c AS (SELECT *, list_filter(['V:' || nullif(trim(vat), ''), CASE WHEN length({sql_digits("phone")}) > 5 THEN 'P:' || {sql_digits("phone")} END,
        CASE WHEN {_bare(_unformed)} <> '' THEN 'N:' || {_bare(_unformed)} || '_' || {_bare("lower(city)")} END], lambda x: x IS NOT NULL) AS ks FROM {COMPANIES}),
      m AS (SELECT DISTINCT row_id, unnest(ks) AS key FROM c), links AS (SELECT DISTINCT a.row_id AS a, b.row_id AS b FROM m a JOIN m b USING (key)),
      reach AS (SELECT row_id AS node, row_id AS root FROM c UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.node), e AS (SELECT node AS row_id, min(root) AS entity FROM reach GROUP BY node)
      SELECT min(row_id) AS row_id, {_first("website")} AS website, {_first("phone")} AS phone, arg_min(source, row_id) || CASE WHEN arg_min(coalesce(website, '-'), row_id) = '-' AND {_first("website")} IS NOT NULL THEN ' + Maps' ELSE '' END AS source, count(*) AS n_merged
      FROM c JOIN e USING (row_id) GROUP BY entity""",
)
def dedup_cascade(spark, d):
    return D.dedup_priority_cascade(role(spark, d, "companies")).select("row_id", "website", "phone", "source", "n_merged")


@query(
    "fuzzy_dedup",
    f"""WITH RECURSIVE nm AS (SELECT p_partkey AS row_id, {sql_clean("p_name")} AS nm FROM part), firsts AS (SELECT nm, min(row_id) AS id FROM nm GROUP BY nm),
      links AS (SELECT a.id AS a, b.id AS b FROM firsts a JOIN firsts b ON a.id <> b.id AND levenshtein(a.nm, b.nm) * 100 <= greatest(length(a.nm), length(b.nm)) * 15),
      reach AS (SELECT id AS node, id AS root FROM firsts UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.node),
      grp AS (SELECT node, min(root) AS group_id FROM reach GROUP BY node)
      SELECT row_id, group_id, row_id = group_id AS kept FROM nm JOIN firsts USING (nm) JOIN grp ON node = id""",
)
def fuzzy_dedup(spark, d):
    part = spark.read.parquet(f"{d}/part.parquet").select(F.col("p_partkey").alias("row_id"), "p_name")
    return D.fuzzy_dedup(part, "p_name")


@query(
    "dedup_candidates",
    f"""SELECT company_id, root_domain, source_url, "rank", provider, aliases, place FROM (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY "rank", pos, root_domain) AS place FROM (
      SELECT company_id, root_domain, arg_min(source_url, "rank" * 100 + pos) AS source_url, min("rank") AS "rank", arg_min(provider, "rank" * 100 + pos) AS provider, string_agg(DISTINCT source_url, ',' ORDER BY source_url) AS aliases, arg_min(pos, "rank" * 100 + pos) AS pos
      FROM {CANDIDATES} GROUP BY company_id, root_domain)) WHERE place <= 3""",
)
def dedup_candidates(spark, d):
    return D.dedup_candidates(role(spark, d, "candidates"), 3).select("company_id", "root_domain", "source_url", "rank", "provider", F.array_join("aliases", ",").alias("aliases"), "place")


@query("dedup_urls", f"SELECT min(row_id) AS row_id, {sql_host('website')} AS root_domain FROM {COMPANIES} WHERE website IS NOT NULL GROUP BY root_domain")
def dedup_urls(spark, d):
    return D.dedup_urls_by_domain(role(spark, d, "companies"), "website").select("row_id", "root_domain")


@query(
    "clean_serp",
    f"""SELECT company_id, pos, place FROM (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY pos) AS place FROM (
      SELECT *, row_number() OVER (PARTITION BY company_id, h ORDER BY pos) AS n FROM (SELECT *, {sql_host("source_url")} AS h FROM {CANDIDATES}) WHERE h NOT IN ('facebook.com', 'site3.it')) WHERE n = 1) WHERE place <= 10
      UNION ALL SELECT company_id, pos, NULL FROM {CANDIDATES} WHERE {sql_host("source_url")} = 'facebook.com'""",
)
def clean_serp(spark, d):
    c = role(spark, d, "candidates").select("company_id", F.col("source_url").alias("url"), F.col("pos").alias("rank"))
    targets, profiles = D.clean_serp(c, ["site3.it"], "facebook.com")
    both = targets.select("company_id", F.col("rank").alias("pos"), F.col("place").cast("long").alias("place"))
    return both.unionByName(profiles.select("company_id", F.col("rank").alias("pos"), F.lit(None).cast("long").alias("place")))


@query("runner_ups", f"""SELECT company_id, url, score, place FROM (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY score DESC, url) AS place FROM (SELECT company_id, source_url AS url, max(final_score) AS score FROM {CANDIDATES} GROUP BY ALL)) WHERE place <= 2""")
def runner_ups(spark, d):
    return D.runner_ups(role(spark, d, "candidates").select("company_id", F.col("source_url").alias("url"), F.col("final_score").alias("score")), 2)


@query(
    "profile_and_balance",
    f"""SELECT company_id, min_by(url, place) FILTER (contains(url, 'linkedin.com/')) AS profile_url, CASE WHEN min_by(said, place) FILTER (ends_with(url, '.pdf')) LIKE '%bilancio%' THEN min_by(url, place) FILTER (ends_with(url, '.pdf')) END AS balance_url
      FROM (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY score DESC, url) AS place FROM (SELECT company_id, url, max(score) AS score, min(said) AS said FROM (
        SELECT company_id, final_score AS score, CASE WHEN starts_with(source_url, 'https://facebook.com') THEN 'https://it.linkedin.com/company/' || pos WHEN ends_with(source_url, '/R') THEN source_url || '.pdf' ELSE source_url END AS url,
          CASE WHEN starts_with(provider, 'F') THEN 'bilancio' ELSE 'listino' END AS said FROM {CANDIDATES}) GROUP BY company_id, url)) WHERE place <= 10 GROUP BY company_id""",
)
def profile_and_balance(spark, d):
    """Candidates whose listed sites are profiles and whose returned ones are documents."""
    site = F.col("source_url")
    url = F.when(site.startswith("https://facebook.com"), F.format_string("https://it.linkedin.com/company/%d", "pos")).when(site.endswith("/R"), F.concat(site, F.lit(".pdf"))).otherwise(site)
    said = F.when(F.col("provider").startswith("F"), "Bilancio").otherwise("Listino")
    c = role(spark, d, "candidates").select("company_id", url.alias("url"), F.col("final_score").alias("score"), said.alias("title"), F.lit(None).cast("string").alias("description"))
    first = c.groupBy("company_id", "url").agg(F.max("score").alias("score"), F.min("title").alias("title"), F.min("description").alias("description"))
    return D.profile_and_balance(D.runner_ups(first))


@query(
    "union_candidates",
    f"""SELECT company_id, url, src, src_priority, "rank" FROM (SELECT *, row_number() OVER (PARTITION BY company_id, url ORDER BY src_priority, "rank") AS n FROM (
      SELECT company_id, source_url AS url, pos AS "rank", CASE layer WHEN 2 THEN 'vat' WHEN 4 THEN 'guess' ELSE 'search' END AS src, CASE layer WHEN 2 THEN 0 WHEN 4 THEN 1 ELSE 2 END AS src_priority FROM {CANDIDATES})) WHERE n = 1""",
)
def union_candidates(spark, d):
    c = role(spark, d, "candidates").select("company_id", F.col("source_url").alias("url"), F.col("pos").alias("rank"), "layer")
    parts = [("vat", c.where("layer = 2")), ("guess", c.where("layer = 4")), ("search", c.where("layer not in (2, 4)"))]
    return D.union_candidates([(n, x.drop("layer")) for n, x in parts]).select("company_id", "url", "src", "src_priority", "rank")


@query("merge_runs", f"SELECT vat, min(row_id % 4 + 1) AS run_no FROM {COMPANIES} WHERE vat IS NOT NULL GROUP BY vat")
def merge_runs(spark, d):
    c = role(spark, d, "companies").where("vat is not null")
    runs = [c.where(f"row_id % 4 = {i}") for i in range(4)]
    return D.merge_runs(runs, ["vat"], runs[2:], runs[2:])[0].select("vat", "run_no")


@query("upsert", f"SELECT k, max(row_id) AS row_id FROM (SELECT address AS k, row_id FROM {COMPANIES} WHERE row_id % 2 = 0 AND address NOT IN (SELECT address FROM {COMPANIES} WHERE row_id % 2 = 1) UNION ALL SELECT address, row_id FROM {COMPANIES} WHERE row_id % 2 = 1) GROUP BY k")
def upsert(spark, d):
    c = role(spark, d, "companies").select(F.col("address").alias("k"), "row_id")
    return D.upsert(c.where("row_id % 2 = 0"), c.where("row_id % 2 = 1"), "k").select("k", "row_id")


@query("merge_status", f"SELECT row_id, CASE WHEN balance > 5000 THEN 'OK' WHEN row_id % 2 = 0 THEN 'ERROR' ELSE 'NO_DOMAIN_FOUND' END AS status FROM {COMPANIES}")
def merge_status(spark, d):
    c = role(spark, d, "companies").select("row_id", "balance", F.when(F.col("row_id") % 2 == 0, "ERROR").otherwise("NO_DOMAIN_FOUND").alias("status"))
    return D.keyed_merge_status(c.drop("balance"), c.where("balance > 5000").withColumn("status", F.lit("OK")), "row_id")


@query("phone_frequency", f"""WITH p AS (SELECT row_id, unnest(list_distinct(list_transform({_parts}, lambda p: CASE WHEN starts_with(p, '0') OR starts_with(p, '3') THEN '+39' || p ELSE p END))) AS phone FROM {COMPANIES})
  SELECT row_id, max(n) AS phone_freq FROM p JOIN (SELECT phone, count(*) AS n FROM p GROUP BY phone) USING (phone) GROUP BY row_id""")
def phone_frequency(spark, d):
    return W.phone_frequency(N.normalize_entity(role(spark, d, "companies")))


@query("running_phone_frequency", f"""SELECT row_id, max(n) AS phone_freq FROM (SELECT row_id, count(*) OVER (PARTITION BY phone ORDER BY row_id ROWS UNBOUNDED PRECEDING) AS n
  FROM (SELECT row_id, unnest(list_distinct(list_transform({_parts}, lambda p: CASE WHEN starts_with(p, '0') OR starts_with(p, '3') THEN '+39' || p ELSE p END))) AS phone FROM {COMPANIES})) GROUP BY row_id""")
def running_phone_frequency(spark, d):
    return W.running_phone_frequency(N.normalize_entity(role(spark, d, "companies")))


# --- ranking ---------------------------------------------------------------------------------------------------------
_decided = f"""SELECT *, final_score - second AS margin, CASE WHEN phone_freq >= 3 OR length(company_name) <= 4 THEN final_score >= 94 AND final_score - second >= 30 ELSE final_score >= 80 AND final_score - second >= 20 END AS ok
  FROM (SELECT *, row_number() OVER w AS n, lead(final_score, 1, 0.0) OVER w AS second FROM {CANDIDATES} WINDOW w AS (PARTITION BY company_id ORDER BY final_score DESC, pos)) WHERE n = 1"""


@query(
    "decide",
    f"""SELECT company_id, CASE WHEN ok THEN source_url END AS site_url, CASE WHEN ok THEN 'OK' ELSE 'NO_DOMAIN_FOUND' END AS status, final_score AS score, round(margin, 4) AS margin,
      CASE WHEN ok AND n_vats > 0 THEN 'OK_CONFIRMED_VAT_MATCH' WHEN ok AND n_phones > 0 THEN 'OK_CONFIRMED_PHONE_MATCH' WHEN ok THEN 'OK_LIKELY_NAME_CITY_MATCH' WHEN contains(source_url, 'facebook.com') THEN 'REJECTED_DIRECTORY_OR_SOCIAL' ELSE 'REJECTED_NO_MATCHING_SIGNALS' END AS reason_code,
      floor(CASE WHEN ok THEN least(100, final_score + least(10, margin / 5)) ELSE least(80, final_score) END + 0.5)::INT AS confidence FROM ({_decided})""",
)
def decide(spark, d):
    return W.decide(role(spark, d, "candidates")).withColumn("margin", F.round("margin", 4))


@query("complete", f"SELECT o_orderkey AS company_id, CASE WHEN coalesce(ok, false) THEN 'OK' ELSE 'NO_DOMAIN_FOUND' END AS status, coalesce(final_score, 0.0) AS score FROM orders LEFT JOIN ({_decided}) ON company_id = o_orderkey")
def complete(spark, d):
    inputs = spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_orderkey").alias("company_id"))
    return W.complete(inputs, W.decide(role(spark, d, "candidates"))).select("company_id", "status", "score")


@query("top2_candidates", f"""SELECT company_id, max(CASE WHEN n = 1 THEN source_url END) AS candidate1_url, max(CASE WHEN n = 1 THEN final_score END) AS candidate1_score, max(CASE WHEN n = 2 THEN source_url END) AS candidate2_url, max(CASE WHEN n = 2 THEN final_score END) AS candidate2_score
  FROM (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY final_score DESC, pos) AS n FROM {CANDIDATES}) GROUP BY company_id""")
def top2_candidates(spark, d):
    c = role(spark, d, "candidates")
    listed_json = F.to_json(F.transform(F.sort_array(F.collect_list(F.struct("pos", F.col("source_url").alias("url"), F.col("final_score").alias("score")))), lambda x: F.struct(x["url"].alias("url"), x["score"].alias("score"))))
    return W.top2_candidates(c.groupBy("company_id").agg(listed_json.alias("candidates_json"))).drop("candidates_json")


@query("best_verification", f"""SELECT company_id, pos, confidence, CASE WHEN confidence >= 0.75 THEN 'FOUND_VALID' ELSE 'FOUND_INVALID' END AS status FROM (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY confidence DESC, pos) AS n
  FROM (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY pos) AS m FROM {CANDIDATES}) WHERE m <= 3) WHERE n = 1""")
def best_verification(spark, d):
    return W.best_verification(role(spark, d, "candidates"), 0.75, 3).select("company_id", "pos", "confidence", "status")


_limit = "CASE layer WHEN 1 THEN 0.9 WHEN 2 THEN 0.8 WHEN 3 THEN 0.75 ELSE 0.7 END"


@query("waterfall", f"""SELECT company_id, layer, confidence, CASE WHEN ok THEN 'FOUND_VALID' WHEN confidence >= 0.35 THEN 'FOUND_INVALID' ELSE 'NOT_FOUND' END AS status, CASE WHEN ok OR confidence >= 0.35 THEN source_url END AS url
  FROM (SELECT *, confidence >= {_limit} AS ok, row_number() OVER (PARTITION BY company_id ORDER BY confidence >= {_limit} DESC, CASE WHEN confidence >= {_limit} THEN layer END NULLS FIRST, confidence DESC, layer, pos) AS n FROM {CANDIDATES}) WHERE n = 1""")
def waterfall(spark, d):
    return W.waterfall(role(spark, d, "candidates").withColumn("url", F.col("source_url")), {1: 0.9, 2: 0.8, 3: 0.75, 4: 0.7}).select("company_id", "layer", "confidence", "status", "url")


@query("mode_thresholds", f"SELECT row_id, mode, round(greatest(0.1, least(0.99, 0.75 + delta)), 6)::DOUBLE AS threshold, most FROM {COMPANIES}, (VALUES ('FAST', 0.0, 8), ('DEEP', -0.05, 15), ('AGGRESSIVE', -0.1, 20), ('NUCLEAR', -0.15, 30)) m(mode, delta, most) WHERE (row_id % 2 = 0) = (mode IN ('FAST', 'DEEP'))")
def mode_thresholds(spark, d):
    c = role(spark, d, "companies").select("row_id", F.explode(F.when(F.col("row_id") % 2 == 0, F.array(F.lit("FAST"), F.lit("DEEP"))).otherwise(F.array(F.lit("AGGRESSIVE"), F.lit("NUCLEAR")))).alias("mode"))
    return W.mode_thresholds(c).select("row_id", "mode", F.round("threshold", 6).alias("threshold"), "most")


@query("financial_waterfall", f"""SELECT address AS company_id, (array_agg(vat ORDER BY o, row_id) FILTER (vat IS NOT NULL))[1] IS NOT NULL AS has_vat, min(CASE WHEN vat IS NOT NULL THEN o END) AS first_rank
  FROM (SELECT *, CASE source WHEN 'REGISTRY' THEN 0 WHEN 'WEBSITE' THEN 1 ELSE 2 END AS o FROM {COMPANIES}) GROUP BY address""")
def financial_waterfall(spark, d):
    c = role(spark, d, "companies").select(F.col("address").alias("company_id"), "vat", "source")
    out = W.financial_waterfall(c, ["vat"], ["REGISTRY", "WEBSITE", "MAPS"])
    rank = F.when(F.col("first_source") == "REGISTRY", 0).when(F.col("first_source") == "WEBSITE", 1).when(F.col("first_source") == "MAPS", 2)
    return out.select("company_id", F.col("vat").isNotNull().alias("has_vat"), rank.alias("first_rank"))


@query("vat_waterfall", f"""SELECT row_id, CASE WHEN {_luhn("v")} THEN v ELSE '00743110157' END AS vat FROM (SELECT row_id, {sql_digits("vat")} AS v FROM {COMPANIES} WHERE vat IS NOT NULL)""")
def vat_waterfall(spark, d):
    return role(spark, d, "companies").where("vat is not null").select("row_id", W.vat_waterfall([F.col("vat"), F.lit("00743110157")]).alias("vat"))


_tries = f"SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY ts, event_id) AS attempt FROM {LEDGER}"


@query("attempts", f"SELECT event_id, attempt, CASE WHEN NOT success AND attempt >= 3 THEN 'FAILED' WHEN NOT success THEN 'RETRYING' ELSE 'OK' END AS state FROM ({_tries})")
def attempts(spark, d):
    return W.attempts(role(spark, d, "ledger")).select("event_id", "attempt", "state")


@query("pick_provider", f"""WITH health AS (SELECT provider, avg((NOT success)::INT) AS e FROM {LEDGER} GROUP BY provider)
  SELECT event_id AS task_id, (SELECT provider FROM health h WHERE e <= 0.3 AND length(provider) % 2 = event_id % 2 ORDER BY length(provider), provider LIMIT 1) AS provider FROM {LEDGER}
  WHERE EXISTS (SELECT 1 FROM health h WHERE e <= 0.3 AND length(provider) % 2 = event_id % 2)""")
def pick_provider(spark, d):
    ledger = role(spark, d, "ledger")
    providers = ledger.select("provider").distinct().select("provider", F.length("provider").alias("tier"), (F.length("provider") % 2).cast("long").alias("task_type"), F.lit(False).alias("exhausted"))
    tasks = ledger.select(F.col("event_id").alias("task_id"), (F.col("event_id") % 2).alias("task_type"))
    return W.pick_provider(tasks, providers, A.provider_health(ledger), 99).select("task_id", "provider")


# --- joins -----------------------------------------------------------------------------------------------------------
@query("pending", f"SELECT company_id FROM {COMPANIES} WHERE row_id NOT IN (SELECT user_id FROM events)")
def pending(spark, d):
    done = spark.read.parquet(f"{d}/events.parquet").select(F.col("user_id").cast("string").alias("company_id"))
    return J.pending(role(spark, d, "companies"), done).select("company_id")


@query("run_pending", f"SELECT row_id FROM {COMPANIES} WHERE lower(trim(company_name)) || '|' || lower(trim(city)) || '|' || lower(trim(address)) NOT IN (SELECT lower(trim(company_name)) || '|' || lower(trim(city)) || '|' || lower(trim(address)) FROM {COMPANIES} WHERE balance < 0 OR balance > 8000)")
def run_pending(spark, d):
    c = role(spark, d, "companies")
    return J.run_pending(c, [c.where("balance < 0"), c.where("balance > 8000")]).select("row_id")


@query("export_enriched", f"SELECT c.company_id, company_name, sum(o_totalprice) AS lead_score FROM {COMPANIES} c JOIN orders ON o_custkey = row_id GROUP BY ALL".replace("sum(o_totalprice)", "max(o_totalprice)"))
def export_enriched(spark, d):
    results = spark.read.parquet(f"{d}/orders.parquet").groupBy(F.col("o_custkey").cast("string").alias("company_id")).agg(F.max("o_totalprice").alias("lead_score"))
    return J.export_enriched(role(spark, d, "companies"), results, ["company_id", "company_name", "lead_score"])


@query("already_enriched", f"SELECT company_id, 'OK_ALREADY_ENRICHED' AS status FROM {COMPANIES} WHERE row_id IN (SELECT o_custkey FROM orders)")
def already_enriched(spark, d):
    done = spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_custkey").cast("string").alias("company_id"))
    return J.already_enriched(role(spark, d, "companies"), done).select("company_id", "status")


_registry = f"(SELECT row_id AS piva, {sql_clean('company_name')} AS r_norm, coalesce(province, '-') AS r_province, city AS r_city FROM {COMPANIES})"


def _registry_of(c):
    return c.select(F.col("row_id").alias("piva"), F.col("company_name").alias("ragione_sociale"), N.clean_company_name(F.col("company_name")).alias("normalized_name"), F.coalesce("province", F.lit("-")).alias("provincia"), F.col("city").alias("citta"))


@query("registry_lookup", f"""SELECT row_id, min(piva) AS piva FROM (SELECT *, {sql_clean("company_name")} AS norm FROM {COMPANIES}) JOIN {_registry} ON norm = r_norm AND (province = r_province OR city = r_city) GROUP BY row_id""")
def registry_lookup(spark, d):
    c = role(spark, d, "companies")
    return J.registry_lookup(c, _registry_of(c)).select("row_id", "piva")


@query("registry_fuzzy", f"""SELECT row_id, min(piva) AS piva FROM (SELECT *, {sql_fold(sql_clean("company_name"))} AS core FROM {COMPANIES}) c JOIN (SELECT row_id AS piva, ' ' || {sql_fold("company_name")} || ' ' AS legal, city FROM {COMPANIES}) r
  ON r.city = c.city AND contains(legal, ' ' || core || ' ') GROUP BY row_id""")
def registry_fuzzy(spark, d):
    c = role(spark, d, "companies")
    return J.registry_fuzzy(c, _registry_of(c)).select("row_id", "piva")


@query("filter_blacklisted", f"SELECT company_id, pos FROM {CANDIDATES} WHERE NOT {listed(sql_host('source_url'), ['facebook.com', 'site3.it'])}")
def filter_blacklisted(spark, d):
    c = role(spark, d, "candidates").withColumn("cand_id", F.concat_ws("-", "company_id", "pos"))
    bad = spark.createDataFrame([("facebook.com",), ("site3.it",)], "domain string")
    return J.filter_blacklisted(c, bad).select("company_id", "pos")


@query("match_category", f"SELECT row_id, s.n_name AS category FROM {COMPANIES} c JOIN nation s ON contains(lower(c.city), lower(s.n_name)) OR contains(lower(s.n_name), lower(c.city))")
def match_category(spark, d):
    taxonomy = spark.read.parquet(f"{d}/nation.parquet").select(F.col("n_name").alias("category"))
    return J.match_category(role(spark, d, "companies").select("row_id", "city"), taxonomy, "city").select("row_id", "category")


@query("sector_suffixes", f"SELECT row_id, lower(category) AS sector FROM {COMPANIES}")
def sector_suffixes(spark, d):
    c = role(spark, d, "companies")
    sectors = c.select(F.lower("category").alias("sector")).distinct().withColumn("pos", F.col("sector"))
    return J.sector_suffixes(c.select("row_id", "category"), sectors).select("row_id", "sector")


@query("llm_cost", f"SELECT model, count(*) AS calls, round(sum((prompt_tokens * i + completion_tokens * o) / 1e6), 8) AS cost FROM {LEDGER} l JOIN (VALUES ('mini', 0.15, 0.6), ('large', 2.5, 10.0), ('unknown-model', 0.15, 0.6)) p(model, i, o) USING (model) GROUP BY model")
def llm_cost(spark, d):
    prices = spark.createDataFrame([("mini", 0.15, 0.6), ("large", 2.5, 10.0)], "model string, input_per_1m double, output_per_1m double")
    return A.llm_cost(role(spark, d, "ledger"), prices, "mini")


# --- telemetry -------------------------------------------------------------------------------------------------------
@query("ledger_summary", f"SELECT round(sum(cost_eur), 6) AS cost_eur, count(*) AS calls, round(avg(success::INT), 6) AS success_rate, round(sum(cost_eur) / count(DISTINCT company_id), 6) AS cost_per_company FROM {LEDGER}")
def ledger_summary(spark, d):
    return A.ledger_summary(role(spark, d, "ledger"))


@query(
    "health_snapshot",
    f"""WITH l AS (SELECT *, time_bucket(INTERVAL 1 DAY, ts) AS w FROM {LEDGER}), p AS (SELECT w, provider FROM l GROUP BY ALL HAVING count(*) >= 5 AND avg((NOT success)::INT) > 0.3)
      SELECT w AS window_start, count(*) AS total_calls, round(avg((NOT success)::INT), 9) AS error_rate, round(avg(duration_ms), 6) AS avg_duration_ms, list_sort(list(duration_ms))[floor(count(*) * 0.95)::INT + 1] AS p95_duration_ms, round(sum(cost_eur), 6) AS cost_eur,
      round(avg(cache_hit::INT), 9) AS cache_hit_rate, coalesce((SELECT string_agg(provider, ',' ORDER BY provider) FROM p WHERE p.w = l.w), '') AS providers_unhealthy FROM l GROUP BY w""",
)
def health_snapshot(spark, d):
    out = A.health_snapshot(role(spark, d, "ledger"))
    return out.select("window_start", "total_calls", F.round("error_rate", 9).alias("error_rate"), F.round("avg_duration_ms", 6).alias("avg_duration_ms"), "p95_duration_ms", F.round("cost_eur", 6).alias("cost_eur"), F.round("cache_hit_rate", 9).alias("cache_hit_rate"), "providers_unhealthy")


@query("provider_health", f"SELECT provider, round(avg((NOT success)::INT), 9) AS error_rate, round(avg(duration_ms), 6) AS avg_ms, CASE WHEN avg((NOT success)::INT) > 0.3 THEN 'UNHEALTHY' WHEN avg(duration_ms) > 10000 THEN 'DEGRADED' ELSE 'HEALTHY' END AS state FROM {LEDGER} GROUP BY provider")
def provider_health(spark, d):
    return A.provider_health(role(spark, d, "ledger")).withColumns({"error_rate": F.round("error_rate", 9), "avg_ms": F.round("avg_ms", 6)})


@query("block_profile", f"""SELECT domain, block_type, n, sum(n) OVER (PARTITION BY domain)::BIGINT AS domain_total, sum(n) OVER (PARTITION BY domain) >= 200 AS hot
  FROM (SELECT domain, block_type, count(*) AS n FROM (SELECT event_id, {sql_host("url")} AS domain FROM {LEDGER}) JOIN ({ORACLES["classify_blocks"]}) USING (event_id) WHERE block_type <> 'NONE' GROUP BY ALL)""")
def block_profile(spark, d):
    kind, _ = P.classify_block(F.col("http_status"), F.col("body"))
    return A.block_profile(role(spark, d, "ledger").select(P.block_domain(F.col("url")).alias("domain"), kind.alias("block_type")), 200)


@query("run_metrics", f"SELECT count(*) AS total, count(*) FILTER (success) AS ok, count(*) FILTER (NOT success AND event_id % 2 = 0) AS no_domain, count(*) FILTER (NOT success AND event_id % 2 = 1) AS error, floor(avg(duration_ms) + 0.5)::BIGINT AS avg_latency_ms FROM {LEDGER}")
def run_metrics(spark, d):
    status = F.when(F.col("success"), "OK").when(F.col("event_id") % 2 == 0, "NO_DOMAIN_FOUND").otherwise("ERROR")
    return A.run_metrics(role(spark, d, "ledger").select(status.alias("status"), F.col("duration_ms").alias("latency_ms")))


@query("db_stats", f"SELECT (SELECT count(*) FROM {COMPANIES}) AS total, (SELECT count(DISTINCT user_id) FROM events) AS enriched, (SELECT count(*) FROM {COMPANIES}) - (SELECT count(DISTINCT user_id) FROM events) AS pending, (SELECT count(DISTINCT company_id) FROM {LEDGER} WHERE NOT success) AS failed")
def db_stats(spark, d):
    done = spark.read.parquet(f"{d}/events.parquet").select("user_id").distinct()
    return A.db_stats(role(spark, d, "companies"), done, role(spark, d, "ledger").withColumn("status", F.when(~F.col("success"), "FAILED")))


_distinct_parts = "CASE WHEN isodow(ts) >= 6 THEN 'weekend' ELSE 'weekday' END"


@query("distinct_rollup", f"""WITH l AS (SELECT *, {_distinct_parts} AS part FROM {LEDGER}), t AS (SELECT part, count(*) AS calls, count(DISTINCT event_id) AS events, count(DISTINCT company_id) AS companies FROM l GROUP BY part)
  SELECT part, calls, true AS events_within, true AS companies_within, events - events % 1000 AS events_about, companies FROM t""")
def distinct_rollup(spark, d):
    """Distinct events and companies of weekdays and weekends from sketches of days, against exact counts: within four standard
    errors. What is approximate is compared in Spark, the rest with SQL."""
    log = role(spark, d, "ledger").withColumn("ts", F.col("ts").cast("timestamp"))
    part = F.when(F.weekday("ts") >= 5, "weekend").otherwise("weekday")
    exact = log.groupBy(part.alias("part")).agg(F.countDistinct("event_id").alias("events"), F.countDistinct("company_id").alias("companies"))
    of_day = F.when(F.weekday("part") >= 5, "weekend").otherwise("weekday")
    rolled = {what: A.distinct_rollup(materialize(A.distinct_sketches(log, F.to_date("ts"), what)), of_day).withColumnRenamed("distinct", what + "_") for what in ("event_id", "company_id")}
    near = lambda a, b: F.abs(F.col(a) - F.col(b)) <= F.greatest(4 * 0.013 * F.col(b), F.lit(1.0))
    out = exact.join(rolled["event_id"], "part").join(rolled["company_id"].drop("calls"), "part")
    return out.select("part", "calls", near("event_id_", "events").alias("events_within"), near("company_id_", "companies").alias("companies_within"), (F.col("events") - F.col("events") % 1000).alias("events_about"), "companies")


@query("url_vote", f"""SELECT company_id, url, total, least(total / 20, 0.95) AS confidence FROM (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY total DESC, url) AS n FROM (SELECT company_id, source_url AS url, sum(s)::BIGINT AS total
  FROM (SELECT *, pos % 4 - 1 AS s FROM {CANDIDATES}) WHERE s > 0 GROUP BY ALL)) WHERE n = 1""")
def url_vote(spark, d):
    return A.url_vote(role(spark, d, "candidates").select("company_id", F.col("source_url").alias("url"), (F.col("pos") % 4 - 1).alias("score")))


@query("source_mix", f"SELECT count(*) FILTER (row_id % 3 = 2) AS merged, count(*) FILTER (row_id % 3 = 0) AS pg_only, count(*) FILTER (row_id % 3 = 1) AS maps_only FROM {COMPANIES}")
def source_mix(spark, d):
    source = F.when(F.col("row_id") % 3 == 0, "PG").when(F.col("row_id") % 3 == 1, "Maps").otherwise("PG + Maps")
    return A.source_mix(role(spark, d, "companies").select(source.alias("source")))


@query("campaign_yield", f"SELECT count(*) FILTER (success) AS found, count(*) FILTER (NOT success AND event_id % 2 = 0) AS not_found, count(*) FILTER (NOT success AND event_id % 2 = 1) AS errors, round(sum(cost_eur), 6) AS cost_eur, round(sum(cost_eur) / count(*), 8) AS cost_per_company FROM {LEDGER}")
def campaign_yield(spark, d):
    status = F.when(F.col("success"), "FOUND_VALID").when(F.col("event_id") % 2 == 0, "NOT_FOUND").otherwise("ERROR")
    return A.campaign_yield(role(spark, d, "ledger").select(status.alias("status"), "cost_eur"))


@query("split_overflow_targets", f"""SELECT category, coalesce(province, '-') AS province, coalesce(m.n_name, coalesce(province, '-')) AS target, n FROM (SELECT category, province, count(*) AS n FROM {COMPANIES} GROUP BY ALL) c LEFT JOIN nation m
  ON n > 60 AND (CASE m.n_nationkey % 3 WHEN 0 THEN 'MI' WHEN 1 THEN 'rm' ELSE 'Torino' END) = coalesce(province, '-')""")
def split_overflow_targets(spark, d):
    towns = spark.read.parquet(f"{d}/nation.parquet").select(F.col("n_name").alias("municipality"), F.when(F.col("n_nationkey") % 3 == 0, "MI").when(F.col("n_nationkey") % 3 == 1, "rm").otherwise("Torino").alias("m_province"))
    return A.split_overflow_targets(role(spark, d, "companies").withColumn("province", F.coalesce("province", F.lit("-"))), towns, 60)


@query("running_totals", f"""SELECT provider, count(*) AS processed, count(*) FILTER (success) AS found, round(avg(success::INT), 9) AS yield, count(*) FILTER (last IS NULL OR (ts, event_id) > last) AS consecutive_failures
  FROM (SELECT *, max(CASE WHEN success THEN (ts, event_id) END) OVER (PARTITION BY provider) AS last FROM {LEDGER}) GROUP BY provider""")
def running_totals(spark, d):
    return A.running_totals(role(spark, d, "ledger")).withColumn("yield", F.round("yield", 9))


_windows = f"""SELECT run_id, time_bucket(INTERVAL 300 SECOND, ts) AS window_start, sum(cost_eur) / count(DISTINCT company_id) AS cost_per_company, avg((NOT success)::INT) AS error_rate, count(*) FILTER (http_status = 429) AS exhausted FROM {LEDGER} GROUP BY ALL"""
_breaker = f"""WITH RECURSIVE h AS ({_windows}), w AS (SELECT *, cost_per_company > 0.04 OR error_rate > 0.25 AS bad, row_number() OVER (PARTITION BY run_id ORDER BY window_start) AS n FROM h),
  f AS (SELECT run_id, window_start, n, CASE WHEN bad THEN window_start END AS since FROM w WHERE n = 1
    UNION ALL SELECT w.run_id, w.window_start, w.n, CASE WHEN since IS NULL THEN CASE WHEN bad THEN w.window_start END WHEN NOT bad AND w.window_start - since >= INTERVAL 600 SECOND THEN NULL ELSE since END FROM f JOIN w ON w.run_id = f.run_id AND w.n = f.n + 1)
  SELECT run_id, window_start, since IS NOT NULL AS open FROM f"""


def _health_windows(spark, d):
    rows = role(spark, d, "ledger").groupBy("run_id", F.window("ts", "300 seconds")["start"].alias("window_start"))
    return rows.agg((F.sum("cost_eur") / F.countDistinct("company_id")).alias("cost_per_company"), F.avg((~F.col("success")).cast("int")).alias("error_rate"), F.count_if(F.col("http_status") == 429).alias("exhausted"))


@query("circuit_breaker", _breaker)
def circuit_breaker(spark, d):
    return A.circuit_breaker(_health_windows(spark, d))


@query("alerts", f"""SELECT window_start, unnest(CASE WHEN cost > 0.02 THEN ['COST_RUNAWAY'] ELSE [] END || CASE WHEN exhausted > 0 THEN ['PROVIDER_EXHAUSTION'] ELSE [] END) AS alert, exhausted FROM (SELECT time_bucket(INTERVAL 300 SECOND, ts) AS window_start, sum(cost_eur) / count(DISTINCT company_id) AS cost, count(*) FILTER (http_status = 429) AS exhausted FROM {LEDGER} GROUP BY ALL)""")
def alerts(spark, d):
    rows = role(spark, d, "ledger").groupBy(F.window("ts", "300 seconds")["start"].alias("window_start"))
    health = rows.agg((F.sum("cost_eur") / F.countDistinct("company_id")).alias("cost_per_company"), F.count_if(F.col("http_status") == 429).alias("exhausted"))
    return A.alerts(health, 0.02, 0).join(health.select("window_start", "exhausted"), "window_start").select("window_start", "alert", "exhausted")


_cooled = lambda seconds: f"""WITH RECURSIVE e AS (SELECT company_id, event_id, ts, row_number() OVER (PARTITION BY company_id ORDER BY ts, event_id) AS n FROM {LEDGER}),
  f AS (SELECT company_id, event_id, n, ts AS last, true AS approved FROM e WHERE n = 1
    UNION ALL SELECT e.company_id, e.event_id, e.n, CASE WHEN e.ts - last >= INTERVAL {seconds} SECOND THEN e.ts ELSE last END, e.ts - last >= INTERVAL {seconds} SECOND FROM f JOIN e ON e.company_id = f.company_id AND e.n = f.n + 1)
  SELECT event_id, company_id, approved FROM f"""  # noqa: E731


@query("cooldown", _cooled(86_400))
def cooldown(spark, d):
    return A.cooldown(role(spark, d, "ledger"), "company_id", 86_400)


# --- generators ------------------------------------------------------------------------------------------------------
_sector = "CASE " + " ".join(f"WHEN c <> '' AND (contains(c, '{k}') OR contains('{k}', c)) THEN {words(v)}" for k, v in G.SECTORS) + " ELSE []::VARCHAR[] END"


@query(
    "domain_candidates",
    f"""WITH t AS (SELECT row_id, {sql_tokens("company_name")} AS t, replace({sql_fold("city")}, ' ', '') AS place, lower(coalesce(province, '')) AS p, lower(coalesce(category, '')) AS c FROM {COMPANIES}),
      n AS (SELECT *, array_to_string(t, '') AS j, array_to_string(t, '-') AS d, array_to_string(list_transform(t, lambda x: substr(x, 1, 1)), '') AS i, {_sector} AS sx FROM t WHERE len(t) > 0),
      stems AS (SELECT DISTINCT row_id, unnest(list_concat(list_concat(list_concat([j, d, t[1], array_to_string(t[1:2], ''), array_to_string(t[1:2], '-')], [{", ".join(f"replace(j, '{x}', '{y}')" for x, y in G.SOUNDS)}]), CASE WHEN len(t) >= 2 THEN [i, i || t[-1], i || '-' || t[-1]] ELSE [] END),
        list_concat(list_concat(list_transform(sx, lambda x: j || x), list_transform(sx, lambda x: j || '-' || x)), [j || place, j || '-' || place, d || '-' || place, j || p, j || '-' || p]))) AS stem FROM n),
      hosts AS (SELECT row_id, w || stem || '.' || e AS domain FROM stems, (VALUES ('it'), ('com'), ('eu')) x(e), (VALUES (''), ('www.')) y(w) WHERE regexp_full_match(stem, '[a-z0-9][a-z0-9-]*[a-z0-9]'))
      SELECT row_id, place, domain FROM (SELECT row_id, domain, row_number() OVER (PARTITION BY row_id ORDER BY NOT ends_with(domain, '.it'), length(domain), length(domain) - length(replace(domain, '-', '')), domain) AS place FROM hosts WHERE length(domain) <= 70) WHERE place <= 80""",
)
def domain_candidates(spark, d):
    return G.domain_candidates(role(spark, d, "companies"))


@query("guess_domains", f"SELECT row_id, unnest(list_distinct([x || e for x in [array_to_string({sql_tokens('company_name')}, ''), array_to_string({sql_tokens('company_name')}, '-')] for e in ['.it', '.com', '.eu', '.net']])) AS domain FROM {COMPANIES}".replace("[x || e for x in [", "list_concat(list_transform(['.it', '.com', '.eu', '.net'], lambda e: ").replace(", ''), array_to_string(", ", '') || e), list_transform(['.it', '.com', '.eu', '.net'], lambda e: array_to_string(").replace(", '-')] for e in ['.it', '.com', '.eu', '.net']]", ", '-') || e))"))
def guess_domains(spark, d):
    return role(spark, d, "companies").select("row_id", F.explode(G.guess_domains(F.col("company_name"))).alias("domain"))


_excluded = " ".join(f"-site:{x}" for x in G.EXCLUDED)
_q = lambda x: f"trim(coalesce({x}, ''))"
_tidy = lambda x: f"""trim(regexp_replace(regexp_replace({x}, '\\s""', '', 'g'), '""\\s', '', 'g'))"""


@query(
    "search_frontier",
    f"""SELECT row_id, row_number() OVER (PARTITION BY row_id ORDER BY x.p DESC) AS place, {_tidy("x.t")} AS query, x.k AS kind, x.p AS "precision" FROM (SELECT row_id, unnest(list_filter([
      {{t: '"P.IVA ' || vat || '"', k: 'vat_anchor', p: 0.95::DOUBLE, w: length(vat) = 11}}, {{t: '"' || vat || '" site:.it', k: 'vat_anchor', p: 0.9::DOUBLE, w: length(vat) = 11}},
      {{t: 'site:' || mail, k: 'domain_probe', p: 0.88::DOUBLE, w: contains(email, '@') AND mail <> '' AND NOT (contains(mail, 'gmail') OR contains(mail, 'yahoo') OR contains(mail, 'hotmail') OR contains(mail, 'pec.it'))}},
      {{t: '"' || phone || '" "' || name || '"', k: 'contact_vector', p: 0.82::DOUBLE, w: length(phone) >= 7}}, {{t: '"' || name || '" "' || city || '" {_excluded}', k: 'exclusionary', p: 0.8::DOUBLE, w: true}},
      {{t: 'intitle:"' || name || '" "contatti" "' || city || '"', k: 'contact_vector', p: 0.78::DOUBLE, w: true}}, {{t: '"' || address || '" "' || city || '" "' || name || '"', k: 'contact_vector', p: 0.75::DOUBLE, w: length(address) > 5}},
      {{t: '"' || name || '" "' || city || '" "privacy policy" OR "note legali"', k: 'contact_vector', p: 0.72::DOUBLE, w: true}}, {{t: 'site:.it "' || name || '" "' || city || '"', k: 'domain_probe', p: 0.65::DOUBLE, w: true}},
      {{t: '"' || name || '" "' || category || '" ' || city || ' sito', k: 'standard', p: 0.62::DOUBLE, w: length(category) > 2}}, {{t: '"' || name || '" "' || province || '" sito ufficiale', k: 'standard', p: 0.58::DOUBLE, w: length(province) >= 2 AND province <> city}},
      {{t: '"' || name || '" ' || city || ' sito ufficiale', k: 'standard', p: 0.55::DOUBLE, w: true}}], lambda z: z.w)) AS x
    FROM (SELECT row_id, {_q("company_name")} AS name, {_q("city")} AS city, {_q("phone")} AS phone, {_q("address")} AS address, {_q("category")} AS category, {_q("province")} AS province, {_q("email")} AS email,
      split_part({_q("email")}, '@', 2) AS mail, {sql_digits("vat")} AS vat FROM {COMPANIES}))""",
)
def search_frontier(spark, d):
    return G.search_frontier(role(spark, d, "companies"))


_core = "trim(regexp_replace(name, '(?i)\\b(srl|snc|sas|spa)\\b', '', 'g'))"
_loc = "CASE WHEN city <> '' THEN ' ' || city ELSE '' END"
_place = "CASE WHEN city <> '' THEN ' \"' || city || '\"' ELSE '' END"
_clean = "substr(trim(regexp_replace(regexp_replace(regexp_replace({x}, '[\"''«»‹›„“”‘’]', '', 'g'), '[()\\[\\]{{}}<>|&!^~*?:/\\\\]', ' ', 'g'), '\\s+', ' ', 'g')), 1, 200)".format


@query(
    "query_forms",
    f"""SELECT row_id, x.f AS form, {_tidy("x.q")} AS query FROM (SELECT row_id, unnest([
      {{f: 'initial', q: '"' || name || '" ' || city, w: name <> ''}}, {{f: 'fallback', q: '"' || name || '" ' || city || ' sito ufficiale', w: name <> ''}}, {{f: 'fallback', q: name || ' ' || city || ' website', w: name <> ''}},
      {{f: 'phone', q: '"' || phone || '" "' || name || '"', w: length(d) >= 7}}, {{f: 'phone', q: '"' || d || '" ' || city || ' sito', w: length(d) >= 7}}, {{f: 'phone', q: '"' || substr(d, 3) || '" ' || city || ' "' || name || '"', w: starts_with(d, '39') AND length(d) > 10}},
      {{f: 'contact', q: '"' || name || '" "' || city || '" ("chi siamo" OR "contatti" OR "about us")', w: true}}, {{f: 'nuclear', q: '"' || core || '" "cookie policy"', w: true}}, {{f: 'nuclear', q: 'intitle:"' || core || '" ' || city, w: true}},
      {{f: 'vat', q: '"' || vat || '" filetype:pdf', w: vat <> ''}}, {{f: 'legal_name', q: '"' || name || '"' || {_place}, w: name <> ''}}, {{f: 'site', q: '"' || name || '"' || {_loc}, w: name <> ''}},
      {{f: 'company', q: clean || ' ' || place, w: clean <> '' AND place <> ''}}, {{f: 'balance', q: '"' || clean || '" ' || place || ' filetype:pdf bilancio OR "stato patrimoniale"', w: clean <> ''}}]) AS x
    FROM (SELECT *, {_core} AS core, {_clean(x="name")} AS clean, {_clean(x="city")} AS place FROM (SELECT row_id, {_q("company_name")} AS name, {_q("city")} AS city, {_q("phone")} AS phone, {_q("vat")} AS vat, {sql_digits("phone")} AS d FROM {COMPANIES}))) WHERE x.w""",
)
def query_forms(spark, d):
    """Some strings of each form; all of them are made."""
    forms = ["initial", "fallback", "phone", "contact", "nuclear", "vat", "legal_name", "site", "company", "balance"]
    c = role(spark, d, "companies")
    named = lambda f: F.transform(G.query_forms(c, f), lambda x: F.struct(F.lit(f).alias("form"), x.alias("query")))
    rows = c.select("row_id", F.explode(F.concat(*[named(f) for f in forms])).alias("x")).select("row_id", "x.form", "x.query")
    kept = F.when(F.col("form") == "nuclear", F.contains("query", F.lit("cookie policy")) | F.col("query").startswith("intitle:")).when(F.col("form") == "vat", F.col("query").endswith("filetype:pdf"))
    kept = kept.when(F.col("form") == "legal_name", F.col("query").startswith('"') & ~F.col("query").rlike("Via Roma|contattaci|sito ufficiale|Partita IVA")).when(F.col("form") == "site", ~F.col("query").rlike("sito ufficiale|site:")).when(F.col("form") == "company", ~F.contains("query", F.lit('"')))
    return rows.where(kept.otherwise(F.lit(True)))


@query("url_plan", f"SELECT row_id, unnest(list_distinct([website, 'https://' || h, 'http://' || h])) AS url FROM (SELECT row_id, website, regexp_extract(website, '^https?://([^/?#]+)', 1) AS h FROM {COMPANIES} WHERE website IS NOT NULL)")
def url_plan(spark, d):
    return role(spark, d, "companies").where("website is not null").select("row_id", F.explode(G.url_plan(F.col("website"))).alias("url"))


@query("missing_website", f"SELECT row_id FROM {COMPANIES} WHERE website IS NULL")
def missing_website(spark, d):
    return IO.missing_website(role(spark, d, "companies")).select("row_id")


@query("split_by_score", f"SELECT company_name, coalesce(vat, CASE WHEN balance > 4000 THEN NULL ELSE '' END) AS vat, balance > 4000 AS above FROM {COMPANIES}")
def split_by_score(spark, d):
    above, rest = IO.split_by_score(role(spark, d, "companies").withColumn("score", F.col("balance").cast("string")), 4000)
    return above.select("company_name", "vat", F.lit(True).alias("above")).unionByName(rest.select("company_name", "vat", F.lit(False).alias("above")))


@query("retry_rows", f"SELECT event_id FROM {LEDGER} WHERE NOT success AND provider <> 'view'")
def retry_rows(spark, d):
    status = F.when(F.col("success"), "OK").when(F.col("provider") == "view", "").otherwise("ERROR")
    return IO.retry_rows(role(spark, d, "ledger").withColumn("status", status)).select("event_id")


@query("without_http", f"SELECT row_id FROM {COMPANIES} WHERE website IS NULL OR NOT contains(website, 'http')")
def without_http(spark, d):
    return IO.missing_website(role(spark, d, "companies"), "http").select("row_id")


@query("unify_campaigns", f"SELECT row_id, company_name, replace(vat, ' ', '') AS vat, city, 'IT' AS country FROM {COMPANIES}")
def unify_campaigns(spark, d):
    c = role(spark, d, "companies").select("row_id", F.col("company_name").alias("ragione_sociale"), F.col("vat").alias("piva"), F.lit("").alias("city"), F.col("city").alias("comune"))
    return IO.unify_campaign_schema(c).select("row_id", "company_name", "vat", "city", "country")


# --- pages -----------------------------------------------------------------------------------------------------------
def _pages(spark, d):
    return spark.read.parquet(f"{d}/pages.parquet")


@query("extract_pages")
def extract_pages(spark, d):
    out = H.extract_page(_pages(spark, d))
    return out.select("page_id", "title", F.length("text").alias("n_text"), F.md5("text").alias("text_md5"), *[F.size(x).alias(f"n_{x}") for x in ("h1", "internal", "external", "contact", "privacy", "emails", "vats")])


@query("html_to_text")
def html_to_text(spark, d):
    return H.html_to_text(_pages(spark, d)).select("page_id", F.length("text").alias("n_chars"), F.md5("text").alias("md5"))


@query("clean_html")
def clean_html(spark, d):
    return H.clean_html(_pages(spark, d)).select("page_id", F.length("text").alias("n_chars"), F.md5("text").alias("md5"))


@query("serp_rows", f"""SELECT page_id, 1::INT AS place, 'https://azienda' || n || '.it/' AS url, 'Azienda' AS title, CASE n % 3 WHEN 0 THEN 'google' WHEN 1 THEN 'bing' ELSE 'duckduckgo' END AS engine FROM {PROFILES}
  UNION ALL SELECT page_id, 2, 'https://notbing.com/' || n, 'Altra', 'bing' FROM {PROFILES} WHERE n % 3 = 1""")
def serp_rows(spark, d):
    return H.serp_rows(role(spark, d, "profiles").select("page_id", "url", F.col("results").alias("html")), C.SEARCH_ENGINES)


@query("page_links")
def page_links(spark, d):
    """Stored pages as they are, which have no engine's blocks: all their links to other sites."""
    return H.serp_rows(_pages(spark, d), C.SEARCH_ENGINES)


@query("listing_rows", f"""SELECT page_id, 1::INT AS place, 'Azienda ' || n AS name, '02' || lpad(n::VARCHAR, 7, '0') AS phone, 'https://azienda' || n || '.it/' AS website, 'Via Roma, ' || (n % 90 + 1) AS street, '20' || lpad((n % 1000)::VARCHAR, 3, '0') AS zip, 'Milano' AS city, 'MI' AS province FROM {PROFILES}""")
def listing_rows(spark, d):
    return H.listing_rows(role(spark, d, "profiles").select("page_id", F.col("profile").alias("html")))


@query("labelled_fields", f"SELECT page_id, CASE n % 3 WHEN 0 THEN 'S.r.l.' WHEN 1 THEN 'Spa' END AS legal_form, n || ' mln' AS revenue, (n % 50)::VARCHAR AS employees, n::VARCHAR AS profit FROM {PROFILES}")
def labelled_fields(spark, d):
    labels = {k: H.PROFILE_LABELS[k] for k in ("legal_form", "revenue", "employees", "profit")}
    return H.labelled_fields(role(spark, d, "profiles").select("page_id", F.col("profile").alias("html")), labels)


@query("schema_org")
def schema_org(spark, d):
    """The JSON-LD of each stored page, compared with the company of its id."""
    found = H.extract_page(_pages(spark, d)).select("page_id", "jsonld")
    rows = found.join(role(spark, d, "companies").select(F.col("row_id").alias("page_id"), "website", "phone", "vat"), "page_id", "left")
    return H.schema_org_signals(rows).join(H.jsonld_walk(rows, ["telephone", "vatid"]), "page_id")


@query("evidence_links", f"SELECT page_id, len(list_filter(list_distinct(l), lambda x: {sql_host('x')} = {sql_host('url')} AND regexp_matches(lower(x), 'contatt|contact|privacy|chi-siamo|about'))) AS n FROM (SELECT page_id, url, list_transform(regexp_extract_all(coalesce(html, ''), 'href=\"(/[^\"]*)\"', 1), lambda h: regexp_extract(url, '^(https?://[^/?#]+)', 1) || h || '/about') AS l FROM pages)")
def evidence_links(spark, d):
    root = F.regexp_extract("url", "^(https?://[^/?#]+)", 1)
    links = F.array_distinct(F.transform(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit('href="(/[^"]*)"'), F.lit(1)), lambda h: F.concat(root, h, F.lit("/about"))))
    return _pages(spark, d).select("page_id", F.size(P.evidence_links(links, F.col("url"))).cast("long").alias("n"))


@query("minify_html", "SELECT page_id, md5(trim(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''), '(?is)<(script|style|noscript)[^>]*>.*?</(script|style|noscript)>|<!--.*?-->', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g'))) AS md5 FROM pages")
def minify_html(spark, d):
    return _pages(spark, d).select("page_id", F.md5(P.minify_html(F.col("html"))).alias("md5"))


@query("trap_check", f"SELECT page_id, len(regexp_extract_all(lower(coalesce(html, '')), '<a\\s')) > 5 AS link_farm, {_any('lower(coalesce(html, chr(32)))', P.PARKING)} AS parked FROM pages")
def trap_check(spark, d):
    farm, parked = P.trap_check(F.col("html"), 5)
    return _pages(spark, d).select("page_id", farm.alias("link_farm"), parked.alias("parked"))


@query("search_json", f"""SELECT page_id, place, url, title, description FROM (
    SELECT page_id, 1 AS place, url, title, 'd' AS description FROM {RESPONSES} WHERE form < 3 UNION ALL SELECT page_id, 2, url || '/more', NULL, title FROM {RESPONSES} WHERE form < 3
    UNION ALL SELECT page_id, unnest(range(1, len(u) + 1)), unnest(u), NULL, NULL FROM (SELECT page_id, list_filter(u, lambda x, i: list_position(u, x) = i) AS u
      FROM (SELECT page_id, regexp_extract_all(body || ' https://www.' || page_id || '.it/a?b=' || page_id || ' https://b.it', 'https?://[^\\s"''<>)\\]]+') AS u FROM {RESPONSES} WHERE form = 3)))""")
def search_json(spark, d):
    """Responses of all three JSON forms; what is no JSON, stored pages with two addresses in their text, gives its URLs."""
    body = F.when(F.col("form") == 3, F.concat("body", F.lit(" https://www."), "page_id", F.lit(".it/a?b="), "page_id", F.lit(" https://b.it"))).otherwise(F.col("body"))
    return IO.parse_search_json(role(spark, d, "responses").select("page_id", body.alias("body"))).select("page_id", "place", "url", "title", "description")


@query("candidates_with_pages", f"SELECT company_id, pos, l.event_id FROM {CANDIDATES} c JOIN (SELECT max(event_id) AS event_id, 'https://www.site' || (event_id % 100) || '.it/A' AS u FROM {LEDGER} WHERE http_status < 400 GROUP BY u) l ON u = source_url")
def candidates_with_pages(spark, d):
    url = F.format_string("https://www.site%d.it/A", F.col("event_id") % 100)
    seen = role(spark, d, "ledger").where("http_status < 400").groupBy(url.alias("url")).agg(F.max("event_id").alias("event_id")).withColumn("status", F.lit(200))
    return J.candidates_with_pages(role(spark, d, "candidates"), seen).select("company_id", "pos", "event_id")


@query("pages_by_vat", f"SELECT c.row_id AS page_id, o.company_id FROM {COMPANIES} c JOIN {COMPANIES} o ON o.vat IS NOT NULL AND {sql_digits('o.vat')} = {sql_digits('c.vat')}")
def pages_by_vat(spark, d):
    c = role(spark, d, "companies")
    return J.pages_by_vat(c.select(F.col("row_id").alias("page_id"), F.concat(F.lit("P.IVA: "), F.regexp_replace("vat", "^IT", "")).alias("text")), c)


@query(
    "match_phones",
    f"""WITH p AS (SELECT DISTINCT row_id, regexp_replace(replace(unnest({_parts}), '+', ''), '^00', '') AS raw FROM {COMPANIES}), n AS (SELECT row_id, CASE WHEN starts_with(raw, '0') OR starts_with(raw, '3') THEN '39' || raw ELSE raw END AS a, raw AS b FROM p),
      pages AS (SELECT b, min(row_id) AS page_id, count(DISTINCT row_id) AS n_pages FROM n GROUP BY b),
      pairs AS (SELECT DISTINCT a, pages.* FROM (SELECT DISTINCT a FROM n) x JOIN pages ON right(x.a, 8) = right(pages.b, 8) AND {_same_phone("x.a", "pages.b")})
      SELECT row_id, min(page_id) AS page_id, sum(n_pages)::BIGINT AS n_pages FROM (SELECT DISTINCT row_id, a FROM n) JOIN pairs USING (a) GROUP BY row_id""",
)
def match_phones(spark, d):
    """All numbers of all companies, as written with the country's prefix, against those shown without it."""
    c = role(spark, d, "companies")
    formatted, raw = C.normalize_phones(F.col("phone"))
    return J.match_phones(c.select("row_id", formatted.alias("phones")), c.select(F.col("row_id").alias("page_id"), raw.alias("found")))


@query(
    "best_listing",
    f"""WITH c AS (SELECT *, right({sql_digits("phone")}, 8) AS k FROM {COMPANIES}), l AS (SELECT k, row_id AS listing_id, {sql_fold("CASE WHEN row_id % 2 = 0 THEN company_name ELSE category END")} AS f FROM c)
      SELECT row_id, listing_id, round(s, 6) AS name_score, m AS n_listings FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY s DESC, listing_id) AS n, count(*) OVER (PARTITION BY row_id) AS m
        FROM (SELECT row_id, listing_id, {_cover("company_name", "f")} AS s FROM c JOIN l USING (k))) WHERE n = 1 AND (s >= 0.15 OR m = 1)""",
)
def best_listing(spark, d):
    c = role(spark, d, "companies").withColumn("phone_key", F.substring(F.regexp_replace("phone", "[^0-9]", ""), -8, 8))
    listings = c.select("phone_key", F.col("row_id").alias("listing_id"), F.when(F.col("row_id") % 2 == 0, F.col("company_name")).otherwise(F.col("category")).alias("listing_name"))
    return J.best_directory_listing(c.select("row_id", "company_name", "phone_key"), listings).select("row_id", "listing_id", F.round("name_score", 6).alias("name_score"), "n_listings")


@query("confirm_identity", f"SELECT company_id, CASE WHEN row_id % 3 = 0 OR (vat IS NOT NULL AND row_id % 2 = 0) OR (province IS NOT NULL AND contains(lower('profile of ' || company_name), lower(province))) THEN 'HIGH' ELSE 'MEDIUM' END AS identity FROM {COMPANIES}")
def confirm_identity(spark, d):
    c = role(spark, d, "companies")
    text = F.concat(F.lit("Profile of "), "company_name", F.when(F.col("row_id") % 3 == 0, F.concat(F.lit(" in "), "city")).otherwise(F.lit("")), F.when(F.col("row_id") % 2 == 0, F.concat(F.lit(" iva "), F.regexp_replace(F.coalesce("vat", F.lit("")), "^IT", ""))).otherwise(F.lit("")))
    return J.confirm_identity(c.select("company_id", text.alias("text")), c).select("company_id", "identity")


@query("known_domains", f"SELECT DISTINCT g.row_id, g.domain FROM ({ORACLES['guess_domains']}) g JOIN (SELECT DISTINCT 'rossiimpianti' || row_id || '.it' AS domain FROM {COMPANIES}) USING (domain)")
def known_domains(spark, d):
    live = role(spark, d, "companies").select(F.concat(F.lit("rossiimpianti"), F.col("row_id").cast("string"), F.lit(".it")).alias("domain"))
    return J.known_domains(guess_domains(spark, d), live)


@query("page_boosts", f"""SELECT company_id, pos, round(x, 6) AS confidence, CASE WHEN x >= 0.85 THEN 'RULE_STRONG' ELSE 'RULE_WEAK' END AS level FROM (SELECT *, CASE WHEN t >= 0.6 AND y < 0.85 THEN y + 0.1 ELSE y END AS x FROM (
  SELECT *, CASE WHEN layer = 4 AND z < 0.9 THEN z - 0.03 ELSE z END AS y FROM (SELECT company_id, pos, layer, final_score / 100 AS t, least(0.99, CASE WHEN n_vats > 0 AND n_phones > 0 THEN greatest(confidence, 0.99) ELSE confidence END + CASE WHEN n_phones > 1 THEN 0.1 ELSE 0 END + CASE WHEN n_vats > 0 THEN 0.05 ELSE 0 END) AS z
  FROM {CANDIDATES})))""")
def page_boosts(spark, d):
    vats, phones = F.col("n_vats") > 0, F.col("n_phones")
    x, level = S.apply_page_boosts(F.col("confidence"), vats & (phones > 0), phones > 1, vats, F.col("layer") == 4, F.col("final_score") / 100)
    return role(spark, d, "candidates").select("company_id", "pos", F.round(x, 6).alias("confidence"), level.alias("level"))


@query("priorities", f"SELECT company_id, pos, round(confidence + 0.25 * CASE WHEN length(j) >= 3 AND contains(h, j) THEN 1 WHEN len(t) = 0 THEN 0 ELSE len(list_filter(t, lambda x: contains(h, x))) / len(t) END, 6) AS priority, round(0.6 + 0.2 * confidence, 6) AS search_confidence FROM (SELECT *, {sql_tokens('company_name')} AS t, array_to_string({sql_tokens('company_name')}, '') AS j, regexp_replace({sql_host('source_url')}, '[^a-z0-9]', '', 'g') AS h FROM {CANDIDATES})")
def priorities(spark, d):
    c = F.col("confidence")
    return role(spark, d, "candidates").select("company_id", "pos", F.round(S.candidate_priority(c, M.domain_coverage(F.col("company_name"), F.col("source_url"))), 6).alias("priority"), F.round(S.search_confidence(c), 6).alias("search_confidence"))


@query("token_shares", f"""SELECT p_partkey, CASE WHEN len(a) = 0 THEN 0 ELSE len(list_filter(a, lambda x: list_contains(b, x))) / len(a) END AS overlap, CASE WHEN len(a) = 0 THEN 0 ELSE len(list_filter(a, lambda x: contains(lower(p_type), x))) / len(a) END AS hits
  FROM (SELECT *, {_words_of("p_name")} AS a, {_words_of("p_type")} AS b FROM part)""")
def token_shares(spark, d):
    tokens, text = M.long_tokens(F.col("p_name")), F.col("p_type")
    return spark.read.parquet(f"{d}/part.parquet").select("p_partkey", M.token_overlap(tokens, text).alias("overlap"), M.token_hits(tokens, text).alias("hits"))


@query("page_predicates", f"""SELECT doc_id, contains(t, 'fatturato') AND (contains(t, 'partita iva') OR contains(t, 'p.iva') OR contains(t, 'codice fiscale')) AS company_page, nullif(regexp_replace(coalesce(text, ''), '[^0-9,-]', '', 'g'), '') AS currency,
  nullif(trim(regexp_extract(coalesce(text, ''), '^\\s*#*[ \\t]*([^\\n]*)', 1)), '') AS first_line FROM (SELECT *, lower(coalesce(text, '')) AS t FROM {REPORTS})""")
def page_predicates(spark, d):
    t = F.col("text")
    return role(spark, d, "reports").select("doc_id", P.is_valid_company_page(t).alias("company_page"), P.clean_currency(F.coalesce(t, F.lit(""))).alias("currency"), P.first_line_title(t).alias("first_line"))


@query("official_urls", f"SELECT company_id, pos, {sql_host('source_url')} <> 'facebook.com' AND regexp_matches(lower(source_url), '^https?://') AS official FROM {CANDIDATES}")
def official_urls(spark, d):
    return role(spark, d, "candidates").select("company_id", "pos", P.likely_official_url(F.col("source_url"), "facebook.com").alias("official"))


@query("url_heuristics", f"SELECT company_id, pos, CASE WHEN contains('site' || (company_id % 100), 'site') AND contains(regexp_replace({sql_host('source_url')}, '[^a-z0-9]', '', 'g'), 'site' || (company_id % 100)) THEN 5 ELSE 0 END + CASE WHEN {sql_host('source_url')} LIKE '%.it' THEN 2 ELSE 0 END + CASE WHEN {listed(sql_host('source_url'), C.DIRECTORIES)} THEN -10 ELSE 0 END AS score FROM {CANDIDATES}")
def url_heuristics(spark, d):
    return role(spark, d, "candidates").select("company_id", "pos", S.url_heuristic_score(F.concat(F.lit("site"), (F.col("company_id") % 100).cast("string")), F.col("source_url")).alias("score"))


_tried = lambda patterns: "coalesce(" + ", ".join(f"nullif(trim(regexp_extract(t, '{q(p)}', 1)), '')" for p in patterns) + ")"


@query("figures", f"""SELECT doc_id, {_tried(P.REVENUE)} AS revenue, {_tried(P.EMPLOYEES)} AS employees, {_tried([r"(?i)fatturato[^\n]{0,40}?\b(20[12]\d)\b", r"\b(20[12]\d)\b"])} AS year,
  try_cast(nullif(replace(regexp_extract(t, '(\\d{{1,3}}(?:\\.\\d{{3}})+)', 1), '.', ''), '') AS BIGINT) AS amount FROM (SELECT doc_id, coalesce(text, '') AS t FROM {REPORTS})""")
def figures(spark, d):
    t = F.col("text")
    return role(spark, d, "reports").select("doc_id", P.financials(t).alias("f"), P.snippet_revenue(t)[0].alias("amount")).select("doc_id", "f.revenue", "f.employees", "f.year", "amount")


# --- streams ---------------------------------------------------------------------------------------------------------
def _streamed(spark, d, name: str, columns: list[str], behind: Column | None = None):
    """A role as a stream of three batches, and ``drained(stream, mode)``: the result of a stream made of it. The thirds of the span of
    ``ts`` (rows without a time in the first) arrive one after the other, each whole when the stream is done with the one
    before, so that no batch depends on how many files a third is written to. Rows of ``behind`` come with the last third."""
    path = f"{shared_dir(spark)}/streams/{uuid.uuid4().hex}"
    rows = role(spark, d, name)
    rows = rows.withColumn("ts", F.col("ts").cast("timestamp"))
    ends = rows.agg(F.min("ts"), F.max("ts")).first()
    steps = [ends[0] + (ends[1] - ends[0]) * i / 3 for i in range(1, 3)] if ends[0] else []
    part = sum([F.coalesce(F.col("ts") > F.lit(x), F.lit(False)).cast("int") for x in steps], F.lit(0))
    part = part if behind is None else F.when(behind, len(steps)).otherwise(part)
    arrive = lambda i: rows.where(part == i).select(*columns).write.mode("append").parquet(f"{path}/in")
    arrive(0)

    def drained(stream: DataFrame, mode: str = "append") -> DataFrame:
        out = T.drain(stream, f"{path}/out", f"{path}/checkpoint", mode)
        for i in range(1, len(steps) + 1):
            arrive(i)
            out = T.drain(stream, f"{path}/out", f"{path}/checkpoint", mode)
        return out

    return spark.readStream.schema(rows.select(*columns).schema).parquet(f"{path}/in"), drained


def _straggling(spark, d, columns: list[str]):
    """The ledger as a stream in which every tenth call of the first third comes with the last third."""
    ends = role(spark, d, "ledger").select(F.col("ts").cast("timestamp").alias("ts")).agg(F.min("ts"), F.max("ts")).first()
    first = F.col("ts") <= F.lit(ends[0] + (ends[1] - ends[0]) / 3) if ends[0] else F.lit(False)
    return _streamed(spark, d, "ledger", columns, (F.col("event_id") % 10 == 0) & first)


@query("stream_block_counts", f"SELECT domain, block_type, count(*) AS n, count(*) >= 30 AS hot FROM (SELECT event_id, {sql_host('url')} AS domain FROM {LEDGER}) JOIN ({ORACLES['classify_blocks']}) USING (event_id) WHERE block_type <> 'NONE' GROUP BY ALL")
def stream_block_counts(spark, d):
    rows, drained = _streamed(spark, d, "ledger", ["ts", "url", "http_status", "body"])
    rows = rows.select("ts", P.block_domain(F.col("url")).alias("domain"), P.classify_block(F.col("http_status"), F.col("body"))[0].alias("block_type"))
    return drained(T.block_counts_stream(rows, 30), "complete")


@query("stream_running_totals", f"SELECT provider, count(*) AS processed, count(*) FILTER (success) AS found, round(avg(success::INT), 9) AS yield FROM {LEDGER} GROUP BY provider")
def stream_running_totals(spark, d):
    rows, drained = _streamed(spark, d, "ledger", ["ts", "provider", "success"])
    return drained(T.running_totals_stream(rows), "complete").withColumn("yield", F.round("yield", 9))


@query("stream_failure_runs", f"SELECT provider, processed, consecutive_failures FROM ({ORACLES['running_totals']})")
def stream_failure_runs(spark, d):
    """The last figures of each provider."""
    rows, drained = _streamed(spark, d, "ledger", ["ts", "event_id", "provider", "success"])
    out = drained(T.failure_runs_stream(rows))
    last = out.groupBy("provider").agg(F.max_by(F.struct("processed", "consecutive_failures"), "processed").alias("x"))
    return last.select("provider", "x.processed", "x.consecutive_failures")


_made_id = f"md5(lower(trim(company_name)) || '|' || {sql_digits('phone')} || '|' || lower(trim(city)) || '|' || lower(trim(address)))"


@query("stream_campaigns", f"""SELECT {_made_id} AS company_id, arg_min(company_name, row_id % 3) AS company_name, arg_min(city, row_id % 3) AS city, arg_min(phone, row_id % 3) AS phone, arg_min(address, row_id % 3) AS address,
  CASE min(row_id % 3) WHEN 0 THEN 'Milano' WHEN 1 THEN 'Reggio Emilia' ELSE 'unknown' END AS file_city FROM {COMPANIES} GROUP BY 1""")
def stream_campaigns(spark, d):
    """New campaign files of a folder, one at a time, normalised, given ids, first seen only, merged into a table by id; all its fields."""
    path = f"{shared_dir(spark)}/streams/{uuid.uuid4().hex}"
    c = role(spark, d, "companies")
    fields = ["company_name", "city", "phone", "address"]
    padded = c.select("row_id", *[F.concat(F.lit(" "), x, F.lit("  ")).alias(x) for x in fields])
    for i, name in enumerate(["Milano_1.csv", "Reggio Emilia_nord_2.csv", "rest.csv"]):
        IO.write_named_csv(padded.where(F.col("row_id") % 3 == i).select(*fields), f"{path}/in/{name}", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    rows = T.watch_campaigns(spark, f"{path}/in", c.select(*fields).schema, 1)
    T.upsert_stream(T.campaign_stream(rows).drop("file"), f"{path}/table", f"{path}/checkpoint", buckets=8)
    return T.upserted(spark, f"{path}/table").select("company_id", *fields, "file_city")


@query("upsert_table", f"""SELECT company_id, n_calls, last_event FROM (SELECT company_id, count(*) AS n_calls, max(event_id) AS last_event FROM {LEDGER} GROUP BY company_id)""")
def upsert_table(spark, d):
    """Each company's calls in three batches by event, each merged over the table of the batches before."""
    table = IO_TABLES.BucketTable(spark, f"{shared_dir(spark)}/tables/{uuid.uuid4().hex}", "company_id", 16)
    log = role(spark, d, "ledger").select("company_id", "event_id")
    for n in range(3):
        so_far = log.groupBy("company_id").agg(F.count_if(F.col("event_id") % 3 <= n).alias("n_calls"), F.max(F.when(F.col("event_id") % 3 <= n, F.col("event_id"))).alias("last_event"))
        table.merge(so_far.where("n_calls > 0"), n)
    return table.read().select("company_id", "n_calls", "last_event")


@query("stream_ledger", f"SELECT provider, count(*) AS calls, round(sum(cost_eur), 6) AS cost_eur, count(*) FILTER (cache_hit) AS hits FROM {LEDGER} GROUP BY provider")
def stream_ledger(spark, d):
    """A call log as JSON lines, read as a stream; the same log read at once gives the costs."""
    path = f"{shared_dir(spark)}/streams/{uuid.uuid4().hex}"
    log = role(spark, d, "ledger").select(F.col("ts").cast("timestamp").alias("timestamp"), "provider", "cost_eur", "cache_hit", "duration_ms", "success", "company_id")
    log.repartition(3).write.json(f"{path}/in")
    rows = T.read_ledger_stream(spark, f"{path}/in", IO.LEDGER, 1)
    counts = T.drain(rows.groupBy("provider").agg(F.count("*").alias("calls"), F.count_if("cache_hit").alias("hits")), f"{path}/out", f"{path}/checkpoint", "complete")
    return counts.join(IO.read_ledger(spark, f"{path}/in").groupBy("provider").agg(F.round(F.sum("cost_eur"), 6).alias("cost_eur")), "provider")


@query(
    "stream_health",
    f"""SELECT window_start, count(*) AS total_calls, round(avg((NOT success)::INT), 9) AS error_rate, round(avg(duration_ms), 6) AS avg_duration_ms, round(sum(cost_eur), 6) AS cost_eur, round(avg(cache_hit::INT), 9) AS cache_hit_rate
      FROM (SELECT *, time_bucket(INTERVAL 30 SECOND, ts) - INTERVAL 30 SECOND * unnest(range(0, 10)) AS window_start FROM {LEDGER}) GROUP BY window_start""",
)
def stream_health(spark, d):
    """All sliding windows, those still open at the end of the input included."""
    rows, drained = _streamed(spark, d, "ledger", ["ts", "success", "duration_ms", "cost_eur", "cache_hit", "company_id"])
    out = drained(T.ledger_health_stream(rows), "complete")
    return out.select("window_start", "total_calls", F.round("error_rate", 9).alias("error_rate"), F.round("avg_duration_ms", 6).alias("avg_duration_ms"), F.round("cost_eur", 6).alias("cost_eur"), F.round("cache_hit_rate", 9).alias("cache_hit_rate"))


@query("stream_cooldown", f"SELECT company_id, event_id, approved FROM ({_cooled(86_400)})")
def stream_cooldown(spark, d):
    rows, drained = _streamed(spark, d, "ledger", ["company_id", "event_id", "ts"])
    return drained(T.cooldown_stream(rows, "company_id", 86_400)).select("company_id", "event_id", "approved")


@query("stream_dedup_ttl", f"SELECT company_id, event_id FROM ({_cooled(5 * 86_400)}) WHERE approved")
def stream_dedup_ttl(spark, d):
    rows, drained = _streamed(spark, d, "ledger", ["company_id", "event_id", "ts"])
    return drained(T.dedup_ttl(rows, "company_id", 5 * 86_400)).select("company_id", "event_id")


# The same log with every tenth call of its first third arriving with the last third, far behind the watermark.
_thirds = f"(SELECT *, ts > lo + (hi - lo) / 3 AS second, ts > lo + (hi - lo) * 2 / 3 AS third FROM {LEDGER}, (SELECT min(ts) AS lo, max(ts) AS hi FROM {LEDGER}))"
_behind = "(event_id % 10 = 0 AND NOT second)"


@query("stream_late_counts", f"SELECT provider, count(*) AS rows, count(*) FILTER ({_behind} AND ts < (SELECT max(ts) FROM {_thirds} WHERE NOT third) - INTERVAL 60 SECOND) AS late FROM {_thirds} GROUP BY provider")
def stream_late_counts(spark, d):
    """Calls of each provider and how many came too late, last figures."""
    rows, drained = _straggling(spark, d, ["ts", "provider"])
    out = drained(T.late_counts_stream(rows, "provider"))
    return out.groupBy("provider").agg(F.max("rows").alias("rows"), F.max("late").alias("late"))


_on_time = f"(SELECT event_id, company_id, ts FROM {_thirds} WHERE NOT {_behind})"


@query("stream_cooldown_late", f"SELECT company_id, event_id, approved FROM ({_cooled(86_400).replace(LEDGER, _on_time)})")
def stream_cooldown_late(spark, d):
    """The rest of the log is judged as if the late calls had never come."""
    rows, drained = _straggling(spark, d, ["company_id", "event_id", "ts"])
    return drained(T.cooldown_stream(rows, "company_id", 86_400)).select("company_id", "event_id", "approved")


@query("stream_health_late", f"""SELECT time_bucket(INTERVAL 300 SECOND, ts) AS window_start, count(*) AS total_calls, round(avg((NOT success)::INT), 9) AS error_rate FROM {_thirds} WHERE NOT {_behind} GROUP BY 1
  HAVING window_start + INTERVAL 300 SECOND <= (SELECT max(ts) FROM {_thirds}) - INTERVAL 60 SECOND""")
def stream_health_late(spark, d):
    """Windows that are over, each written once (append mode): late calls change none of them."""
    rows, drained = _straggling(spark, d, ["ts", "success", "duration_ms", "cost_eur", "cache_hit", "company_id"])
    out = drained(T.ledger_health_stream(rows, "300 seconds", "300 seconds"))
    return out.select("window_start", "total_calls", F.round("error_rate", 9).alias("error_rate"))


@query("stream_breaker", _breaker)
def stream_breaker(spark, d):
    """Health windows of each run, arriving in order."""
    path = f"{shared_dir(spark)}/streams/{uuid.uuid4().hex}"
    health = materialize(_health_windows(spark, d).drop("exhausted"))
    health = health.withColumn("window_start", F.col("window_start").cast("timestamp"))
    middle = health.agg(F.percentile_approx(F.unix_seconds("window_start"), 0.5)).first()[0] or 0
    late = F.unix_seconds("window_start") > middle
    for part in (~late, late):
        health.where(part).coalesce(1).write.mode("append").parquet(f"{path}/in")
    rows = spark.readStream.schema(health.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    return T.drain(T.breaker_stream(rows), f"{path}/out", f"{path}/checkpoint")


@query("needs_review", f"SELECT row_id FROM {COMPANIES} WHERE balance / 10000 < 0.4 AND row_id % 5 <> 0 AND (row_id % 3 <> 0 OR row_id % 2 = 0)")
def needs_review(spark, d):
    last = F.when(F.col("row_id") % 3 == 0, F.when(F.col("row_id") % 2 == 0, F.lit("2024-01-01 00:00:00")).otherwise(F.lit("2024-01-01 12:00:00"))).cast("timestamp")
    rows = role(spark, d, "companies").withColumns({"best_confidence": F.col("balance") / 10000, "bleeding": F.col("row_id") % 5 == 0, "last_review": last, "now": F.lit("2024-01-02 00:00:00").cast("timestamp")})
    return W.needs_llm_review(rows).select("row_id")


@query("sql_functions", f"SELECT row_id, {sql_norm} AS company, {sql_host('website')} AS domain, coalesce({_luhn(_vat_key)}, false) AS vat_ok, round({_cover("company_name", sql_fold("email || ' ' || address"))}, 6) AS coverage FROM {COMPANIES}")
def sql_functions(spark, d):
    register(spark)
    return spark.sql("SELECT row_id, normalize_company(company_name) AS company, root_domain(website) AS domain, vat_checksum(regexp_replace(vat, '^IT', '')) AS vat_ok, round(name_coverage(company_name, email || ' ' || address), 6) AS coverage FROM {c}", c=role(spark, d, "companies"))


@query("sql_guesses", f"SELECT row_id, domain FROM ({ORACLES['guess_domains']})")
def sql_guesses(spark, d):
    """The guesses of guess_domains by the table function."""
    register(spark)
    c = role(spark, d, "companies").select("row_id", N.name_tokens(F.col("company_name")).alias("t"))
    return spark.sql("SELECT row_id, g.domain FROM {c}, LATERAL guessed_domains(t) g", c=c)


@query("sql_candidates", ORACLES["domain_candidates"])
def sql_candidates(spark, d):
    """The guesses of domain_candidates by the SQL table function of this name."""
    register(spark)
    return spark.sql("SELECT row_id, g.place, g.domain FROM {c}, LATERAL domain_candidates(company_name, city, province, category) g", c=role(spark, d, "companies"))


@query("invalid_rows", f"SELECT row_id, CASE WHEN row_id % 7 = 0 THEN 'invalid_row_' || row_id ELSE company_name END AS company_name, CASE WHEN row_id % 7 = 0 THEN 'MISSING_COMPANY_NAME' END AS ingest_error FROM {COMPANIES}")
def invalid_rows(spark, d):
    """Every seventh company without its name: null, empty or blank."""
    gone = F.when(F.col("row_id") % 7 == 0, F.when(F.col("row_id") % 2 == 0, F.lit("  ")).when(F.col("row_id") % 3 == 0, F.lit(""))).otherwise(F.col("company_name"))
    return IO.flag_invalid_rows(role(spark, d, "companies").select("row_id", gone.alias("company_name")))


@query("campaign_dir", f"SELECT row_id::VARCHAR AS row_id, company_name, CASE row_id % 3 WHEN 0 THEN city END AS city, CASE row_id % 3 WHEN 1 THEN phone END AS phone FROM {COMPANIES} WHERE row_id % 3 < 2")
def campaign_dir(spark, d):
    """Two folders of campaigns with other columns, read as one; the consolidated file beside them is left out."""
    path = f"{shared_dir(spark)}/csv/{uuid.uuid4().hex}"
    c = role(spark, d, "companies")
    for i, cols in enumerate((["row_id", "company_name", "city"], ["row_id", "phone", "company_name"])):
        c.where(F.col("row_id") % 3 == i).select(*cols).write.option("header", True).csv(f"{path}/{i}")
    IO.write_named_csv(c.where("row_id % 3 = 2").select("row_id", "company_name"), f"{path}/1/MASTER_CONSOLIDATED_1.csv")
    return IO.read_campaign_dir(spark, [f"{path}/0", f"{path}/1"]).select("row_id", "company_name", "city", "phone")


@query("results_csv", f"""SELECT row_id::VARCHAR AS row_id, '{{"city":"' || city || '","tags":["' || category || '","x, y"]}}' AS evidence, company_name FROM {COMPANIES}""")
def results_csv(spark, d):
    """Results with a nested column written as CSV and read again: JSON in a field."""
    path = f"{shared_dir(spark)}/csv/{uuid.uuid4().hex}"
    nested = F.struct("city", F.array("category", F.lit("x, y")).alias("tags"))
    IO.write_results_csv(role(spark, d, "companies").select("row_id", nested.alias("evidence"), "company_name"), path)
    return spark.read.options(**IO.CSV).csv(path)


@query("by_province", f"SELECT row_id::VARCHAR AS row_id, company_name, coalesce(province, 'unknown') AS folder, n.n FROM {COMPANIES}, (SELECT count(*) AS n FROM customer) n")
def by_province(spark, d):
    """A folder for each province, and all rows beside it."""
    path = f"{shared_dir(spark)}/csv/{uuid.uuid4().hex}"
    IO.write_by_province(role(spark, d, "companies"), path, ["row_id", "company_name", "province"])
    parts = spark.read.options(**IO.CSV).csv(f"{path}/by_province").select("row_id", "company_name", F.col("province_part").alias("folder"))
    return parts.crossJoin(spark.read.options(**IO.CSV).csv(f"{path}/all").agg(F.count("*").alias("n")))


_segment = "CASE row_id % 4 WHEN 0 THEN 'HOT' WHEN 1 THEN 'WARM' WHEN 2 THEN 'COLD' ELSE 'DEAD' END"


def _graded(spark, d):
    return role(spark, d, "companies").withColumns({"total": F.col("row_id") % 100, "category": F.expr(_segment)})


@query("exported_leads", f"SELECT company_id, company_name, row_id % 100 AS total FROM {COMPANIES} WHERE row_id % 100 >= 30 AND row_id % 4 < 2")
def exported_leads(spark, d):
    """Hot and warm leads from 30 on, three fields, by score, as JSON lines read again."""
    path = f"{shared_dir(spark)}/csv/{uuid.uuid4().hex}"
    IO.export_leads(_graded(spark, d), path, "json", min_score=30, categories=["HOT", "WARM"], fields=["company_id", "company_name", "total"])
    return spark.read.schema("company_id string, company_name string, total long").json(path)


@query("exported_segments", f"SELECT {_segment} AS segment, count(*) AS n, min(row_id)::BIGINT AS first_row FROM {COMPANIES} WHERE row_id % 4 <> 2 GROUP BY ALL")
def exported_segments(spark, d):
    """A folder for each segment; the one without rows does not come to be."""
    path = f"{shared_dir(spark)}/csv/{uuid.uuid4().hex}"
    IO.export_segmented(_graded(spark, d).where("category <> 'COLD'").select("row_id", "company_name", "category"), path)
    return spark.read.options(**IO.CSV).csv(path).groupBy("segment").agg(F.count("*").alias("n"), F.min(F.col("row_id").cast("long")).alias("first_row"))


@query("pending_limit", f"SELECT company_id FROM {COMPANIES} WHERE company_id NOT IN (SELECT user_id::VARCHAR FROM events) ORDER BY company_id LIMIT 50")
def pending_limit(spark, d):
    done = spark.read.parquet(f"{d}/events.parquet").select(F.col("user_id").cast("string").alias("company_id"))
    return J.pending(role(spark, d, "companies"), done, limit=50).select("company_id")


@query("input_quality", f"""SELECT row_id, CASE WHEN p AND a AND m THEN 1.0 ELSE greatest(0.1, round(0.5 + CASE WHEN m THEN 0.2 ELSE 0 END + CASE WHEN p THEN 0.15 ELSE 0 END + CASE WHEN a THEN 0.15 ELSE 0 END, 4)) END::DOUBLE AS quality
  FROM (SELECT row_id, row_id % 2 = 0 AS p, row_id % 3 > 0 AS a, row_id % 5 > 1 AS m FROM {COMPANIES})""")
def input_quality(spark, d):
    only = lambda cond, c: F.when(F.expr(cond), F.col(c)).otherwise(F.lit(" "))
    quality = N.input_quality(F.col("company_name"), F.col("city"), only("row_id % 2 = 0", "phone"), only("row_id % 3 > 0", "address"), only("row_id % 5 > 1", "website_domain"))
    return role(spark, d, "companies").withColumn("website_domain", F.lit("azienda.it")).select("row_id", quality.alias("quality"))


@query("title_parts", f"""SELECT row_id, CASE WHEN length(a) BETWEEN 2 AND 80 THEN a END AS first, CASE WHEN length(b) BETWEEN 2 AND 80 THEN b END AS second FROM (SELECT row_id, company_name AS a, CASE row_id % 3 WHEN 0 THEN city WHEN 1 THEN 'x' END AS b FROM {COMPANIES})""")
def title_parts(spark, d):
    """Result titles of a company, its place and the directory, parted in two ways."""
    mark, rest = F.when(F.col("row_id") % 2 == 0, F.lit(" | ")).otherwise(F.lit(" - ")), F.when(F.col("row_id") % 3 == 0, F.col("city")).when(F.col("row_id") % 3 == 1, F.lit("x"))
    first, second = P.title_parts(F.concat_ws("", "company_name", F.when(rest.isNotNull(), F.concat(mark, rest, mark, F.lit("elenco")))))
    return role(spark, d, "companies").select("row_id", first.alias("first"), second.alias("second"))


@query("embedded_site", f"""SELECT row_id, CASE WHEN row_id % 2 = 0 THEN 'www.azienda' || row_id || '.it' WHEN website IS NOT NULL AND NOT {listed(sql_host('website'), P.SOCIAL_SITES)} THEN website END AS site FROM {COMPANIES}""")
def embedded_site(spark, d):
    """Even companies are named in the title; of the others the first outbound link that is not the registry or social counts."""
    title = F.when(F.col("row_id") % 2 == 0, F.concat(F.lit("Scheda, sito: www.azienda"), "row_id", F.lit(".it")))
    html = F.concat(F.lit('<a href="https://www.registro.it/x">r</a><a href="'), F.coalesce("website", F.lit("/contatti")), F.lit('">s</a>'))
    return role(spark, d, "companies").select("row_id", P.embedded_site(title, html, ["registro.it"]).alias("site"))


@query("flatten_runs", f"SELECT company_name, city, CASE WHEN row_id % 2 = 0 THEN 'FOUND' ELSE 'NOT_FOUND' END AS status, website AS url, balance AS confidence, 'L' || row_id % 3 AS layer, row_id AS duration_ms, 'L0;L' || row_id % 3 AS layers FROM {COMPANIES}")
def flatten_runs(spark, d):
    layer = F.concat(F.lit("L"), (F.col("row_id") % 3).cast("string"))
    result = F.struct(F.when(F.col("row_id") % 2 == 0, "FOUND").otherwise("NOT_FOUND").alias("status"), F.col("website").alias("url"), F.col("balance").alias("confidence"), layer.alias("layer"))
    nested = role(spark, d, "companies").select(F.struct("company_name", "city").alias("company"), result.alias("result"), F.col("row_id").alias("duration_ms"), F.array(F.lit("L0"), layer).alias("layers"))
    return IO.flatten_run_results(nested)


@query("sanitize_master", f"SELECT row_id, address || ' ' || city AS address, coalesce(province, nullif(regexp_extract(city, '\\(([A-Z]{{2}})\\)', 1), '')) AS province, company_id FROM {COMPANIES}")
def sanitize_master(spark, d):
    """Addresses with the city on a line of its own; then rows without their repeats."""
    c = role(spark, d, "companies").select("row_id", "company_id", "company_name", "phone", "city", F.concat("address", F.lit("\r\n\t"), "city").alias("address"), "province", "category")
    return D.deterministic_company_id(IO.sanitize_master(c))[0].select("row_id", "address", "province", "company_id")


@query("csv_round_trip", f"SELECT company_name, city, phone, address, source_file FROM (SELECT *, CASE WHEN row_id % 2 = 0 THEN 'a' ELSE 'b' END AS source_file FROM {COMPANIES})")
def csv_round_trip(spark, d):
    """Companies written as two campaigns of different headers and delimiters, then read by the header rules."""
    path = f"{shared_dir(spark)}/csv/{uuid.uuid4().hex}"
    c = role(spark, d, "companies")
    first = c.where("row_id % 2 = 0").select(F.col("company_name").alias("Ragione Sociale"), F.col("city").alias("Citta"), F.col("phone").alias("Telefono"), F.col("address").alias("Indirizzo"))
    second = c.where("row_id % 2 = 1").select("company_name", "city", "phone", "address")
    first.write.option("header", True).option("sep", ";").csv(f"{path}/a")
    second.write.option("header", True).csv(f"{path}/b")
    files = IO.read_companies_csv(spark, [f"{path}/a/*.csv", f"{path}/b/*.csv"])
    rows = IO.map_headers(files.withColumn("source_file", F.when(F.col("Ragione Sociale").isNotNull(), "a").otherwise("b")))
    return rows.select("company_name", "city", "phone", "address", "source_file")


_tok3 = f"list_filter({sql_tokens('company_name')}, lambda t: length(t) >= 3)"
_share = "len(list_filter(t3, lambda t: contains(body, t))) / len(t3)"


@query("semantic_match", f"""SELECT row_id, len(t3) > 0 AND ({_share} >= 0.6 OR ({_share} >= 0.4 AND label = joined)) AS matches FROM (SELECT row_id, {_tok3} AS t3, array_to_string({sql_tokens("company_name")}, '') AS joined,
  coalesce(regexp_replace(split_part({sql_host("website")}, '.', 1), '[^a-z0-9]', '', 'g'), '') AS label, {sql_fold("CASE WHEN row_id % 2 = 0 THEN company_name ELSE email || ' ' || address END")} AS body FROM {COMPANIES})""")
def semantic_match(spark, d):
    body = F.when(F.col("row_id") % 2 == 0, F.col("company_name")).otherwise(F.concat_ws(" ", "email", "address"))
    return role(spark, d, "companies").select("row_id", M.semantic_name_match(F.col("company_name"), body, F.col("website")).alias("matches"))


@query("page_evidence")
def page_evidence(spark, d):
    """Each stored page as evidence for the company of its id."""
    pages = _pages(spark, d).select(F.col("page_id").alias("row_id"), "html")
    found = M.evidence(P.minify_html(F.col("html")), F.col("html"), F.col("company_name"), F.col("address"))
    rows = role(spark, d, "companies").select("row_id", "company_name", "address").join(pages, "row_id").select("row_id", found.alias("e"))
    return rows.select("row_id", F.size("e.phones_found").alias("n_phones"), F.size("e.vat_ids_found").alias("n_vats"), F.size("e.emails_found").alias("n_emails"), F.size("e.social_links").alias("n_social"), F.round("e.name_match_score", 6).alias("name_score"), F.round("e.address_match_score", 6).alias("address_score"))


@query("many_headers", f"SELECT row_id::VARCHAR AS row_id, company_name, trim(regexp_replace(city, '\\s+', ' ', 'g')) AS city, phone, trim(regexp_replace(address || ' ' || city, '\\s+', ' ', 'g')) AS address FROM {COMPANIES}")
def many_headers(spark, d):
    """Companies in 60 files, each with its own header and one of three delimiters, addresses over two lines; one scan."""
    path = f"{shared_dir(spark)}/csv/{uuid.uuid4().hex}"
    part = F.col("row_id") % 60
    sep = F.element_at(F.array(*map(F.lit, ";\t,")), (part % 3 + 1).cast("int"))
    line = lambda *cs: F.concat(*[x for c in cs for x in (sep, c)][1:]).alias("value")
    cell = lambda c: F.concat(F.lit('"'), F.replace(F.coalesce(c, F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))
    pick = lambda *names: F.element_at(F.array(*map(F.lit, names)), (F.floor(part / 3) % len(names) + 1).cast("int"))
    c = role(spark, d, "companies").withColumn("address", F.concat("address", F.lit("\n"), "city"))
    rows = c.select(part.alias("part"), F.col("row_id").alias("at"), line(F.col("row_id").cast("string"), *[cell(F.col(x)) for x in ("company_name", "city", "phone", "address")], F.lit("n")))
    heads = c.select(part.alias("part")).distinct().withColumn("row_id", F.col("part"))
    heads = heads.select("part", F.lit(-1).cast("long").alias("at"), line(F.lit("row_id"), pick("company_name", "Ragione_Sociale", "NAME"), pick("city", "Comune"), pick("Phone", "telefono"), pick("Indirizzo", "address"), F.concat(F.lit("note "), F.col("part").cast("string"))))
    rows.unionByName(heads).repartition("part").sortWithinPartitions("part", "at").select("part", "value").write.partitionBy("part").text(path)
    fields = IO.read_csv_fields(spark, [f"{path}/part=*"])
    return IO.unify_fields(fields, {"row_id": ["row_id"]} | IO.ALIASES).select("row_id", "company_name", "city", "phone", "address")
