"""The roles that the given tables play for the registered queries, as SQL that Spark and other engines read alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarrystone.session import table

TABLES = "region nation customer supplier part orders lineitem events documents pages".split()

_n = "cast({} as string)".format

#: Company records: customers with names, places and contacts made from their keys by fixed arithmetic.
COMPANIES = f"""
SELECT c_custkey AS row_id, {_n("c_custkey")} AS company_id,
  CASE c_custkey % 6 WHEN 0 THEN 'Rossi Impianti' WHEN 1 THEN 'Ditta Bianchi' WHEN 2 THEN 'Officina Verdì' WHEN 3 THEN 'Il Forno Neri' WHEN 4 THEN 'Studio Gallo' ELSE 'Fratelli Conti' END
    || ' ' || {_n("c_custkey - c_custkey % 12 + c_custkey % 6")}
    || CASE c_custkey % 5 WHEN 0 THEN ' S.r.l.' WHEN 1 THEN ' SPA' WHEN 2 THEN ' snc' WHEN 3 THEN ' S.A.S.' ELSE '' END AS company_name,
  CASE c_nationkey % 6 WHEN 0 THEN 'Milano' WHEN 1 THEN 'Roma' WHEN 2 THEN 'Torino' WHEN 3 THEN 'Reggio Emilia' WHEN 4 THEN 'Brescia (BS)' ELSE n_name END AS city,
  CASE c_nationkey % 4 WHEN 0 THEN 'MI' WHEN 1 THEN 'rm' WHEN 2 THEN 'Torino' END AS province,
  CASE c_custkey % 4 WHEN 0 THEN '02 ' || lpad({_n("(c_custkey - c_custkey % 20) * 7919 % 10000000")}, 7, '0') WHEN 1 THEN '+39 3' || lpad({_n("c_custkey * 104729 % 100000000")}, 8, '0')
    WHEN 2 THEN '0039 06/' || lpad({_n("c_custkey * 7919 % 1000000")}, 6, '0') ELSE '02/12345 ; 333 ' || lpad({_n("c_custkey * 7907 % 1000000")}, 6, '0') END AS phone,
  CASE c_custkey % 3 WHEN 0 THEN 'IT' || lpad({_n("(c_custkey - c_custkey % 3) * 1357 + 7431100")}, 11, '0') WHEN 1 THEN lpad({_n("(c_custkey - c_custkey % 3) * 1357 + 7431100")}, 11, '0') END AS vat,
  CASE WHEN c_custkey % 4 = 0 THEN 'https://www.azienda' || {_n("c_custkey - c_custkey % 8")} || '.it/' WHEN c_custkey % 4 = 1 THEN 'http://Rossi' || {_n("c_custkey")} || '.com/contatti?x=1'
    WHEN c_custkey % 4 = 2 THEN 'https://it-it.facebook.com/p' END AS website,
  CASE c_custkey % 3 WHEN 0 THEN 'info@azienda' || {_n("c_custkey")} || '.it' WHEN 1 THEN 'Mario.Rossi@gmail.com' ELSE 'anna@studio' || {_n("c_custkey")} || '.com' END AS email,
  'Via Roma, ' || {_n("c_custkey % 90 + 1")} AS address, c_mktsegment AS category,
  CASE c_custkey % 3 WHEN 0 THEN 'REGISTRY' WHEN 1 THEN 'WEBSITE' ELSE 'MAPS' END AS source, c_acctbal AS balance
FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey"""

#: Candidate sites: the lines of an order, with the supplier as site and a score from the quantity.
CANDIDATES = f"""
SELECT l_orderkey AS company_id, l_linenumber AS pos, 'site' || {_n("l_suppkey")} || '.it' AS root_domain,
  CASE WHEN l_suppkey % 17 = 0 THEN 'https://facebook.com/' || {_n("l_suppkey")} ELSE 'https://www.site' || {_n("l_suppkey")} || '.it/' || l_returnflag END AS source_url,
  cast(l_linenumber % 4 AS int) AS rank, l_shipmode_ AS provider, round(l_quantity * 2.0, 2) AS final_score, round(l_quantity / 50.0, 4) AS confidence,
  CASE WHEN l_orderkey % 11 = 0 THEN 'Abc' ELSE 'Company ' || {_n("l_orderkey")} END AS company_name, cast(l_orderkey % 5 AS bigint) AS phone_freq,
  cast(l_partkey % 2 AS int) AS n_vats, cast(l_partkey % 3 AS int) AS n_phones, cast(l_partkey % 4 + 1 AS int) AS layer
FROM (SELECT *, l_linestatus || l_returnflag AS l_shipmode_, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_extendedprice) AS dup_ FROM {{lineitem}}) WHERE dup_ = 1"""

#: A call log: events as calls of providers.
LEDGER = f"""
SELECT event_id, ts, event_type AS provider, {_n("user_id")} AS company_id, {_n("user_id % 7")} AS run_id, cast(round(value * 100) AS bigint) AS duration_ms, round(value / 10000.0, 6) AS cost_eur,
  event_type <> 'error' AND event_id % 9 <> 0 AS success, event_id % 4 = 0 AS cache_hit, cast(event_id % 100 AS bigint) * 10 AS prompt_tokens, cast(event_id % 37 AS bigint) AS completion_tokens,
  CASE event_id % 3 WHEN 0 THEN 'mini' WHEN 1 THEN 'large' ELSE 'unknown-model' END AS model,
  cast(CASE event_id % 8 WHEN 0 THEN 429 WHEN 1 THEN 403 WHEN 2 THEN 0 ELSE 200 END AS int) AS http_status,
  CASE event_id % 6 WHEN 0 THEN 'Please solve the CAPTCHA' WHEN 1 THEN 'Access denied' WHEN 2 THEN '' WHEN 3 THEN props ELSE repeat('lorem ipsum ', 20) END AS body,
  CASE event_id % 7 WHEN 0 THEN 'Navigation timeout of 30000 ms' WHEN 1 THEN 'ECONNREFUSED 1.2.3.4' WHEN 2 THEN 'Unexpected token < in JSON' WHEN 3 THEN 'zod validation' WHEN 4 THEN 'Puppeteer: target closed' WHEN 5 THEN 'HTTP 401' ELSE 'other' END AS message,
  'https://www.host' || {_n("user_id % 40")} || '.it/x' AS url
FROM {{events}}"""

#: Leads: companies with a certified mail, figures and checks.
LEADS = f"""
SELECT *, CASE WHEN row_id % 7 = 0 THEN 'a@pec.it' END AS pec, CASE WHEN row_id % 4 = 0 THEN '1 mln' END AS revenue, CASE WHEN row_id % 5 < 2 THEN '10' END AS employees,
  CASE WHEN row_id % 9 = 0 THEN 'Anna Neri' END AS ceo_name, row_id % 6 <> 0 AS ssl_valid, CASE WHEN row_id % 2 = 0 THEN row_id % 10 <> 0 END AS dns_valid, true AS keyword_match
FROM ({COMPANIES})"""

#: Company sites: each document's whole text, and an imprint whose kind and figures follow from the text's length.
REPORTS = f"""
SELECT doc_id, text || CASE n % 6
    WHEN 0 THEN ' Fatturato: ' || {_n("n")} || '.500 mln nel 2021. Dipendenti: ' || {_n("n % 90 + 1")} || ' - P.IVA 0' || lpad({_n("n * 7919 % 10000000000")}, 10, '0')
    WHEN 1 THEN ' Ricavi: ' || {_n("n % 700")} || ' mila; organico: ' || {_n("n % 50")} || ' (bilancio 2019)'
    WHEN 2 THEN ' Trova aziende: elenco imprese in provincia. Tel. +39 02 ' || lpad({_n("n * 104729 % 10000000")}, 7, '0')
    WHEN 3 THEN ' Codice fiscale e fatturato su richiesta, tel. 333 ' || lpad({_n("n * 7907 % 10000000")}, 7, '0') || ', volume d''affari ' || {_n("n % 31")} || ',5 milioni'
    WHEN 4 THEN ' Fatturato da 1.' || lpad({_n("n % 1000")}, 3, '0') || '.000 euro' ELSE '' END AS text
FROM (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n FROM {{documents}})"""

#: Search responses: title and url of each page as JSON of three forms, or its whole html, by the length of the html.
RESPONSES = f"""
SELECT page_id, url, title, n % 4 AS form, CASE n % 4 WHEN 0 THEN '{{{{"data": [' || items || ']}}}}' WHEN 1 THEN '{{{{"results": [' || items || ']}}}}' WHEN 2 THEN '[' || items || ']' ELSE html END AS body FROM (
  SELECT *, '{{{{"title": "' || title || '", "url": "' || url || '", "description": "d"}}}}, {{{{"url": "' || url || '/more", "content": "' || title || '"}}}}' AS items FROM (
    SELECT page_id, coalesce(html, '') AS html, length(coalesce(html, '')) AS n, translate(coalesce(url, ''), '"' || chr(92), '__') AS url,
      translate(regexp_extract(coalesce(html, ''), '<title>([^<]*)</title>', 1), '"' || chr(92) || chr(9) || chr(10) || chr(13), '_____') AS title FROM {{pages}}))"""

#: Stored profiles and result pages: each page's whole html, then a company's record and three results in the blocks of one of three
#: engines, made of the length of the html.
PROFILES = f"""
SELECT page_id, url, n, html || '<h2>Azienda ' || {_n("n")} || '</h2><div><p>Via Roma, ' || {_n("n % 90 + 1")} || ' - 20' || lpad({_n("n % 1000")}, 3, '0') || ' Milano (MI)</p><p>Tel 02 ' || lpad({_n("n")}, 7, '0') || '</p><a href="https://azienda' || {_n("n")} || '.it/">sito</a>'
    || '<table><thead><tr><th>Dipendenti</th><th>Utile</th></tr></thead><tbody><tr><td>' || {_n("n % 50")} || '</td><td>' || {_n("n")} || '</td></tr></tbody></table>'
    || '<dl><dt>Fatturato<dd>' || {_n("n")} || ' mln</dl>' || CASE n % 3 WHEN 0 THEN '<div>Forma giuridica: S.r.l.</div>' WHEN 1 THEN '<table><tr><td><b>Forma giuridica</b></td><td>Spa</td></tr></table>' ELSE '' END || '</div>' AS profile,
  html || CASE n % 3
    WHEN 0 THEN '<div class="yuRUbf"><a href="/url?q=https://azienda' || {_n("n")} || '.it/&sa=U"><h3>Azienda</h3> altro</a></div><div class="kCrYT"><a href="https://www.google.com/search?q=x">di piu</a></div>'
    WHEN 1 THEN '<ol><li class="b_algo"><h2><a href="https://azienda' || {_n("n")} || '.it/">Azienda</a></h2><li class="b_algo"><h2><a href="https://notbing.com/' || {_n("n")} || '">Altra</a></h2></ol>'
    ELSE '<a class="result__a" href="//duckduckgo.com/l/?uddg=https%3A%2F%2Fazienda' || {_n("n")} || '.it%2F&rut=1">Azienda</a><a class="result__a" href="https://azienda' || {_n("n")} || '.it/">di nuovo</a>' END AS results
FROM (SELECT page_id, url, coalesce(html, '') AS html, length(coalesce(html, '')) AS n FROM {{pages}})"""

ROLES = {"profiles": PROFILES, "reports": REPORTS, "responses": RESPONSES, "companies": COMPANIES, "candidates": CANDIDATES, "ledger": LEDGER, "leads": LEADS}


def role(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Spark's length is an int, which the products made of it overflow from some 20 000 characters on; elsewhere it is a bigint.
    text = ROLES[name].replace("length(coalesce(text, '')) AS n", "cast(length(coalesce(text, '')) AS bigint) AS n")
    used = {t: table(spark, sf_dir, t) for t in TABLES if f"{{{t}}}" in text}
    return spark.sql(text, **used)


def role_sql(name: str) -> str:
    """The role as a subquery over tables of their own names."""
    return "(" + ROLES[name].format(**{t: t for t in TABLES}) + ")"
