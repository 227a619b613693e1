"""Functions for SQL text, as temporary SQL functions: still built-in expressions once planned."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from quarrystone.functions.names import ACCENTED, ARTICLES, FILLER_WORDS, LEGAL_FORM, PLAIN, TRADE_WORDS
from quarrystone.operators.frontier import ENDINGS, SECTORS, SOUNDS


def _quoted(pattern: str) -> str:
    return pattern.replace("\\", "\\\\").replace("'", "\\'")


def register(spark: SparkSession) -> None:
    """Make vat_checksum, root_domain, normalize_company, name_coverage and the table functions domain_candidates and
    guessed_domains callable in the session's SQL; all but the last are plain expressions."""
    digits = "regexp_replace(coalesce(v, ''), '[^0-9]', '')"
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION vat_checksum(v STRING) RETURNS BOOLEAN RETURN length({digits}) = 11 AND luhn_check(CASE WHEN length({digits}) = 11 THEN {digits} ELSE '1' END)")
    host = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*://)?(?:[^/?#@]*@)?([^/?#:@]+)"
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION root_domain(u STRING) RETURNS STRING RETURN nullif(regexp_replace(lower(regexp_extract(trim(u), '{_quoted(host)}', 1)), '^www\\\\.', ''), '')")
    text = "trim(lower(coalesce(n, '')))"
    for pattern, by in ((rf"(^|\s)({LEGAL_FORM})(?=\s|$)", " "), (r"[.,/\-&()]", " "), (rf"\b({'|'.join(TRADE_WORDS)})\b", ""), (rf"\b({'|'.join(ARTICLES)})\b", ""), (r"\s+", " ")):
        text = f"regexp_replace({text}, '{_quoted(pattern)}', '{by}')"
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION normalize_company(n STRING) RETURNS STRING RETURN trim({text})")
    folded = lambda x: f"trim(regexp_replace(translate(lower(coalesce({x}, '')), '{ACCENTED}', '{PLAIN}'), '[^a-z0-9]+', ' '))"
    filler = ", ".join(f"'{w}'" for w in FILLER_WORDS)
    tokens = f"filter(split({folded('name')}, ' '), t -> length(t) >= 2 AND t NOT IN ({filler}))"
    hit = f"contains(concat(' ', {folded('text')}, ' '), concat(' ', t, ' ')) OR (length(t) >= 4 AND contains({folded('text')}, t))"
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION name_coverage(name STRING, text STRING) RETURNS DOUBLE RETURN CASE WHEN size({tokens}) = 0 THEN 0D ELSE size(filter({tokens}, t -> {hit})) / size({tokens}) END")
    spark.udtf.register("guessed_domains", GuessedDomains)
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION domain_candidates(name STRING, city STRING, province STRING, category STRING) RETURNS TABLE(place INT, domain STRING) RETURN SELECT CAST(p + 1 AS INT), x.h FROM posexplode({_candidates(tokens, folded('city'))}) AS g(p, x)")


def _candidates(tokens: str, place: str, most: int = 80) -> str:
    """SQL: the ranked hosts of ``frontier.domain_candidates`` as an array of structs, from a name's tokens."""
    let = lambda value, var, body: f"element_at(transform(array({value}), {var} -> {body}), 1)"
    listed = lambda xs: "array(" + ", ".join(f"'{x}'" for x in xs) + ")"
    none = "CAST(array() AS ARRAY<STRING>)"
    kind = "lower(coalesce(category, ''))"
    sector = "CASE " + " ".join(f"WHEN {kind} <> '' AND (contains({kind}, '{k}') OR contains('{k}', {kind})) THEN {listed(v)}" for k, v in SECTORS) + f" ELSE {none} END"
    joined, dashed, at, p = "array_join(t, '')", "array_join(t, '-')", f"replace({place}, ' ', '')", "lower(coalesce(province, ''))"
    initials = "array_join(transform(t, w -> substring(w, 1, 1)), '')"
    stems = [
        f"array({joined}, {dashed}, get(t, 0), array_join(slice(t, 1, 2), ''), array_join(slice(t, 1, 2), '-'))",
        "array(" + ", ".join(f"replace({joined}, '{a}', '{b}')" for a, b in SOUNDS) + ")",
        f"CASE WHEN size(t) >= 2 THEN array({initials}, {initials} || element_at(t, -1), {initials} || '-' || element_at(t, -1)) ELSE {none} END",
        f"transform({sector}, s -> {joined} || s)",
        f"transform({sector}, s -> {joined} || '-' || s)",
        f"array({joined} || {at}, {joined} || '-' || {at}, {dashed} || '-' || {at}, {joined} || {p}, {joined} || '-' || {p})",
    ]
    hosts = ", ".join(f"'{w}' || s || '.{e}'" for e in ENDINGS for w in ("", "www."))
    kept = f"filter(array_distinct(concat({', '.join(stems)})), s -> s RLIKE '^[a-z0-9][a-z0-9-]*[a-z0-9]$')"
    ranked = f"transform(filter(flatten(transform({kept}, s -> array({hosts}))), h -> length(h) <= 70), h -> struct(CASE WHEN endswith(h, '.it') THEN 0 ELSE 1 END AS i, length(h) AS n, length(h) - length(replace(h, '-', '')) AS d, h AS h))"
    return let(tokens, "t", f"slice(array_sort(CASE WHEN size(t) > 0 THEN {ranked} END), 1, {most})")


@F.udtf(returnType=StructType([StructField("place", IntegerType()), StructField("domain", StringType())]))
class GuessedDomains:
    """Rows (place, domain) for the words of a name: joined and with dashes, with the usual endings."""

    def eval(self, tokens: list[str]) -> Iterator[tuple[int, str]]:
        names = dict.fromkeys(["".join(tokens or []), "-".join(tokens or [])])
        for i, domain in enumerate(f"{n}{e}" for n in names if n for e in (".it", ".com", ".eu", ".net")):
            yield i + 1, domain
