"""Rule scores for candidate sites and leads."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrystone.functions.contacts import host, is_directory_or_social
from quarrystone.functions.similarity import jaccard_tokens


@dataclass(frozen=True)
class Weights:
    """Weights and thresholds of the site score."""

    phone: float = 45
    phone_common: float = 25
    address: float = 25
    name: float = 20
    vat_match: float = 100
    vat_any: float = 20
    email: float = 10
    structured: float = 12
    corporate: float = 8
    contact: float = 5
    https: float = 2
    bad_site: float = 100
    no_dns: float = 100
    no_http: float = 35
    phone_limit: int = 3


def _flag(cond: Column, value: float) -> Column:
    return F.when(cond, F.lit(float(value))).otherwise(F.lit(0.0))


def _some(c: Column) -> Column:
    return F.coalesce(F.size(c), F.lit(0)) > 0


def site_score(evidence: Column, company: Column, phones: Column, vat: Column, phone_freq: Column, w: Weights = Weights(), allow_social: bool = False) -> Column:  # noqa: B008
    """Struct of strong, corroborating and penalty sums, the final score (0 to 100), and the rules that applied."""
    e = evidence
    common = phone_freq >= w.phone_limit
    phone_hit = F.coalesce(F.arrays_overlap(phones, e["phones_found"]), F.lit(False))
    s1 = _flag(phone_hit & ~common, w.phone) + _flag(phone_hit & common, w.phone_common)
    address = F.coalesce(e["address_match_score"], F.lit(0.0))
    s2 = F.when(address > 0.5, w.address * address).when(address > 0.3, F.lit(w.address * 0.3)).otherwise(F.lit(0.0))
    name = F.greatest(jaccard_tokens(company, e["meta_title"]), F.coalesce(e["name_match_score"], F.lit(0.0)))
    s3 = F.when(name > 0.8, F.lit(w.name * 1.0)).when(name > 0.5, F.lit(w.name * 0.7)).when(name > 0.3, F.lit(w.name * 0.4)).otherwise(F.lit(0.0))
    vat_hit = F.coalesce(F.array_contains(e["vat_ids_found"], vat), F.lit(False))
    s4 = F.when(vat_hit, F.lit(float(w.vat_match))).when(_some(e["vat_ids_found"]), F.lit(float(w.vat_any))).otherwise(F.lit(0.0))
    corporate = e["has_contact_page"].cast("int") + e["has_privacy_policy"].cast("int") + _some(e["vat_ids_found"]).cast("int")
    cs = [("C1", _flag(_some(e["emails_found"]), w.email)), ("C2", _flag(_some(e["structured_data"]), w.structured)), ("C3", _flag(corporate >= 2, w.corporate)), ("C4", _flag(e["has_contact_page"], w.contact)), ("C5", _flag(e["is_https"], w.https))]
    bad = ["DIRECTORY", "MARKETPLACE", "PARKED"] + ([] if allow_social else ["SOCIAL"])
    ps = [("P1", _flag(e["site_type"].isin(bad), w.bad_site)), ("P2", _flag(~e["dns_ok"], w.no_dns)), ("P3", _flag(~e["http_ok"], w.no_http))]
    strong, corroborating, penalty = s1 + s2 + s3 + s4, sum((c for _, c in cs), F.lit(0.0)), sum((p for _, p in ps), F.lit(0.0))
    details = F.array_compact(F.array(*[F.when(v > 0, F.lit(n)) for n, v in [("S1", s1), ("S2", s2), ("S3", s3), ("S4", s4), *cs, *ps]]))
    final = F.greatest(F.lit(0.0), F.least(F.lit(100.0), strong + corroborating - penalty))
    return F.struct(strong.alias("strong"), corroborating.alias("corroborating"), penalty.alias("penalties"), final.alias("final_score"), details.alias("details"))


def apply_page_boosts(confidence: Column, schema_vat: Column, schema_phone: Column, schema_url: Column, foreign: Column, title_coverage: Column) -> tuple[Column, Column]:
    """(confidence, level) after structured data, foreign language and title."""
    x = F.when(schema_vat, F.greatest(confidence, F.lit(0.99))).otherwise(confidence)
    x = F.least(F.lit(0.99), x + _flag(schema_phone, 0.1) + _flag(schema_url, 0.05))
    x = F.when(foreign & (x < 0.9), x - 0.03).otherwise(x)
    x = F.when((title_coverage >= 0.6) & (x < 0.85), x + 0.1).otherwise(x)
    return x, F.when(x >= 0.85, "RULE_STRONG").otherwise("RULE_WEAK")


def _has(c: Column) -> Column:
    return F.length(F.coalesce(c, F.lit(""))) > 0


def lead_score_v1(phone: Column, website: Column, vat: Column, address: Column, confidence: Column) -> Column:
    points = [(_has(phone), 30), (_has(website), 30), (_has(vat), 20), (_has(address), 10), (F.coalesce(confidence > 0.8, F.lit(False)), 10)]
    return sum((F.when(c, F.lit(p)).otherwise(F.lit(0)) for c, p in points), F.lit(0))


def lead_score_v2(df: DataFrame) -> Column:
    """Struct of contact (to 40), data (to 35), website (to 25), total and category; null checks count as passed."""
    point = lambda cond, p: F.when(cond, F.lit(p)).otherwise(F.lit(0))
    col = lambda n, kind="string": F.col(n) if n in df.columns else F.lit(None).cast(kind)
    good = lambda n: F.coalesce(col(n, "boolean"), F.lit(True))
    generic = F.coalesce(col("email").rlike("(?i)^(info|contact|admin|support|hello|sales)@"), F.lit(False))
    mobile = F.coalesce(col("phone").rlike(r"^\+?39\s*3"), F.lit(False))
    contact = F.least(F.lit(40), point(_has(col("email")) & ~generic, 15) + point(_has(col("email")) & generic, 5) + point(mobile, 15) + point(_has(col("phone")) & ~mobile, 5) + point(_has(col("ceo_name")), 10))
    data = F.least(F.lit(35), point(F.coalesce(col("vat").rlike(r"^[0-9]{11}$"), F.lit(False)), 15) + point(_has(col("pec")), 10) + point(_has(col("revenue")), 5) + point(_has(col("employees")), 5))
    site = _has(col("website"))
    website = F.least(F.lit(25), point(site, 10) + point(site & good("ssl_valid"), 5) + point(site & good("dns_valid"), 5) + point(site & good("keyword_match"), 5))
    total = contact + data + website
    category = F.when(total >= 70, "HOT").when(total >= 45, "WARM").when(total >= 20, "COLD").otherwise("DEAD")
    return F.struct(contact.alias("contact"), data.alias("data"), website.alias("website"), total.alias("total"), category.alias("category"))


def url_heuristic_score(name_slug: Column, url: Column) -> Column:
    """Host holds the name 5, ends in .it 2, contact path 1, directory -10."""
    h = F.coalesce(host(url), F.lit(""))
    point = lambda cond, p: F.when(cond, F.lit(p)).otherwise(F.lit(0))
    named = (F.length(name_slug) > 2) & F.contains(F.regexp_replace(h, "[^a-z0-9]", ""), name_slug)
    return point(named, 5) + point(h.endswith(".it"), 2) + point(is_directory_or_social(url), -10) + point(F.lower(url).rlike("/(contatti|contact|chi-siamo|about)"), 1)


def candidate_priority(confidence: Column, domain_coverage: Column) -> Column:
    return confidence + 0.25 * domain_coverage


def search_confidence(query_precision: Column) -> Column:
    return 0.6 + 0.2 * query_precision
