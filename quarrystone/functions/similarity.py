"""Similarities and match signals between a company and a text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarrystone.functions.contacts import extract_emails, extract_phones, extract_vats, host, phones_match
from quarrystone.functions.names import ADDRESS_NOISE, fold_text, folded_tokens, name_tokens

# Words of a contact page.
CONTACT_WORDS = ["contatti", "contattaci", "contattami", "chi siamo", "dove siamo", "about us", "privacy", "cookie policy", "note legali", "impressum", "mappa del sito", "sitemap"]


def long_tokens(c: Column) -> Column:
    """Distinct words over two characters, lower case, without punctuation."""
    bare = F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[^a-z0-9_\s]", "")
    return F.array_distinct(F.filter(F.split(bare, r"\s+"), lambda t: F.length(t) > 2))


def jaccard_tokens(a: Column, b: Column) -> Column:
    """Jaccard index of the word sets; 1 if both are empty."""
    x, y = long_tokens(a), long_tokens(b)
    return F.when((F.size(x) == 0) & (F.size(y) == 0), F.lit(1.0)).otherwise(F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y)))


def token_overlap(tokens: Column, text: Column) -> Column:
    """Share of the tokens that are words of the text."""
    words = long_tokens(text)
    return F.when(F.size(tokens) == 0, F.lit(0.0)).otherwise(F.size(F.filter(tokens, lambda t: F.array_contains(words, t))) / F.size(tokens))


def token_hits(tokens: Column, text: Column) -> Column:
    """Share of the tokens that occur anywhere in the text."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return F.when(F.size(tokens) == 0, F.lit(0.0)).otherwise(F.size(F.filter(tokens, lambda t: F.contains(low, t))) / F.size(tokens))


def levenshtein_similarity(a: Column, b: Column) -> Column:
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, F.lit(1.0)).otherwise(1 - F.levenshtein(a, b) / longest)


def _word_in(t: Column, text: Column) -> Column:
    """A token stands as a word of a folded text of more than that word."""
    return F.contains(F.concat(F.lit(" "), text, F.lit(" ")), F.concat(F.lit(" "), t, F.lit(" "))) & (text != t)


def tokens_coverage(tokens: Column, folded: Column) -> Column:
    """Share of tokens in a folded text: as words, or from four characters on anywhere."""
    hit = lambda t: _word_in(t, folded) | (folded == t) | ((F.length(t) >= 4) & F.contains(folded, t))
    return F.when(F.size(tokens) == 0, F.lit(0.0)).otherwise(F.size(F.filter(tokens, hit)) / F.size(tokens))


def name_coverage(name: Column, folded: Column) -> Column:
    """Share of the name's tokens in a folded text."""
    return tokens_coverage(name_tokens(name), folded)


def city_match(city: Column, folded: Column) -> Column:
    tokens = F.filter(folded_tokens(city), lambda t: F.length(t) >= 3)
    return (F.size(tokens) > 0) & F.forall(tokens, lambda t: _word_in(t, folded))


def address_coverage(address: Column, folded: Column) -> Column:
    """Share of the first six address tokens that are words of the folded text."""
    number = lambda t: t.rlike("^[0-9]+$")
    keep = lambda t: (number(t) & (F.length(t) >= 2)) | (~number(t) & (F.length(t) >= 3) & ~t.isin(ADDRESS_NOISE))
    tokens = F.slice(F.filter(folded_tokens(address), keep), 1, 6)
    return F.when(F.size(tokens) == 0, F.lit(0.0)).otherwise(F.size(F.filter(tokens, lambda t: _word_in(t, folded))) / F.size(tokens))


def domain_coverage(name: Column, url: Column) -> Column:
    """1 if the joined name stands in the host, else the share of its tokens that do; 0 without a host."""
    compact = F.coalesce(F.regexp_replace(host(url), "[^a-z0-9]", ""), F.lit(""))
    tokens = name_tokens(name)
    joined = F.array_join(tokens, "")
    share = F.size(F.filter(tokens, lambda t: F.contains(compact, t))) / F.size(tokens)
    return F.when(F.size(tokens) == 0, F.lit(0.0)).when((F.length(joined) >= 3) & F.contains(compact, joined), F.lit(1.0)).otherwise(share)


def any_of(text: Column, phrases: list[str]) -> Column:
    found = F.lit(False)
    for p in phrases:
        found = found | F.contains(text, F.lit(p))
    return found


def contact_keywords(text: Column, title: Column) -> Column:
    return any_of(F.concat_ws(" ", fold_text(title), fold_text(text)), CONTACT_WORDS)


def og_image_match(html: Column, name: Column) -> Column:
    image = F.lower(F.regexp_extract(F.coalesce(html, F.lit("")), "(?i)<meta\\s+property=[\"']og:image[\"']\\s+content=[\"']([^\"']+)[\"']", 1))
    return (image != "") & F.contains(image, F.regexp_replace(F.lower(F.coalesce(name, F.lit(""))), "[^a-z0-9]", ""))


def match_signals(name: Column, city: Column, address: Column, phone: Column, vat: Column, url: Column, text: Column, title: Column) -> Column:
    """Struct of all signals between a company and a page."""
    folded, folded_title = fold_text(text), fold_text(title)
    digits = F.regexp_replace(F.coalesce(vat, F.lit("")), "[^0-9]", "")
    return F.struct(
        ((digits != "") & F.array_contains(extract_vats(text), digits)).alias("vat"),
        F.exists(extract_phones(text), lambda p: (F.length(F.coalesce(phone, F.lit(""))) > 0) & phones_match(phone, p)).alias("phone"),
        name_coverage(name, folded).alias("name"),
        city_match(city, folded).alias("city"),
        address_coverage(address, folded).alias("address"),
        domain_coverage(name, url).alias("domain"),
        contact_keywords(text, title).alias("contact"),
        og_image_match(text, name).alias("og"),
        name_coverage(name, folded_title).alias("title"),
        F.length(folded).alias("length"),
    )


def match_confidence(s: Column) -> Column:
    """Confidence from ``match_signals``: 1 for the VAT number, else a sum of steps, caps and bonuses in a fixed order."""
    step = lambda c, *levels: F.coalesce(*[F.when(c >= at, F.lit(v)) for at, v in levels], F.lit(0.0))
    flag = lambda c, v: F.when(c, F.lit(v)).otherwise(F.lit(0.0))
    x = 0.05 + flag(s["phone"], 0.65)
    x = x + step(s["name"], (0.85, 0.26), (0.65, 0.2), (0.4, 0.12)) + flag(s["city"], 0.08)
    x = x + step(s["address"], (0.8, 0.18), (0.65, 0.14), (0.45, 0.08)) + step(s["domain"], (0.8, 0.2), (0.5, 0.1), (0.3, 0.05))
    x = x + flag(s["contact"], 0.08) + flag(s["og"], 0.05)
    x = x - flag((s["length"] < 160) & (s["name"] < 0.6) & (s["domain"] < 0.6) & (s["title"] < 0.8), 0.1)
    x = F.when(~s["phone"] & (s["name"] < 0.4) & (s["domain"] < 0.5), F.least(x, F.lit(0.35))).otherwise(x)
    x = x + flag((s["domain"] >= 0.8) & (s["name"] >= 0.4), 0.06)
    agreeing = sum(c.cast("int") for c in (s["address"] >= 0.6, s["domain"] >= 0.7, s["title"] >= 0.6, s["city"]))
    x = x + flag(agreeing >= 3, 0.1)
    x = F.when(s["phone"] & (s["name"] < 0.25) & (s["domain"] < 0.25), F.least(x, F.lit(0.68))).otherwise(x)
    return F.when(s["vat"], F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(0.99), x)))


def semantic_name_match(name: Column, text: Column, url: Column) -> Column:
    """Six of ten name tokens of three characters and more occur in the text, or four and the host's first label is the name's slug."""
    tokens = F.filter(name_tokens(name), lambda t: F.length(t) >= 3)
    share = token_hits(tokens, fold_text(text))
    label = F.regexp_replace(F.coalesce(F.split(host(url), r"\.")[0], F.lit("")), "[^a-z0-9]", "")
    return (F.size(tokens) > 0) & ((share >= 0.6) | ((share >= 0.4) & (label == F.array_join(name_tokens(name), ""))))


def evidence(text: Column, html: Column, name: Column, address: Column) -> Column:
    """Struct of what a page shows of a company: phones, VAT numbers, addresses, social links, and match scores."""
    links = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit("(?i)href=[\"'](https?://[^\"']*(?:facebook|instagram|linkedin|twitter)\\.com[^\"']*)[\"']"), F.lit(1))
    folded = fold_text(text)
    return F.struct(
        extract_phones(text).alias("phones_found"), extract_vats(text).alias("vat_ids_found"), extract_emails(text).alias("emails_found"), F.array_distinct(links).alias("social_links"),
        address_coverage(address, folded).alias("address_match_score"), name_coverage(name, folded).alias("name_match_score"),
    )
