"""Joins: anti-joins of runs, registry and phone lookups, suffix joins without theta conditions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrystone.functions.contacts import canonical_url, extract_vats, host_suffixes, phones_match
from quarrystone.functions.names import clean_company_name, fold_text, name_tokens, name_variants
from quarrystone.functions.similarity import tokens_coverage
from quarrystone.session import broadcast_if_small, materialize


def pending(companies: DataFrame, results: DataFrame, key: str = "company_id", limit: int | None = None) -> DataFrame:
    """Companies without a result."""
    out = companies.join(results.select(key), key, "left_anti")
    return out if limit is None else out.orderBy(key).limit(limit)


def run_key() -> Column:
    low = lambda c: F.lower(F.trim(F.coalesce(F.col(c), F.lit(""))))
    return F.concat_ws("|", low("company_name"), low("city"), low("address"))


def run_pending(rows: DataFrame, done: list[DataFrame]) -> DataFrame:
    """Rows whose name, city and address are in none of the outputs so far."""
    seen = done[0].select(run_key().alias("_k"))
    for d in done[1:]:
        seen = seen.union(d.select(run_key().alias("_k")))
    return rows.withColumn("_k", run_key()).join(seen, "_k", "left_anti").drop("_k")


def export_enriched(companies: DataFrame, results: DataFrame, columns: list[str], key: str = "company_id") -> DataFrame:
    return companies.join(results, key).select(*columns).orderBy(F.desc("lead_score"), key)


def already_enriched(jobs: DataFrame, results: DataFrame, key: str = "company_id") -> DataFrame:
    """Log rows for jobs that have a result."""
    return jobs.join(results.select(key), key, "left_semi").withColumn("status", F.lit("OK_ALREADY_ENRICHED"))


def registry_lookup(inputs: DataFrame, registry: DataFrame) -> DataFrame:
    """First registry row per input: legal or normalised name of a variant, in order, and equal province or city. The
    four ways to agree are four equi-joins, not a join with ORs."""
    variants = inputs.select("row_id", "province", "city", F.posexplode(name_variants(F.col("company_name"))).alias("v", "variant"))
    variants = variants.withColumn("norm", clean_company_name(F.col("variant")))
    reg = registry.select("piva", F.col("ragione_sociale").alias("legal"), F.col("normalized_name").alias("r_norm"), F.col("provincia").alias("r_province"), F.col("citta").alias("r_city"))
    found = None
    for a, b in (("variant", "legal"), ("norm", "r_norm")):
        for c, d in (("province", "r_province"), ("city", "r_city")):
            hit = variants.join(reg, (F.col(a) == F.col(b)) & (F.col(c) == F.col(d))).select("row_id", "v", "piva", "legal")
            found = hit if found is None else found.union(hit)
    w = Window.partitionBy("row_id").orderBy("v", "piva")
    return found.withColumn("_n", F.row_number().over(w)).where("_n = 1").select("row_id", "piva", "legal", F.lit(0.9).alias("confidence"))


#: Words of the longest phrase that the registry index holds.
PHRASE = 3


def _phrases(words: Column, sizes: list[int]) -> Column:
    """Distinct runs of so many adjacent words."""
    runs = lambda k: F.when(F.size(words) >= k, F.transform(F.sequence(F.lit(1), F.size(words) - (k - 1)), lambda i: F.array_join(F.slice(words, i, k), " "))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(*[runs(k) for k in sizes]))


def registry_fuzzy(inputs: DataFrame, registry: DataFrame, name: str = "company_name") -> DataFrame:
    """(row_id, piva, confidence): of the registry rows of the input's city whose folded name holds the input's core name as a phrase the
    one with the smallest number.

    The registry is indexed by phrases of adjacent words, one to ``PHRASE``, and city, each with its smallest number by partial
    aggregates. A core of so few words is looked up whole, so however common it is, it meets one index row. A longer core is
    looked up by its rarest phrase of ``PHRASE`` words, and distinct names found so are checked. Equal cores, and equal registry
    names of a city, are one row each.
    """
    reg = registry.select("piva", fold_text(F.col("ragione_sociale")).alias("legal"), F.col("citta").alias("city"))
    reg = reg.where("legal <> '' and city is not null").groupBy("legal", "city").agg(F.min("piva").alias("piva"))
    wanted = inputs.select("row_id", "city", fold_text(clean_company_name(F.col(name))).alias("core")).where("core <> '' and city is not null")
    cores = wanted.select("city", "core").distinct().withColumn("w", F.split("core", " "))

    index = reg.select("city", "piva", F.explode(_phrases(F.split("legal", " "), list(range(1, PHRASE + 1)))).alias("phrase"))
    index = index.groupBy("phrase", "city").agg(F.min("piva").alias("piva"))
    short = cores.where(F.size("w") <= PHRASE).select("city", "core", F.col("core").alias("phrase")).join(index, ["phrase", "city"]).select("city", "core", "piva")

    # Longer ones: by the rarest of their phrases, told by how many names of the city hold it.
    posted = reg.select("city", "piva", "legal", F.explode(_phrases(F.split("legal", " "), [PHRASE])).alias("phrase"))
    df = posted.groupBy("phrase", "city").agg(F.count("*").alias("df"))
    long_ = cores.where(F.size("w") > PHRASE).select("city", "core", F.explode(_phrases(F.col("w"), [PHRASE])).alias("phrase")).join(df, ["phrase", "city"])
    rarest = long_.groupBy("city", "core").agg(F.min_by("phrase", F.struct("df", "phrase")).alias("phrase"))
    holds = F.contains(F.concat(F.lit(" "), "legal", F.lit(" ")), F.concat(F.lit(" "), "core", F.lit(" ")))
    found = rarest.join(posted, ["phrase", "city"]).where(holds).groupBy("city", "core").agg(F.min("piva").alias("piva"))
    return wanted.join(short.unionByName(found), ["city", "core"]).select("row_id", "piva", F.lit(0.8).alias("confidence"))


def filter_blacklisted(candidates: DataFrame, blacklist: DataFrame, url: str = "source_url", key: str = "cand_id") -> DataFrame:
    """Candidates whose host is no listed domain nor below one: host suffixes are join keys."""
    bad = candidates.select(key, F.explode(host_suffixes(F.col(url))).alias("domain")).join(blacklist.select("domain"), "domain", "left_semi")
    return candidates.join(bad.select(key).distinct(), key, "left_anti")


def match_phones(entities: DataFrame, found: DataFrame) -> DataFrame:
    """(row_id, page_id, n_pages): of each row the smallest page that shows one of its numbers, and how many do (once for each
    number). Numbers match if equal or suffix-equal.

    Different numbers are compared, joined on their last eight digits (shorter ones on all); a number that very many rows
    or pages have is one row here."""
    tail = lambda c: F.substring(F.regexp_replace(c, "[^0-9]", ""), -8, 8)
    a = entities.select("row_id", F.explode(F.array_distinct("phones")).alias("pa"))
    b = found.select("page_id", F.explode(F.array_distinct("found")).alias("pb")).groupBy("pb").agg(F.min("page_id").alias("page_id"), F.countDistinct("page_id").alias("n_pages"))
    pairs = a.select("pa").distinct().withColumn("k", tail(F.col("pa"))).join(b.withColumn("k", tail(F.col("pb"))), "k").where(phones_match(F.col("pa"), F.col("pb")))
    pairs = pairs.groupBy("pa").agg(F.min("page_id").alias("page_id"), F.sum("n_pages").alias("n_pages"))
    return a.join(pairs, "pa").groupBy("row_id").agg(F.min("page_id").alias("page_id"), F.sum("n_pages").alias("n_pages"))


def candidates_with_pages(candidates: DataFrame, pages: DataFrame, url: str = "source_url") -> DataFrame:
    """Candidates with the signals of their fetched page; those not fetched or with status 400 and up are dropped. Pages
    should come without their html."""
    left = candidates.withColumn("_u", canonical_url(F.col(url)))
    right = pages.where("status < 400").withColumn("_u", canonical_url(F.col("url"))).dropDuplicates(["_u"])
    return left.join(right.drop("url"), "_u").drop("_u")


def pages_by_vat(pages: DataFrame, companies: DataFrame, text: str = "text") -> DataFrame:
    """(page_id, company_id) where a page shows the company's VAT number: extracted numbers are the join key."""
    shown = pages.select("page_id", F.explode(extract_vats(F.col(text))).alias("vat"))
    return shown.join(companies.select("company_id", F.regexp_replace("vat", "[^0-9]", "").alias("vat")).where("vat <> ''"), "vat").select("page_id", "company_id").distinct()


def _grams(c: Column) -> Column:
    """The different runs of three characters."""
    n = F.length(c) - 2
    return F.when(n > 0, F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.substring(c, i, F.lit(3))))).otherwise(F.array().cast("array<string>"))


def _holding(texts: DataFrame, parts: DataFrame) -> DataFrame:
    """(t, s) for every text ``t`` and part ``s`` that it holds; both are different ones. A part's key is the one of its runs
    of three characters that the fewest texts have; a shorter part is a key itself, looked up among a text's runs that short."""
    t, s = F.col("t"), F.col("s")
    posted = texts.select("t", F.explode(_grams(t)).alias("key"))
    counts = posted.groupBy("key").agg(F.count("*").alias("n"))
    rare = parts.select("s", F.explode(_grams(s)).alias("key")).join(counts, "key").groupBy("s").agg(F.min_by("key", F.struct("n", "key")).alias("key"))
    long = posted.join(rare, "key").where(F.contains(t, s)).select("t", "s")
    runs = lambda k: F.transform(F.sequence(F.lit(1), F.greatest(F.length(t) + 1 - k, F.lit(1))), lambda i: F.substring(t, i, F.lit(k)))
    short = texts.select("t", F.explode(F.array_distinct(F.concat(F.array(F.lit("")), runs(1), runs(2)))).alias("s"))
    return long.unionByName(short.join(parts.where(F.length(s) < 3), "s").where(F.contains(t, s)).select("t", "s"))


def _either_way(q: DataFrame, c: DataFrame) -> DataFrame:
    """(q, c) where one of two different texts holds the other."""
    there = _holding(q.select(F.col("q").alias("t")), c.select(F.col("c").alias("s"))).select(F.col("t").alias("q"), F.col("s").alias("c"))
    back = _holding(c.select(F.col("c").alias("t")), q.select(F.col("q").alias("s"))).select(F.col("s").alias("q"), F.col("t").alias("c"))
    return there.unionByName(back).distinct()


def match_category(queries: DataFrame, taxonomy: DataFrame, query: str = "query", small: int = 10_000) -> DataFrame:
    """Categories that hold the query or are held by it, whatever the case; null on either side matches nothing.

    A taxonomy of up to ``small`` rows, counted, is broadcast. Beyond, different texts meet by the rarest three characters of
    the shorter one, and rows are joined back by text."""
    q, c = F.lower(F.col(query)), F.lower(F.col("category"))
    if taxonomy.limit(small + 1).count() <= small:
        return queries.join(F.broadcast(taxonomy), F.contains(q, c) | F.contains(c, q))
    some = lambda df, x, n: materialize(df.select(x.alias(n)).where(f"{n} is not null").distinct())
    pairs = materialize(_either_way(some(queries, q, "q"), some(taxonomy, c, "c")))
    out = queries.withColumn("_q", q).join(pairs.select(F.col("q").alias("_q"), F.col("c").alias("_c")), "_q")
    return out.join(taxonomy.withColumn("_c", c), "_c").drop("_q", "_c")


def sector_suffixes(companies: DataFrame, sectors: DataFrame, category: str = "category", small: int = 10_000) -> DataFrame:
    """Per company the suffixes of the first sector, in table order, that equals its category or shares four characters and
    more with it either way; exact ones first. Sectors beyond ``small`` rows are found as in ``match_category``, once for each
    different category."""
    c, s = F.lower(F.col(category)), F.lower(F.col("sector"))
    if sectors.limit(small + 1).count() > small:
        long = lambda df, x, n: materialize(df.select(x.alias(n)).where(F.col(n).isNotNull()).distinct())
        q, t = long(companies, c, "q"), long(sectors, s, "c")
        near = _either_way(q.where("length(q) >= 4"), t.where("length(c) >= 4")).unionByName(q.join(t, q["q"] == t["c"])).distinct()
        rows = near.join(sectors.select(s.alias("c"), F.struct(*sectors.columns).alias("_s"), F.col("pos").alias("_p")), "c")
        best = materialize(rows.groupBy("q").agg(F.min_by("_s", F.struct(F.col("q") != F.col("c"), "_p")).alias("_s")))
        out = companies.withColumn("_q", c).join(broadcast_if_small(best.withColumnRenamed("q", "_q")), "_q")
        return out.select(*companies.columns, *[F.col(f"_s.{x}").alias(x) for x in sectors.columns])
    near = (F.length(c) >= 4) & (F.length(s) >= 4) & (F.contains(c, s) | F.contains(s, c))
    hit = companies.join(F.broadcast(sectors), (c == s) | near)
    w = Window.partitionBy("row_id").orderBy((c == s).desc(), "pos")
    return hit.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


#: Listings of a phone that a token may stand in and still be followed one by one.
COMMON = 64


def _token_words(tokens: DataFrame, words: DataFrame) -> DataFrame:
    """(phone_key, t, w): words of a phone's listings that show a token: the same, or from four characters on holding it. A
    holder has the token's first four characters somewhere, so these are a join key."""
    same = tokens.join(words.select("phone_key", F.col("w").alias("t"), "w"), ["phone_key", "t"])
    grams = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("w") - 3), lambda i: F.col("w").substr(i, F.lit(4))))
    parts = words.where("length(w) > 4").select("phone_key", "w", F.explode(grams).alias("g"))
    held = tokens.where("length(t) >= 4").withColumn("g", F.substring("t", 1, 4)).join(parts, ["phone_key", "g"])
    return same.unionByName(held.where(F.contains("w", F.col("t")) & (F.col("t") != F.col("w"))).select("phone_key", "t", "w"))


def best_directory_listing(companies: DataFrame, listings: DataFrame, least: float = 0.15, common: int = COMMON) -> DataFrame:
    """Of the listings with the company's phone the one of best name coverage (of equal ones the smallest id); none if that is under
    ``least`` and there are several.

    Companies of one phone and equal tokens are scored once, and so are listings of one phone and equal names. Tokens are posted
    to the listings that show them. Those in ``common`` listings of the phone or fewer lead to candidates, which are scored in full.
    The others are few; a listing that shows only such ones scores by their number, so for each set of them that listings show
    the smallest id stands for all. So a number shared by very many rows makes no pairs of its companies and listings.
    """
    tokens = name_tokens(F.col("company_name"))
    asked = companies.select("*", tokens.alias("_t"))
    kinds = materialize(asked.where("phone_key is not null").select("phone_key", "_t").distinct().withColumn("kind", F.xxhash64("phone_key", "_t")))
    shown = listings.where("phone_key is not null").select("phone_key", "listing_id", fold_text(F.col("listing_name")).alias("text"))
    phones = shown.groupBy("phone_key").agg(F.min("listing_id").alias("listing_id"), F.count("*").alias("n_listings"))
    names = materialize(shown.groupBy("phone_key", "text").agg(F.min("listing_id").alias("listing_id")))
    placed = names.select("phone_key", "listing_id", F.explode(F.array_distinct(F.split("text", " "))).alias("w"))
    wanted = kinds.select("phone_key", F.explode(F.array_distinct("_t")).alias("t")).distinct()
    shows = _token_words(wanted, placed.select("phone_key", "w").distinct())
    posted = materialize(placed.join(shows, ["phone_key", "w"]).select("phone_key", "t", "listing_id").distinct())
    df = posted.groupBy("phone_key", "t").agg(F.count("*").alias("df"))
    often = materialize(df.where(F.col("df") > common).select("phone_key", "t"))

    # Candidates by rarer tokens, scored in full.
    rare = posted.join(often, ["phone_key", "t"], "left_anti")
    met = kinds.select("phone_key", "kind", F.explode(F.array_distinct("_t")).alias("t")).join(rare, ["phone_key", "t"]).select("phone_key", "kind", "listing_id").distinct()
    full = met.join(kinds, ["phone_key", "kind"]).join(names, ["phone_key", "listing_id"])
    found = full.select("phone_key", "_t", "listing_id", tokens_coverage(F.col("_t"), F.col("text")).alias("name_score"))
    # Sets of common tokens, of companies (as often as they hold each) and of listings.
    sets = posted.join(often, ["phone_key", "t"]).groupBy("phone_key", "listing_id").agg(F.sort_array(F.collect_set("t")).alias("held"))
    sets = sets.groupBy("phone_key", "held").agg(F.min("listing_id").alias("listing_id"))
    held = often.groupBy("phone_key").agg(F.collect_set("t").alias("all"))  # a phone's postings / common at most
    part = kinds.join(held, "phone_key").select("phone_key", "_t", F.filter("_t", lambda t: F.array_contains("all", t)).alias("part")).where("size(part) > 0")
    scored = part.select("phone_key", "part").distinct().join(sets, "phone_key").withColumn("hits", F.size(F.filter("part", lambda t: F.array_contains("held", t))))
    top = scored.groupBy("phone_key", "part").agg(F.max(F.struct("hits", (-F.col("listing_id")).alias("back"))).alias("b"))
    few = part.join(top, ["phone_key", "part"]).select("phone_key", "_t", (-F.col("b.back")).alias("listing_id"), (F.col("b.hits") / F.size("_t")).alias("name_score"))
    none = kinds.join(phones, "phone_key").select("phone_key", "_t", "listing_id", F.lit(0.0).alias("name_score"))

    best = found.unionByName(few).unionByName(none).groupBy("phone_key", "_t").agg(F.max(F.struct("name_score", (-F.col("listing_id")).alias("back"))).alias("b"))
    best = best.select("phone_key", "_t", "b.name_score", (-F.col("b.back")).alias("listing_id")).join(phones.drop("listing_id"), "phone_key")
    best = best.where((F.col("name_score") >= least) | (F.col("n_listings") == 1))
    return asked.join(best, ["phone_key", "_t"]).drop("_t").join(listings.drop("phone_key"), "listing_id")


def confirm_identity(profiles: DataFrame, companies: DataFrame, text: str = "text") -> DataFrame:
    low = F.lower(F.col(text))
    place = lambda c: (F.length(F.coalesce(c, F.lit(""))) > 0) & F.contains(low, F.lower(F.col(c)))
    vat = (F.length(F.coalesce("vat", F.lit(""))) > 0) & F.contains(F.regexp_replace(low, "[^0-9]", " "), F.regexp_replace("vat", "[^0-9]", ""))
    return profiles.join(companies, "company_id").withColumn("identity", F.when(F.coalesce(place("city"), F.lit(False)) | F.coalesce(place("province"), F.lit(False)) | F.coalesce(vat, F.lit(False)), "HIGH").otherwise("MEDIUM"))


def known_domains(guesses: DataFrame, live: DataFrame) -> DataFrame:
    """Guessed domains that are in a table of live hosts."""
    return guesses.join(live.select("domain"), "domain", "left_semi")
