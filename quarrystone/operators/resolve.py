"""Deduplication, linking and merging of company records. Every rule that depends on order takes an explicit row id."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrystone.functions.contacts import canonical_url, digits, host, is_listed, normalize_vat, url_key
from quarrystone.functions.names import clean_company_name, name_city_slug, slug
from quarrystone.operators.components import connected_components, star_edges
from quarrystone.session import broadcast_if_small, materialize

# How far a source is trusted when records are merged.
TRUST = {"REGISTRY": 100, "WEBSITE": 80, "DIRECTORY": 60, "MAPS": 50, "GUESS": 20, "UNKNOWN": 10}


def _has(c: Column) -> Column:
    return F.length(F.trim(F.coalesce(c.cast("string"), F.lit("")))) > 0


def dedup_exact(df: DataFrame, keys: list[str | Column], row_id: str = "row_id", keep: str = "first") -> DataFrame:
    """One row per key: the first (or last) by row id, null ids before all others. Null keys are a key of their own."""
    at = F.struct(F.col(row_id).isNotNull().alias("some"), F.col(row_id).alias("id"))
    return _best_row(df, keys, at, F.min_by if keep == "first" else F.max_by)


def _best_row(df: DataFrame, keys: list[str | Column], order: Column, pick: Callable = F.min_by) -> DataFrame:
    """The row of least (or greatest) ``order`` per key, by partial aggregates: a key of very many rows meets in no task."""
    return df.groupBy(*keys).agg(pick(F.struct(*df.columns), order).alias("_best")).select("_best.*")


def company_id() -> Column:
    """The given id, else md5 of name, phone digits, city and address."""
    low = lambda c: F.lower(F.trim(F.coalesce(F.col(c), F.lit(""))))
    made = F.md5(F.concat_ws("|", low("company_name"), digits(F.col("phone")), low("city"), low("address")))
    return F.coalesce(F.nullif(F.trim(F.col("company_id")), F.lit("")), made)


def deterministic_company_id(df: DataFrame, row_id: str = "row_id") -> tuple[DataFrame, DataFrame]:
    """(rows with distinct ids, one row of counts: loaded, skipped)."""
    with_id = df.withColumn("company_id", company_id() if "company_id" in df.columns else F.md5(F.concat_ws("|", *[F.lower(F.trim(F.coalesce(F.col(c), F.lit("")))) for c in ("company_name", "phone", "city", "address")])))
    counts = with_id.agg(F.count("*").alias("loaded"), (F.count("*") - F.countDistinct("company_id")).alias("skipped"))
    return dedup_exact(with_id, ["company_id"], row_id), counts


def overlay(base: DataFrame, retry: DataFrame, keys: list[str], row_id: str = "row_id") -> DataFrame:
    """Retry rows replace base rows of equal key; rows keep the base's place."""
    both = base.withColumn("_late", F.lit(0)).unionByName(retry.withColumn("_late", F.lit(1)), allowMissingColumns=True)
    columns = [c for c in both.columns if c != "_late"]
    best = F.max_by(F.struct(*columns), F.struct("_late", row_id)).alias("_best")
    return both.groupBy(*keys).agg(best, F.min(F.when(F.col("_late") == 0, F.col(row_id))).alias("place")).select("_best.*", "place")


def merge_by_phone(main: DataFrame, rescue: DataFrame, fields: list[str], row_id: str = "row_id") -> DataFrame:
    """One row per phone (over five characters) or name-city slug: with a website, then more filled fields, then earlier."""
    both = main.withColumn("_late", F.lit(0)).unionByName(rescue.withColumn("_late", F.lit(1)), allowMissingColumns=True)
    phone = F.trim(F.coalesce("phone", F.lit("")))
    both = both.withColumn("merge_key", F.when(F.length(phone) > 5, phone).otherwise(name_city_slug(F.col("company_name"), F.col("city"))))
    filled = sum((_has(F.col(f)).cast("int") for f in fields), F.lit(0))
    order = F.struct((~_has(F.col("website"))).alias("a"), (-filled).alias("b"), F.col("_late").alias("c"), F.col(row_id).alias("d"))
    return _best_row(both.where(F.length("merge_key") >= 5), ["merge_key"], order).drop("_late")


def record_keys() -> Column:
    """Array of typed keys of a record: VAT, website, name and city."""
    vat, site = normalize_vat(F.col("vat")), url_key(F.col("website"))
    named = (F.length("company_name") > 2) & (F.length("city") > 2)
    return F.array_compact(
        F.array(
            F.concat(F.lit("VAT:"), vat), F.concat(F.lit("WEBSITE:"), site), F.when(named, F.concat(F.lit("NAME_CITY:"), slug(F.col("company_name")), F.lit("|"), slug(F.col("city"))))
        )
    )


def link_by_keys(keyed: DataFrame, row_id: str, keys: str) -> DataFrame:
    """(row_id, entity_id): rows that share any element of ``keys`` belong together, transitively; the entity is the
    smallest row id. Each key joins its rows to its smallest row only, so a key of n rows gives n edges."""
    members = keyed.select(F.col(row_id).alias("row"), F.explode(keys).alias("key")).distinct()
    found = connected_components(star_edges(members, "row", "key"))
    return keyed.select(row_id).join(found.select(F.col("node").alias(row_id), "component"), row_id, "left").select(row_id, F.coalesce("component", row_id).alias("entity_id"))


def resolve_entities(df: DataFrame, row_id: str = "row_id") -> DataFrame:
    """``df`` with ``entity_id`` and ``merge_keys``; rows without any key are dropped."""
    keyed = df.withColumn("merge_keys", record_keys()).where(F.size("merge_keys") > 0)
    return keyed.join(link_by_keys(keyed, row_id, "merge_keys"), row_id)


def merge_records_longest(df: DataFrame, fields: list[str], entity: str = "entity_id", row_id: str = "row_id", source: str | None = None) -> DataFrame:
    """Per entity and field the longest filled value, earlier rows first among equals; sources joined by ';'."""

    def best(f: str) -> Column:
        value = F.trim(F.col(f).cast("string"))
        real = (F.length(value) > 0) & ~value.isin("undefined", "null")
        return F.coalesce(F.max_by(F.when(real, F.col(f)), F.when(real, F.struct(F.length(F.col(f).cast("string")).alias("l"), (-F.col(row_id)).alias("r")))), F.lit("")).alias(f)

    aggs = [best(f) for f in fields] + [F.count("*").alias("n_records")]
    if source:
        aggs.append(F.array_join(F.sort_array(F.collect_set(source)), ";").alias("source_file"))
    return df.groupBy(entity).agg(*aggs)


def merge_stats(resolved: DataFrame, entity: str = "entity_id") -> DataFrame:
    """Rows, unique entities, merged rows, and records whose strongest key is a VAT number, a website, or name and city."""
    strongest = F.split(F.get("merge_keys", F.lit(0)), ":")[0]
    kinds = [F.count_if(strongest == k).alias(f"by_{k.lower()}") for k in ("VAT", "WEBSITE", "NAME_CITY")]
    return resolved.agg(F.count("*").alias("n_rows"), F.countDistinct(entity).alias("n_unique"), (F.count("*") - F.countDistinct(entity)).alias("n_merged"), *kinds)


def merge_by_trust(df: DataFrame, key: str, fields: list[str], source: str = "source", pos: str = "row_id") -> DataFrame:
    """Per key and field the value of the most trusted source, earlier rows first among equals, and a map field -> source."""
    trust = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in TRUST.items() for x in p]), F.upper(F.col(source))), F.lit(TRUST["UNKNOWN"]))
    rank = F.struct(trust.alias("t"), (-F.col(pos)).alias("p"))
    picks = [F.max_by(F.when(_has(F.col(f)), F.struct(F.col(f).cast("string").alias("v"), F.col(source).alias("s"))), F.when(_has(F.col(f)), rank)).alias(f"_{f}") for f in fields]
    out = df.groupBy(key).agg(*picks)
    named = F.filter(F.array(*[F.struct(F.lit(f).alias("key"), F.col(f"_{f}.s").alias("value")) for f in fields]), lambda e: e["value"].isNotNull())
    return out.select(key, *[F.col(f"_{f}.v").alias(f) for f in fields], F.map_from_entries(named).alias("sources"))


def cascade_keys() -> Column:
    """Typed keys of a record: VAT number as given, phone digits (over five), name without legal form and city."""
    bare = lambda c: F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9_]", "")
    vat, phone = F.nullif(F.trim(F.col("vat")), F.lit("")), digits(F.col("phone"))
    name = bare(F.regexp_replace(F.lower(F.coalesce("company_name", F.lit(""))), r"s\.r\.l\.|s\.p\.a\.|s\.n\.c\.|srl|spa|snc", ""))
    return F.array_compact(F.array(F.concat(F.lit("V:"), vat), F.when(F.length(phone) > 5, F.concat(F.lit("P:"), phone)), F.when(name != "", F.concat_ws("_", F.concat(F.lit("N:"), name), bare(F.col("city"))))))


def dedup_priority_cascade(df: DataFrame, row_id: str = "row_id") -> DataFrame:
    """One row per entity: rows that share a VAT number, a phone, or a name and city belong together, transitively. The first
    row, with an empty website (source + " + Maps") and phone filled from later ones, and an address under five characters
    by a longer one (else the last there is); ``n_merged`` rows in all. Rows without any key stay alone."""
    keyed = df.withColumn("_keys", cascade_keys())
    rows = df.join(link_by_keys(keyed, row_id, "_keys").withColumnRenamed("entity_id", "_entity"), row_id)
    at = F.col(row_id)
    first = lambda cond, c: F.min_by(F.when(cond, F.col(c)), F.when(cond, at))
    filled = rows.groupBy("_entity").agg(
        F.min_by(F.struct(*df.columns), at).alias("_row"), F.count("*").alias("n_merged"), first(_has(F.col("website")), "website").alias("_site"), first(_has(F.col("phone")), "phone").alias("_phone"),
        first(F.length("address") >= 5, "address").alias("_long"), F.max_by(F.when(_has(F.col("address")), F.col("address")), F.when(_has(F.col("address")), at)).alias("_last"),
    )
    out = filled.select(*[F.col("_row")[c].alias(c) for c in df.columns], "n_merged", "_site", "_phone", "_long", "_last")
    gained = ~_has(F.col("website")) & F.col("_site").isNotNull()
    out = out.withColumn("source", F.when(gained, F.concat(F.coalesce("source", F.lit("")), F.lit(" + Maps"))).otherwise(F.col("source")))
    out = out.withColumns({"website": F.coalesce("_site", "website"), "phone": F.coalesce("_phone", "phone")})
    out = out.withColumn("address", F.when(F.length("address") >= 5, F.col("address")).otherwise(F.coalesce("_long", "_last", "address")))
    return out.drop("_site", "_phone", "_long", "_last")


#: Characters of a gram.
GRAM = 3


def fuzzy_candidates(df: DataFrame, name: str, row_id: str = "row_id", percent: int = 85) -> DataFrame:
    """(a, b, x, y): distinct cleaned names x and y, with their smallest row ids, that can be ``percent`` similar.

    Edits allowed between two names, t, are (100 - percent)% of the longer length. One edit changes ``GRAM`` grams at most, so of
    a name's GRAM t + 1 rarest grams one stands in the other name too, moved by t places at most; and it is among the rarest
    there as well, if both follow one order of rarity. So names meet on (gram, length of the longer) for their rarest grams
    only, and a part that very many names share, being made of frequent grams, joins nothing, as long as GRAM t + 1 grams (about
    half) of a name lie outside of it.
    """
    names = df.groupBy(clean_company_name(F.col(name)).alias("nm")).agg(F.min(row_id).alias("id")).where("nm <> ''")
    names = names.select("id", "nm", F.length("nm").alias("n")).where(F.col("n") >= GRAM)
    share = 100 - percent
    longest = F.floor(F.col("n") * 100 / percent).cast("int")  # of a name that can be similar
    spelled = F.transform(F.sequence(F.lit(1), F.col("n") - (GRAM - 1)), lambda p: F.struct(F.col("nm").substr(p, F.lit(GRAM)).alias("g"), p.alias("p")))
    posted = materialize(names.select("id", F.explode(spelled).alias("x")).select("id", "x.g", "x.p"))
    df_ = broadcast_if_small(materialize(posted.groupBy("g").agg(F.count("*").alias("df"))))
    rank = F.rank().over(Window.partitionBy("id").orderBy("df", "g"))  # a name's grams; those at the end come all or not at all
    t = lambda n: F.floor(n * share / 100)
    rare = posted.join(df_, "g").withColumn("_r", rank).join(names, "id").where(F.col("_r") <= GRAM * t(longest) + 1).select("id", "nm", "n", "g", "p", "_r")
    rare = materialize(rare)
    longer = rare.where(F.col("_r") <= GRAM * t(F.col("n")) + 1).select(F.col("id").alias("a"), F.col("nm").alias("x"), F.col("n").alias("ln"), "g", F.col("p").alias("pa"))
    shorter = rare.withColumn("ln", F.explode(F.sequence(F.col("n"), longest))).where(F.col("_r") <= GRAM * t(F.col("ln")) + 1)
    shorter = shorter.select(F.col("id").alias("b"), F.col("nm").alias("y"), "n", "g", F.col("p").alias("pb"), "ln")
    met = longer.join(shorter, ["ln", "g"]).where((F.abs(F.col("pa") - F.col("pb")) <= t(F.col("ln"))) & (F.col("ln") - F.col("n") <= t(F.col("ln"))))
    return met.where((F.col("ln") > F.col("n")) | (F.col("a") < F.col("b"))).select("a", "b", "x", "y").distinct()


def fuzzy_pairs(df: DataFrame, name: str, row_id: str = "row_id", percent: int = 85) -> DataFrame:
    """(a, b, similarity) of distinct cleaned names with Levenshtein similarity of ``percent`` or more: ``fuzzy_candidates``, verified."""
    pairs, longest = fuzzy_candidates(df, name, row_id, percent), F.greatest(F.length("x"), F.length("y"))
    pairs = pairs.where(F.levenshtein("x", "y") * 100 <= longest * (100 - percent))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), (1 - F.levenshtein("x", "y") / longest).alias("similarity"))


def fuzzy_dedup(df: DataFrame, name: str = "company_name", row_id: str = "row_id", percent: int = 85) -> DataFrame:
    """(row_id, group_id, kept): rows of equal or similar cleaned names, transitively; the smallest row id is kept."""
    keyed = df.select(row_id, clean_company_name(F.col(name)).alias("nm"))
    first = keyed.groupBy("nm").agg(F.min(row_id).alias("first"))
    pairs = materialize(fuzzy_pairs(df, name, row_id, percent))
    groups = connected_components(pairs)
    first = first.join(groups, F.col("first") == F.col("node"), "left").select("nm", F.coalesce("component", "first").alias("group_id"))
    return keyed.join(first, "nm").select(row_id, "group_id", (F.col(row_id) == F.col("group_id")).alias("kept"))


def dedup_candidates(df: DataFrame, most: int = 10) -> DataFrame:
    """Per company and root domain the best rank, with aliases and sources; the first ``most`` per company."""
    best = df.groupBy("company_id", "root_domain").agg(
        F.min_by(F.struct("source_url", "rank", "provider"), F.struct("rank", "pos")).alias("_b"), F.min(F.struct("rank", "pos")).alias("_o"),
        F.sort_array(F.collect_set("source_url")).alias("aliases"), F.sort_array(F.collect_set("provider")).alias("sources"),
    )
    w = Window.partitionBy("company_id").orderBy("_o", "root_domain")
    return best.withColumn("place", F.row_number().over(w)).where(F.col("place") <= most).select("company_id", "root_domain", "_b.source_url", "_b.rank", "_b.provider", "aliases", "sources", "place")


def dedup_urls_by_domain(df: DataFrame, url: str = "url", row_id: str = "row_id", group: list[str] | None = None) -> DataFrame:
    """First URL of each domain."""
    return dedup_exact(df.withColumn("root_domain", host(F.col(url))).where("root_domain is not null"), [*(group or []), "root_domain"], row_id)


def clean_serp(df: DataFrame, noise: list[str], profile: str, most: int = 10) -> tuple[DataFrame, DataFrame]:
    """(target rows, profile rows) of result lists: canonical URLs, one per domain and company, noise sites dropped."""
    rows = df.withColumns({"canonical": canonical_url(F.col("url")), "root_domain": host(F.col("url"))}).where("root_domain is not null")
    profiles = rows.where(is_listed(F.col("url"), [profile]))
    rows = rows.where(~is_listed(F.col("url"), [*noise, profile]))
    rows = dedup_exact(rows, ["company_id", "root_domain"], "rank")
    w = Window.partitionBy("company_id").orderBy("rank")
    return rows.withColumn("place", F.row_number().over(w)).where(F.col("place") <= most), profiles


def runner_ups(df: DataFrame, k: int = 10) -> DataFrame:
    """Per company the best score of each URL (with that row's other columns), top ``k``."""
    others = [c for c in df.columns if c not in ("company_id", "url", "score")]
    best = df.groupBy("company_id", "url").agg(F.max("score").alias("score"), *[F.max_by(c, "score").alias(c) for c in others])
    w = Window.partitionBy("company_id").orderBy(F.desc("score"), "url")
    return best.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)


def profile_and_balance(runners: DataFrame) -> DataFrame:
    """(company_id, profile_url, balance_url) of runner-ups by falling score: the first profile, and the first .pdf if its title
    or description is that of a balance sheet."""
    said = F.lower(F.concat_ws(" ", "title", "description"))
    pdf = F.col("url").endswith(".pdf")
    balance = F.contains(said, F.lit("bilancio")) | F.contains(said, F.lit("stato patrimoniale"))
    first = lambda cond: F.min_by(F.when(cond, F.struct("url", balance.alias("ok"))), F.when(cond, F.col("place")))
    found = runners.groupBy("company_id").agg(first(F.contains("url", F.lit("linkedin.com/"))).alias("_p"), first(pdf).alias("_b"))
    return found.select("company_id", F.col("_p.url").alias("profile_url"), F.when(F.col("_b.ok"), F.col("_b.url")).alias("balance_url"))


def union_candidates(parts: list[tuple[str, DataFrame]], key: str = "company_id", url: str = "url") -> DataFrame:
    """Candidates of several sources, in the order of ``parts``: each URL of a company once, from the first source that has it,
    with ``src`` and ``src_priority`` (from 0)."""
    out = None
    for i, (name, df) in enumerate(parts):
        part = df.withColumns({"src": F.lit(name), "src_priority": F.lit(i)})
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    best = F.min_by(F.struct(*out.columns), F.struct("src_priority", "rank"))
    return out.groupBy(key, url).agg(best.alias("_b")).select("_b.*")


def merge_runs(valid: list[DataFrame], key: list[str], invalid: list[DataFrame], not_found: list[DataFrame]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """First run wins per key among valid rows; invalid ones are those of runs 3 and 4; not found are run 4's if it was."""
    numbered = [d.withColumn("run_no", F.lit(i + 1)) for i, d in enumerate(valid)]
    union = numbered[0]
    for d in numbered[1:]:
        union = union.unionByName(d, allowMissingColumns=True)
    bad = invalid[0]
    for d in invalid[1:]:
        bad = bad.unionByName(d, allowMissingColumns=True)
    return dedup_exact(union, key, "run_no"), bad, not_found[-1]


def upsert(table: DataFrame, rows: DataFrame, key: str, row_id: str = "row_id") -> DataFrame:
    """Insert or replace by key; of new rows with one key the last wins."""
    both = table.withColumn("_new", F.lit(0)).unionByName(rows.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    return _best_row(both, [key], F.struct("_new", row_id), F.max_by).drop("_new")


def keyed_merge_status(results: DataFrame, recovered: DataFrame, key: str, status: str = "status") -> DataFrame:
    """Statuses of recovered rows written over those of ``results``."""
    late = recovered.select(key, F.col(status).alias("_s")).dropDuplicates([key])
    return results.join(late, key, "left").withColumn(status, F.coalesce("_s", status)).drop("_s")
