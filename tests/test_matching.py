"""Fuzzy names and registry phrases against brute force, with parts that very many names share."""

import random

from pyspark.sql import functions as F

from quarrystone.operators import joins, resolve


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_a_common_prefix_joins_nothing(spark):
    """Each name begins with the same 14 letters; a segment or word of them would compare all pairs."""
    rng = random.Random(6)
    word = lambda n: "".join(rng.choice("abcdefghiklmnoprstuvz") for _ in range(n))
    names = [f"impresa edile {word(rng.randint(10, 14))}" for _ in range(600)]
    names += [n[:-2] + word(1) for n in names[:60]] + ["x" + n for n in names[60:90]] + ["impresa", "imprese", "abc", "abd", ""]
    df = spark.createDataFrame(list(enumerate(names)), "row_id long, company_name string")
    got = {(r.a, r.b) for r in resolve.fuzzy_pairs(df, "company_name").collect()}
    first = {}
    for i, n in enumerate(names):
        first.setdefault(n.strip(), i)
    distinct = [(i, n) for n, i in first.items() if n]
    want = {(min(i, j), max(i, j)) for k, (i, a) in enumerate(distinct) for j, b in distinct[:k] if abs(len(a) - len(b)) <= 5 and distance(a, b) * 100 <= max(len(a), len(b)) * 15}
    assert got == want and len(got) >= 80
    tried = resolve.fuzzy_candidates(df, "company_name").count()
    assert tried <= 12 * len(names)  # of 300 for each, were they compared by a segment


def test_registry_phrases(spark):
    rng = random.Random(7)
    words = ["impresa"] * 6 + ["costruzioni", "generali", "rossi", "bianchi", "verde", "nord", "sud", "alfa"]
    made = lambda n: " ".join(rng.choice(words) for _ in range(n))
    registry = [(i, made(rng.randint(1, 9)), rng.choice(["Milano", "Roma", None])) for i in range(800)]
    asked = [(i, made(rng.choice([1, 1, 2, 3, 4, 5])), rng.choice(["Milano", "Roma", None])) for i in range(300)]
    asked += [(900, registry[5][1], registry[5][2]), (901, "", "Roma"), (902, None, "Roma"), (903, "zzz", "Roma")]
    reg = spark.createDataFrame(registry, "piva long, ragione_sociale string, citta string")
    got = {r.row_id: r.piva for r in joins.registry_fuzzy(spark.createDataFrame(asked, "row_id long, company_name string, city string"), reg).collect()}
    want = {}
    for i, core, city in asked:
        hits = [p for p, legal, c in registry if core and city and c == city and f" {core} " in f" {legal} "]
        if hits:
            want[i] = min(hits)
    assert got == want and len(got) > 120


def test_a_common_word_meets_one_row(spark):
    reg = spark.range(50_000).select(F.col("id").alias("piva"), F.concat(F.lit("impresa n"), F.col("id") % 49_000).alias("ragione_sociale"), F.lit("Milano").alias("citta"))
    asked = spark.range(20_000).select(F.col("id").alias("row_id"), F.lit("Impresa").alias("company_name"), F.lit("Milano").alias("city"))
    out = joins.registry_fuzzy(asked, reg)
    assert out.agg(F.count("*"), F.max("piva")).first() == (20_000, 0)


def test_best_listing(spark):
    """Against all pairs; phone 'many' has common tokens, phone 'one' a single listing."""
    rng = random.Random(12)
    words = ["rossi"] * 5 + ["impianti"] * 4 + ["edil", "verdi", "neri", "bar", "ab", "costruzioni", "rossini", "superedil", "srl"]
    name = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(0, 4))) + rng.choice(["", f" {rng.randrange(400)}"])
    phones = ["many"] * 6 + ["p1", "p2", "p3", None]
    companies = [(i, name(), rng.choice(phones)) for i in range(400)] + [(900, "qq", "one"), (901, "qq", "many"), (902, "", "many")]
    listings = [(i, name(), rng.choice(phones)) for i in range(500)] + [(950, "zz", "one")]
    c = spark.createDataFrame(companies, "row_id long, company_name string, phone_key string")
    li = spark.createDataFrame(listings, "listing_id long, listing_name string, phone_key string")
    filler = {"srl"}
    want = {}
    for i, n, p in companies:
        tokens = [t for t in n.split() if len(t) >= 2 and t not in filler]
        hits = lambda text: sum(t in text.split() or (len(t) >= 4 and t in text) for t in tokens)  # noqa: B023, E731
        scores = sorted((-(hits(x) / len(tokens) if tokens else 0.0), j) for j, x, q in listings if p is not None and q == p)
        if scores and (-scores[0][0] >= 0.15 or len(scores) == 1):
            want[i] = (scores[0][1], round(-scores[0][0], 9), len(scores))
    for common in (joins.COMMON, 3):
        got = {r.row_id: (r.listing_id, round(r.name_score, 9), r.n_listings) for r in joins.best_directory_listing(c, li, common=common).collect()}
        assert got == want


def test_a_switchboard_makes_no_pairs(spark):
    """20000 companies and 20000 listings of one number, of which each pair shares a word."""
    c = spark.range(20_000).select(F.col("id").alias("row_id"), F.concat(F.lit("Rossi impianti nr"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("company_name"), F.lit("02").alias("phone_key"))
    li = c.select((F.col("row_id") + 100_000).alias("listing_id"), F.col("company_name").alias("listing_name"), "phone_key").where("listing_id % 2 = 0")
    got = joins.best_directory_listing(c, li).where("name_score = 1").select(F.col("listing_id") - F.col("row_id"))
    assert got.count() == 10_000 and got.distinct().count() == 1
