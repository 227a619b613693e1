"""Categories and sectors beyond what is broadcast: the same rows as by comparing all."""

import random

from quarrystone.operators import joins


def _texts(rng, n):
    words = ["Bar", "Ristorante", "pizza", "Edil", "Costruzioni", "a", "", "co", "Café", "SRL", "restauri"]
    return [" ".join(rng.sample(words, rng.randint(0, 3))) for _ in range(n)] + [None, "x"]


def test_large_taxonomy_equals_small(spark):
    rng = random.Random(5)
    queries = spark.createDataFrame(list(enumerate(_texts(rng, 80))), "row_id long, query string")
    taxonomy = spark.createDataFrame([(t, i) for i, t in enumerate(_texts(rng, 50))], "category string, pos long")
    rows = lambda df: sorted(map(str, df.select("row_id", "query", "category", "pos").collect()))
    small = rows(joins.match_category(queries, taxonomy))
    assert small == rows(joins.match_category(queries, taxonomy, small=3)) and len(small) > 200


def test_large_sector_table_equals_small(spark):
    rng = random.Random(6)
    companies = spark.createDataFrame(list(enumerate(_texts(rng, 80))), "row_id long, category string")
    sectors = spark.createDataFrame([(t, i) for i, t in enumerate(_texts(rng, 30))], "sector string, pos long")
    rows = lambda df: sorted(map(str, df.select("row_id", "category", "sector", "pos").collect()))
    small = rows(joins.sector_suffixes(companies, sectors))
    assert small == rows(joins.sector_suffixes(companies, sectors, small=3)) and len(small) > 30
