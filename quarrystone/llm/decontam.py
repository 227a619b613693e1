"""Benchmark decontamination by SimHash over item-sized windows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarrystone.llm.common import Boxed, col_of, let, need, plain_text
from quarrystone.session import broadcast_if_small, materialize, release, table

WORDS = 5
#: Least weighted similarity, as a fraction.
NUM, DEN = 4, 5
#: Hamming radius over 64 bits; RADIUS + 1 blocks, so fingerprints within the radius agree on one block at least.
RADIUS = 20
#: Benchmark words that are looked for at once (a list in the plan); a larger benchmark is taken in blocks of this size.
ANCHORS = 20_000
#: Block postings of items that are broadcast at most.
BROADCAST_ROWS = 200_000


def _masks(radius: int = RADIUS) -> list[int]:
    """Masks of radius + 1 blocks of 64 bits, as signed numbers."""
    n = radius + 1
    cuts = [64 * i // n for i in range(n + 1)]
    masks = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:], strict=False)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def simhash(hashes: Column, most: int) -> Column:
    """64-bit SimHash of an array of 64-bit hashes, repeats counting as weight; ``most``: a bound on its size.

    A bit is 1 if more than half of the hashes have it. Bits are counted some to a long: four lanes of 16 bits, or two of
    32 for arrays of 65536 and more.
    """
    width = 16 if most < 1 << 16 else 32
    ones = sum(1 << (width * i) for i in range(64 // width))

    def bits(arr: Column) -> Column:
        lane = lambda j: F.aggregate(arr, F.lit(0).cast("long"), lambda acc, h: acc + F.shiftrightunsigned(h, j).bitwiseAND(ones))
        lanes = F.array(*[lane(j) for j in range(width)])

        def pick(counts: Column) -> Column:
            out = []
            for j in range(width):
                for i in range(64 // width):
                    count = F.shiftrightunsigned(counts[j], width * i).bitwiseAND((1 << width) - 1)
                    bit = 1 << (j + width * i)
                    out.append(F.when(2 * count > F.size(arr), F.lit(bit - (1 << 64) if bit >> 63 else bit)).otherwise(F.lit(0)).cast("long"))
            return reduce(lambda x, y: x.bitwiseOR(y), out)

        return let(lanes, pick)

    return let(hashes, bits)


def _shingles(words: Column, m: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.size(words) - m + 1), lambda i: F.array_join(F.slice(words, i, m), " "))


def _items(benchmark: DataFrame, text_col: str) -> DataFrame:
    """A row per distinct normalised item with words: _k, n words, shingles of m words, fingerprint."""
    bare = benchmark.select(plain_text(F.col(text_col)).alias("_p")).where("_p <> ''").distinct()
    bare = bare.select(F.md5("_p").alias("_k"), F.split("_p", " ").alias("_w"))
    bare = bare.withColumns({"n": F.size("_w"), "m": F.least(F.lit(WORDS), F.size("_w"))})
    return bare.withColumn("s", _shingles(F.col("_w"), F.col("m"))).drop("_w")


def _overlap(a: Column, b: Column) -> Column:
    """Sum over shingles of the lesser multiplicity."""
    count = lambda arr, x: F.size(F.filter(arr, lambda y: y == x))
    single = (F.size(F.array_distinct(a)) == F.size(a)) | (F.size(F.array_distinct(b)) == F.size(b))
    both = F.array_intersect(a, b)
    return F.when(single, F.size(both)).otherwise(F.aggregate(both, F.lit(0), lambda acc, x: acc + F.least(count(a, x), count(b, x))))


def _block(docs: DataFrame, items: DataFrame, text_col: str) -> DataFrame:
    """(_t, _k, overlap, union) of matches between texts and one block of items."""
    longest = items.agg(F.max("n")).first()[0] or 1
    items = materialize(items.withColumn("fp", simhash(F.transform("s", lambda x: F.xxhash64(x)), longest)))
    # A window that is similar enough misses a fifth of an item's shingles at most: of one more, it holds one.
    by_rarity = Window.partitionBy("_k").orderBy(F.length("anchor").desc(), "anchor", "sh", "o")
    seeds = items.select("_k", "n", "m", "s", F.size("s").alias("c"), F.posexplode("s").alias("o", "sh"))
    longest_word = lambda x: F.array_max(F.transform(F.split(x, " "), lambda y: F.struct(F.length(y), y.alias("w"))))["w"]
    seeds = seeds.withColumn("anchor", longest_word(F.col("sh"))).withColumn("_r", F.row_number().over(by_rarity)).where("_r <= c div 5 + 1")
    seeds = materialize(
        seeds.select("_k", "n", "m", "c", "s", "sh", "anchor", (F.array_position(F.split("sh", " "), F.col("anchor")) - 1).cast("int").alias("at")).dropDuplicates(["_k", "sh"])
    )
    anchors = [r[0] for r in seeds.select("anchor").distinct().collect()]  # ANCHORS at most
    if not anchors:
        none = docs.sparkSession.createDataFrame([], "_t string, _k string, same int, of int")
        none.made = [items, seeds]
        return none
    words = docs.select(F.md5(F.coalesce(col_of(text_col), F.lit(""))).alias("_t"), F.split(plain_text(col_of(text_col)), " ").alias("w"))
    words = words.where(F.arrays_overlap("w", F.lit(anchors)))
    found = words.select(
        "_t", "w", F.explode(F.filter(F.transform("w", lambda x, i: F.struct(x.alias("x"), i.alias("i"))), lambda y: y["x"].isin(anchors))).alias("a")
    )
    found = found.join(F.broadcast(seeds), F.col("a.x") == F.col("anchor")).withColumn("p", F.col("a.i") - F.col("at"))
    found = found.where((F.col("p") >= 0) & (F.array_join(F.slice("w", F.greatest("p", F.lit(0)) + 1, "m"), " ") == F.col("sh")))
    first = F.greatest(F.lit(0), F.col("p") - F.col("c") + 1)
    found = found.select("_t", "_k", "n", "m", "c", "s", "p", first.alias("lo"), F.slice("w", first + 1, F.col("p") - first + F.col("n")).alias("r"))
    found = found.dropDuplicates(["_t", "_k", "p"])
    # Windows start at a shingle of the item: moving a start to the next such one loses nothing. Each belongs to its leftmost seed.
    before = F.lag("p").over(Window.partitionBy("_t", "_k").orderBy("p"))
    found = found.withColumn("lo2", F.greatest("lo", F.coalesce(before + 1, F.lit(0))))
    starts = F.filter(F.sequence("lo2", "p"), lambda i: F.array_contains(F.col("s"), F.array_join(F.slice("r", i - F.col("lo") + 1, "m"), " ")))
    windows = found.select("_t", "_k", "n", "m", "lo", "r", F.explode(starts).alias("start"))
    windows = windows.select("_t", "_k", _shingles(F.slice("r", F.col("start") - F.col("lo") + 1, "n"), F.col("m")).alias("ws"))
    windows = windows.withColumn("wfp", simhash(F.transform("ws", lambda x: F.xxhash64(x)), longest))
    windows = materialize(windows.select("_t", "_k", "ws", "wfp"))

    # A window meets its item at the blocks on which they agree: some three of all, and none if they are too far apart.
    masks = _masks()
    posts = lambda fp: F.posexplode(F.array(*[F.col(fp).bitwiseAND(m) for m in masks])).alias("blk", "val")
    posted = items.select("_k", "s", "fp", posts("fp"))
    if posted.count() <= BROADCAST_ROWS:
        posted = F.broadcast(posted)
    pairs = windows.select("_t", "_k", "ws", "wfp", posts("wfp")).join(posted, ["_k", "blk", "val"])
    x = F.col("wfp").bitwiseXOR(F.col("fp"))
    lowest = F.coalesce(*[F.when(x.bitwiseAND(m) == 0, F.lit(i)) for i, m in enumerate(masks)])
    pairs = pairs.where((F.bit_count(x) <= RADIUS) & (lowest == F.col("blk")))  # each pair once, at its first equal block
    pairs = pairs.select("_t", "_k", (F.size("ws") + F.size("s")).alias("both"), _overlap(F.col("ws"), F.col("s")).alias("same"))
    pairs = pairs.select("_t", "_k", "same", (F.col("both") - F.col("same")).alias("of")).where(f"{DEN} * same >= {NUM} * of")
    pairs.made = [items, seeds, windows]  # written for it
    return pairs


def contaminated_texts(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", anchors: int = ANCHORS) -> DataFrame:
    """(_t md5 of the text, items array of matching item ids, similarity): a row per contaminated text."""
    items = materialize(_items(benchmark, item_text_col))
    size = items.agg(F.sum(F.expr("size(s) div 5 + 1"))).first()[0] or 0
    blocks = max(1, -(-2 * size // anchors)) if size > anchors else 1  # halves leave room for uneven hashing
    found = []
    for b in range(blocks):
        part = items.where(F.pmod(F.xxhash64("_k"), F.lit(blocks)) == b) if blocks > 1 else items
        found.append(_block(docs, part, text_col))
    pairs = reduce(DataFrame.unionByName, found)
    ids = benchmark.select(F.col(item_col).alias("item"), F.md5(plain_text(F.col(item_text_col))).alias("_k"))
    pairs = pairs.groupBy("_t", "_k").agg(F.max(F.col("same") / F.col("of")).alias("sim"))
    pairs = materialize(pairs.join(ids, "_k").groupBy("_t").agg(F.array_sort(F.collect_set("item")).alias("items"), F.max("sim").alias("similarity")))
    release(items, *[x for part in found for x in part.made])
    return pairs


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns of ``docs`` by default, those named like a new one, in any case, replaced) with contaminated, n_items, items, similarity.

    A text is contaminated by an item if a window of as many words has a weighted similarity of 0.8 or more: multisets of
    five-word shingles (all words if an item has fewer), lesser over greater multiplicities; words are lower-cased and lie
    between ASCII separators. Windows are taken at every place that can hold the best one: where a shingle of an item
    stands, near one of the item's seed shingles of which a similar window holds one at least (SimHash of all windows of
    all sizes would cost some hundred times as much). A window's SimHash is looked up in the item's by ``RADIUS`` + 1 bit
    blocks, which finds every fingerprint within ``RADIUS`` bits, and what is found is verified on the shingles themselves. The chance that a window of similarity just 0.8 lies
    beyond the radius is about 1 in 5000; equal ones are at distance 0.

    Null and empty texts and items match nothing; equal texts and equal items share one result; null item ids are left out
    of ``items`` but count as contaminating; empty tables give no match.
    """
    need(docs, text_col)
    need(benchmark, item_col, item_text_col)
    boxed = Boxed(docs, keep, ["contaminated", "n_items", "items", "similarity"])
    found = contaminated_texts(docs, benchmark, text_col, item_col, item_text_col)
    out = docs.select(boxed.box, F.md5(F.coalesce(col_of(text_col), F.lit(""))).alias("_t")).join(found, "_t", "left")
    return out.select(
        *boxed.columns(), F.col("items").isNotNull().alias("contaminated"), F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"), "items", F.coalesce("similarity", F.lit(0.0)).alias("similarity")
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without a match, with their columns alone."""
    found = contaminated_texts(docs, benchmark, text_col, item_col, item_text_col).select(F.col("_t").alias("_gone"))
    found = broadcast_if_small(found)  # a digest for each text that goes
    boxed = Boxed(docs, None, [])
    rows = docs.select(boxed.box, F.md5(F.coalesce(col_of(text_col), F.lit(""))).alias("_t"))
    return rows.join(found, F.col("_t") == F.col("_gone"), "left_anti").select(*boxed.columns())


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return out.select("doc_id", "contaminated", "n_items", F.coalesce(F.array_join("items", ","), F.lit("")).alias("items"), "similarity")


def decontam_sql(docs: str) -> str:
    """CTEs that end in ``dc_matches`` (doc_id, item_id, sim): every window at a shared shingle, compared plainly."""
    words = lambda x: f"regexp_extract_all(lower(coalesce({x}, '')), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    shingles = lambda w, m: f"list_transform(range(1, len({w}) - {m} + 2), lambda i: array_to_string({w}[i:i + {m} - 1], ' '))"
    return f"""
    dc_items AS (SELECT item_id, w, len(w) AS n, least({WORDS}, len(w)) AS m FROM (SELECT item_id, {words("text")} AS w FROM benchmark) WHERE len(w) > 0),
    dc_item_s AS (SELECT item_id, n, m, unnest({shingles("w", "m")}) AS x FROM dc_items),
    dc_docs AS (SELECT doc_id, {words("text")} AS w FROM {docs}),
    dc_doc_s AS (SELECT doc_id, m, unnest({shingles("w", "m")}) AS x, unnest(range(1, len(w) - m + 2)) AS p FROM dc_docs, (SELECT DISTINCT m FROM dc_items) WHERE len(w) >= m),
    dc_starts AS (SELECT DISTINCT doc_id, item_id, n, m, p FROM dc_doc_s JOIN dc_item_s USING (m, x)),
    dc_window AS (
      SELECT s.doc_id, s.item_id, s.p, d.x, count(*) AS c FROM dc_starts s JOIN dc_doc_s d ON d.doc_id = s.doc_id AND d.m = s.m AND d.p BETWEEN s.p AND s.p + s.n - s.m
      GROUP BY ALL),
    dc_item_c AS (SELECT item_id, x, count(*) AS c FROM dc_item_s GROUP BY ALL),
    dc_same AS (SELECT w.doc_id, w.item_id, w.p, sum(least(w.c, coalesce(i.c, 0))) AS same, sum(w.c) AS size_ FROM dc_window w LEFT JOIN dc_item_c i USING (item_id, x) GROUP BY ALL),
    dc_matches AS (
      SELECT doc_id, item_id, max(same / (size_ + n - m + 1 - same)) AS sim FROM dc_same JOIN dc_items USING (item_id)
      WHERE {DEN} * same >= {NUM} * (size_ + n - m + 1 - same) GROUP BY ALL)"""


OP4_SQL = f"""WITH {decontam_sql("documents")}
SELECT d.doc_id, count(item_id) > 0 AS contaminated, count(item_id) AS n_items, coalesce(string_agg(item_id, ',' ORDER BY item_id), '') AS items,
  coalesce(max(sim), 0.0)::DOUBLE AS similarity FROM documents d LEFT JOIN dc_matches m ON m.doc_id = d.doc_id GROUP BY d.doc_id"""
