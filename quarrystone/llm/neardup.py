"""Near-duplicates by an inverted join over MinHash signature coordinates."""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarrystone.llm.common import Boxed, col_of, need
from quarrystone.llm.shingles import minhash, set_key, shingle_set
from quarrystone.operators.components import connected_components
from quarrystone.session import broadcast_if_small, materialize, release, table

#: Signature coordinates, and the chance that a pair of just the least similarity has fewer equal ones than are asked for.
COORDINATES = 64
MISSED = 3e-6
#: Least similarity, and that of the registered query (a fixed value of its contract).
PERCENT = 80
QUERY_PERCENT = 85
_FACTORS = np.random.Generator(np.random.PCG64(48)).integers(0, 2**63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def least_matches(percent: int) -> int:
    """Equal coordinates to ask for: 35 at 80 percent, 40 at 85."""
    p, fewer = percent / 100, 0.0
    for m in range(COORDINATES):
        fewer += comb(COORDINATES, m) * p**m * (1 - p) ** (COORDINATES - m)
        if fewer > MISSED:
            return max(m, 1)
    return COORDINATES


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, nodes, signatures = [], [], []
        for text in batch.column("_text"):
            hashes = shingle_set(text.as_py())
            counts.append(len(hashes))
            nodes.append(set_key(hashes) if len(hashes) else None)
            signatures.append(minhash(hashes, _FACTORS).view(np.int32) if len(hashes) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("_id"), batch.column("_row"), pa.array(counts, pa.int64()), pa.array(nodes, pa.binary()), pa.array(signatures, pa.list_(pa.int32()))],
            ["_id", "_row", "n_shingles", "node", "signature"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingle_set(text.as_py()) for text in batch.column("_text")]
        yield pa.RecordBatch.from_arrays(
            [pa.array([set_key(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary()), pa.array([minhash(s, _FACTORS).tobytes() for s in sets], pa.binary())],
            ["node", "hashes", "signature"],
        )


def _shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for node, hashes in zip(batch.column("node"), batch.column("h"), strict=True):
            values = np.frombuffer(hashes.as_py(), np.int64)
            for at in range(0, len(values), 1 << 16):
                part = values[at : at + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array([node.as_py()] * len(part), pa.binary()), pa.array(np.full(len(part), len(values)), pa.int64()), pa.array(part, pa.int64())], ["node", "n", "x"])


def _linked(percent: int, matches: int):
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for sa, sb, ha, hb in zip(*(batch.column(c) for c in ("sa", "sb", "ha", "hb")), strict=True):
                equal = np.count_nonzero(np.frombuffer(sa.as_py(), np.int32) == np.frombuffer(sb.as_py(), np.int32))
                ok = equal >= matches
                if ok:
                    x, y = np.frombuffer(ha.as_py(), np.uint64), np.frombuffer(hb.as_py(), np.uint64)
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    ok = 100 * both >= percent * (len(x) + len(y) - both)
                keep.append(ok)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return check


def _crowded_pairs(open_nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b) of nodes with different labels that can still be similar: an exact prefix join on the full sets.

    With shingles ordered rarest first, two sets that overlap enough share one among the first n - percent% + 1 of each,
    and the first they share leaves enough behind it in both. Copies of one original that differ too much to be linked
    meet only in what the original has, which stands last, so they aren't paired.
    """
    rows = open_nodes.select("node").join(sets.select("node", "h"), "node").mapInArrow(_shingle_rows, "node binary, n long, x long")
    rows = materialize(rows)
    shared = rows.groupBy("x").agg(F.count("*").alias("df"))
    rank = F.row_number().over(Window.partitionBy("node").orderBy("df", "x"))
    first = rows.join(shared, "x").withColumn("i", rank).where(f"df > 1 and i <= n - ceil({percent} * n / 100) + 1")
    first = materialize(first.join(open_nodes, "node").select("x", "node", "label", "n", "i"))
    a = first.select("x", F.col("node").alias("a"), F.col("label").alias("la"), F.col("n").alias("na"), F.col("i").alias("ia"))
    b = first.select("x", F.col("node").alias("b"), F.col("label").alias("lb"), F.col("n").alias("nb"), F.col("i").alias("ib"))
    enough = f"(1 + least(na - ia, nb - ib)) * {100 + percent} >= {percent} * (na + nb)"
    pairs = a.join(b, "x").where(f"a < b and la <> lb and 100 * least(na, nb) >= {percent} * greatest(na, nb) and {enough}").select("a", "b").distinct()
    pairs.made = [rows, first]  # written for it
    return pairs


def _row_key(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.coalesce(col_of(id_col).cast("string"), F.lit("~")), F.coalesce(col_of(text_col), F.lit("")))


def _labelled(docs: DataFrame, id_col: str, text_col: str, percent: int, matches: int | None) -> DataFrame:
    """(_id, _row, n_shingles, component_id, kept) for every row."""
    matches = least_matches(percent) if matches is None else matches
    bare = docs.select(col_of(id_col).alias("_id"), _row_key(id_col, text_col).alias("_row"), col_of(text_col).alias("_text"))
    kind = bare.schema["_id"].dataType.simpleString()
    rows = materialize(bare.mapInArrow(_signatures, f"_id {kind}, _row long, n_shingles long, node binary, signature array<int>"))
    # Equal sets are one node: thousands of copies meet in partial aggregates.
    nodes = rows.where("node is not null").groupBy("node").agg(F.min("_id").alias("_first"), F.min("_row").alias("_row"), F.first("signature").alias("signature"))
    nodes = materialize(nodes)
    posted = nodes.select("node", F.posexplode("signature").alias("c", "v")).select(
        "node", (F.shiftleft(F.col("c").cast("long"), 32) + F.col("v").cast("long").bitwiseAND(0xFFFFFFFF)).alias("post")
    )
    shared = posted.groupBy("post").agg(F.count("*").alias("df")).where("df > 1")
    posted = posted.join(shared, "post")
    # Rarest postings first, those of one document foremost: a pair with enough collisions meets in this prefix.
    by_node = Window.partitionBy("node")
    posted = posted.select(
        "node", "post", F.row_number().over(by_node.orderBy("df", "post")).alias("_r"), F.count("*").over(by_node).alias("_m"), F.sum("df").over(by_node).alias("company")
    )
    prefix = materialize(posted.where(F.col("_r") <= F.col("_m") - (matches - 1)).select("node", "post", "company"))

    wanted = prefix.select("node").distinct().join(nodes.select("node", "_row"), "node")
    wanted = materialize(wanted.select("_row").distinct())
    sets = bare.join(broadcast_if_small(wanted), "_row", "left_semi").select("_text")  # a number for each candidate
    sets = sets.mapInArrow(_sets, "node binary, hashes binary, signature binary").groupBy("node").agg(F.first("hashes").alias("h"), F.first("signature").alias("s"))
    sets = materialize(sets)

    def verified(pairs: DataFrame) -> DataFrame:
        one = sets.select(F.col("node").alias("a"), F.col("s").alias("sa"), F.col("h").alias("ha"))
        two = sets.select(F.col("node").alias("b"), F.col("s").alias("sb"), F.col("h").alias("hb"))
        return materialize(pairs.join(one, "a").join(two, "b").mapInArrow(_linked(percent, matches), "a binary, b binary"))

    # First every posting's members against two hubs: the one that shares most values with others, as an original does
    # with its copies, and the smallest.
    hubs = prefix.groupBy("post").agg(F.max(F.struct("company", "node"))["node"].alias("most"), F.min("node").alias("least"))
    spokes = prefix.join(hubs, "post").select("node", F.explode(F.array_distinct(F.array("most", "least"))).alias("hub")).where("node <> hub")
    tried = materialize(spokes.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct())
    links = verified(tried)
    part = connected_components(links)
    # Then those postings that still hold different components.
    label = F.coalesce("component", "node").alias("label")
    apart = materialize(prefix.join(part, "node", "left").select("post", "node", label))
    mixed = apart.groupBy("post").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("post")
    open_nodes = materialize(apart.join(mixed, "post").select("node", "label").distinct())
    crowded = _crowded_pairs(open_nodes, sets, percent)
    more = verified(crowded.join(tried, ["a", "b"], "left_anti"))
    if not more.isEmpty():
        held, part = part, connected_components(links.unionByName(more))
        release(held)
    release(prefix, wanted, sets, tried, links, apart, open_nodes, more, *crowded.made)

    grouped = nodes.select("node", "_first").join(part, "node", "left").select("node", "_first", F.coalesce("component", "node").alias("component"))
    least = grouped.groupBy("component").agg(F.min("_first").alias("component_id"))
    grouped = grouped.join(least, "component").select("node", "component_id", F.lit(True).alias("_known"))
    out = rows.select("_id", "_row", "n_shingles", "node").join(grouped, "node", "left")
    out = out.withColumn("component_id", F.when(F.col("_known"), F.col("component_id")).otherwise(F.col("_id")))
    return out.select("_id", "_row", "n_shingles", "component_id", F.col("_id").eqNullSafe(F.col("component_id")).alias("kept"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, matches: int | None = None) -> DataFrame:
    """(``id_col``, n_shingles, component_id, kept) for every row.

    Two documents are linked if their sets of distinct five-word shingles (all words as one if fewer) overlap by
    ``percent`` of their union (``matches`` follows from it by ``least_matches``). Documents of equal sets are one node. Every node is posted under its ``COORDINATES``
    signature values; postings of one node are skipped, and of the rest, rarest first, only as many are kept as a pair
    with ``matches`` equal values cannot avoid. Nodes that meet in a posting are compared by equal values, then on full
    sets: first with two hubs of each posting, so that a group of n copies costs n comparisons; where a posting still holds
    several components, its nodes go through an exact prefix join on full sets, and pairs of different components that
    pass it are compared. ``component_id`` is the smallest id reachable.

    Null ids lose every comparison and group as any other; if all ids of a group are null, its rows are all kept. Null,
    empty and blank texts have no shingles and link with nothing. Repeated rows (same id and text) share one verdict. An
    empty table gives an empty result. Other columns are ignored.
    """
    need(docs, id_col, text_col)
    out = _labelled(docs, id_col, text_col, percent, matches)
    return out.select(F.col("_id").alias(id_col), "n_shingles", "component_id", "kept")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, matches: int | None = None) -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, with all their columns."""
    need(docs, id_col, text_col)
    gone = _labelled(docs, id_col, text_col, percent, matches).where("not kept").select(F.col("_id").alias("_gone_id"), F.col("_row").alias("_gone_row"))
    gone = broadcast_if_small(materialize(gone.distinct()))  # two numbers for each row that goes
    boxed = Boxed(docs, None, [])
    rows = docs.select(boxed.box, _row_key(id_col, text_col).alias("_row"), col_of(id_col).alias("_id"))
    rows = rows.join(gone, (F.col("_row") == F.col("_gone_row")) & F.col("_id").eqNullSafe(F.col("_gone_id")), "left_anti")
    return rows.select(*boxed.columns())


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), percent=QUERY_PERCENT)


def neardup_sql(docs: str, percent: int = PERCENT) -> str:
    """CTEs that end in ``verdict`` (doc_id, n_shingles, component_id, kept): all pairs that share a shingle."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
    nd_words AS (SELECT doc_id, regexp_extract_all({lower}, '[^\\x20\\x09-\\x0D]+') AS w FROM {docs}),
    nd_sets AS (
      SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM nd_words),
    nd_posted AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM nd_sets),
    nd_links AS (
      SELECT a.doc_id AS a, b.doc_id AS b FROM nd_posted a JOIN nd_posted b USING (x) WHERE a.doc_id <> b.doc_id
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
    nd_reach AS (SELECT doc_id AS node, doc_id AS root FROM {docs} UNION SELECT l.b, r.root FROM nd_reach r JOIN nd_links l ON l.a = r.node),
    nd_least AS (SELECT node AS doc_id, min(root) AS component_id FROM nd_reach GROUP BY node),
    verdict AS (SELECT doc_id, len(s) AS n_shingles, component_id, doc_id = component_id AS kept FROM nd_sets JOIN nd_least USING (doc_id))"""


OP5_SQL = f"WITH RECURSIVE {neardup_sql('documents', QUERY_PERCENT)} SELECT * FROM verdict"
