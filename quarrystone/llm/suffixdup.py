"""Removal of repeated byte strings by suffix arrays."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrystone.llm.common import need
from quarrystone.llm.suffixes import anchors, common_prefixes, line_up, suffix_order, words
from quarrystone.session import materialize, release, table

#: Length of the strings that count, and of their anchors.
SPAN = 50
ANCHOR = 20
#: Text bytes whose anchors are counted by one group, and bytes of contexts that one suffix array holds, on average.
COUNT_BYTES = 32 << 20
ARRAY_BYTES = 3 << 20
#: An anchor that stands in more texts than this is hot, as a sample of a thousandth of all texts (of SAMPLE at least) shows.
#: Hot ones only take another way; results are the same.
HOT = 20_000
SAMPLE = 4_000
#: Bytes of texts whose anchors are found at a time.
PIECE = 1 << 21
LAST = 2**63 - 1


def _pieces(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """(number of the first, texts) of stretches of some ``PIECE`` bytes."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= PIECE or i == len(texts) - 1:
            yield at, texts[at : i + 1]
            at, size = i + 1, 0


def _codes(h: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """Group and 32-bit code of anchors; an anchor taken for another only costs a comparison."""
    return ((h >> np.uint64(32)) % np.uint64(groups)).astype(np.int32), (h & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _text(value: pa.Scalar) -> bytes:
    return (value.as_py() or "").encode("utf-8", "surrogatepass")


def _distinct(whose: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    by = np.lexsort((h, whose))
    whose, h = whose[by], h[by]
    fresh = np.concatenate(([True], (h[1:] != h[:-1]) | (whose[1:] != whose[:-1]))) if len(h) else np.empty(0, bool)
    return whose[fresh], h[fresh]


def _post(groups: int, hot: np.ndarray):
    """(group, keys, sizes, codes): for a batch of texts and each group it meets, the texts' keys, and their anchors' codes; in
    groups below 0, which only spread them, the keys of texts with a hot anchor."""

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for turn, batch in enumerate(batches):
            keys, owners, hashes = batch.column("key").to_pylist(), [], []
            for at, texts in _pieces([_text(t) for t in batch.column("text")]):
                whose, _, _, h = anchors(texts, SPAN, ANCHOR)
                owners.append(whose + at)
                hashes.append(h)
            if not keys:
                continue
            owner, h = np.concatenate(owners), np.concatenate(hashes)
            rows = []
            if len(hot):
                is_hot = _among(h, hot)
                if is_hot.any():
                    rows.append((-1 - turn % groups, b"".join(keys[i] for i in np.unique(owner[is_hot])), b"", b""))
                    owner, h = owner[~is_hot], h[~is_hot]
            group, code = _codes(h, groups)
            by = np.argsort(group.astype(np.uint16) if groups < 1 << 16 else group, kind="stable")
            owner, group, code = owner[by], group[by], code[by]
            cuts = np.append(np.flatnonzero(np.append(True, group[1:] != group[:-1]))[: len(group)], len(group))
            for first, end in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                part = owner[first:end]  # in the order of texts
                new = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
                sizes = np.diff(np.append(new, len(part)))
                rows.append((int(group[first]), b"".join([keys[i] for i in part[new].tolist()]), sizes.astype(np.uint32).tobytes(), code[first:end].tobytes()))
            names = ["grp", "keys", "sizes", "codes"]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int32() if i == 0 else pa.binary()) for i in range(4)], names=names)

    return post


def _among(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Which values are among the sorted ``wanted``."""
    if not len(wanted):
        return np.zeros(len(values), dtype=bool)
    return wanted[np.minimum(np.searchsorted(wanted, values), len(wanted) - 1)] == values


def _runs(sorted_: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins, and the end."""
    return np.append(np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1]))[: len(sorted_)], len(sorted_))


def _shared(posted: pa.Table) -> pa.Table:
    """(key, grp, codes): for each text of a group its codes that other texts have too; of a group below 0 all keys."""
    if posted.column("grp")[0].as_py() < 0:
        every = [k[i : i + 16] for k in posted.column("keys").to_pylist() for i in range(0, len(k), 16)]
        return pa.table({"key": pa.array(every, pa.binary()), "grp": pa.array([-1] * len(every), pa.int32()), "codes": pa.array([b""] * len(every), pa.binary())})
    keys: dict[bytes, int] = {}
    owner, code = [], []
    for k, s, c in zip(*(posted.column(x).to_pylist() for x in ("keys", "sizes", "codes")), strict=True):
        ids = np.array([keys.setdefault(k[i : i + 16], len(keys)) for i in range(0, len(k), 16)], dtype=np.int32)
        owner.append(np.repeat(ids, np.frombuffer(s, dtype=np.uint32)))
        code.append(np.frombuffer(c, dtype=np.uint32))
    pair = np.sort(np.concatenate(code).astype(np.uint64) << np.uint64(32) | np.concatenate(owner).astype(np.uint64))
    pair = pair[np.append(True, pair[1:] != pair[:-1])[: len(pair)]]
    code, owner = (pair >> np.uint64(32)).astype(np.uint32), (pair & np.uint64(0xFFFFFFFF)).astype(np.int32)
    fresh = np.append(True, code[1:] != code[:-1])[: len(code)]
    twice = ~(fresh & np.append(fresh[1:], True)[: len(code)])
    code, owner = code[twice], owner[twice]
    by = np.argsort(owner, kind="stable")
    code, owner = code[by], owner[by]
    cuts = _runs(owner)
    named = list(keys)
    parts = [code[a:b].tobytes() for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
    group = posted.column("grp")[0].as_py()
    return pa.table({"key": pa.array([named[i] for i in owner[cuts[:-1]].tolist()], pa.binary()), "grp": pa.array([group] * len(parts), pa.int32()), "codes": pa.array(parts, pa.binary())})


def _slices(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> pa.Array:
    """Binary array of data[start : start + size]; below 2 GB in all."""
    ends = np.cumsum(size)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - size), size)
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(np.append(0, ends).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data[at]))])


def _tags(owner: np.ndarray, group: np.ndarray, code: np.ndarray) -> np.ndarray:
    """One number for a text and an anchor's group and code; one taken for another only costs a comparison."""
    return ((group.astype(np.uint64) << np.uint64(32) | code) + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xD6E8FEB86659FD93)


def _contexts(groups: int, hot: np.ndarray):
    """Around each shared anchor that isn't hot the bytes of all strings that it stands for: (h, context, keys, places). Equal
    contexts of a batch are one row, with the keys, and the orders and starts, of all texts that have it."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keys, orders = [_text(t) for t in batch.column("text")], batch.column("key").to_pylist(), batch.column("ord").to_numpy()
            codes = batch.column("codes").to_pylist()
            for at, piece in _pieces(texts):
                whose, first, last, h = anchors(piece, SPAN, ANCHOR)
                owner, group, code = [], [], []
                for i in range(len(piece)):
                    for c in codes[at + i]:
                        mine = np.frombuffer(c["codes"], dtype=np.uint32)
                        owner.append(np.full(len(mine), i))
                        group.append(np.full(len(mine), c["grp"]))
                        code.append(mine)
                shared = np.sort(_tags(*(np.concatenate(x) for x in (owner, group, code)))) if owner else np.empty(0, np.uint64)
                chosen = _among(_tags(whose, *_codes(h, groups)), shared) & ~_among(h, hot)
                whose, first, last, h = whose[chosen], first[chosen], last[chosen], h[chosen]
                begins = np.cumsum([0, *map(len, piece[:-1])])
                context = _slices(np.frombuffer(b"".join(piece), dtype=np.uint8), begins[whose] + first, last - first + SPAN).dictionary_encode()
                kind = context.indices.to_numpy()
                by = np.argsort(kind, kind="stable")
                cuts = _runs(kind[by])
                names = np.frombuffer(b"".join(keys[at : at + len(piece)]), dtype=np.uint64).reshape(-1, 2)
                places = np.stack([orders[whose + at], first], axis=1)[by]
                rows = [pa.array(h[by][cuts[:-1]].view(np.int64)), context.dictionary, _slices(names[whose[by]].view(np.uint8).ravel(), cuts[:-1] * 16, np.diff(cuts) * 16), _slices(places.view(np.uint8).ravel(), cuts[:-1] * 16, np.diff(cuts) * 16)]
                yield pa.RecordBatch.from_arrays(rows, names=["h", "context", "keys", "places"])

    return cut


def _digests(hot: np.ndarray):
    """(key, ord, start, digest) of every string of a hot anchor."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keys, orders = [_text(t) for t in batch.column("text")], batch.column("key"), batch.column("ord").to_numpy()
            for at, piece in _pieces(texts):
                whose, first, last, h = anchors(piece, SPAN, ANCHOR)
                chosen = _among(h, hot)
                whose, first, last = whose[chosen], first[chosen], last[chosen]
                each = last - first + 1
                first = np.repeat(first, each) + np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
                whose = np.repeat(whose, each)
                found = [hashlib.blake2b(piece[i][s : s + SPAN], digest_size=16).digest() for i, s in zip(whose.tolist(), first.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([keys.take(pa.array(whose + at)), pa.array(orders[whose + at]), pa.array(first), pa.array(found, pa.binary())], names=["key", "ord", "start", "digest"])

    return cut


def _joined(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes of a binary column, the size of each value)."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), dtype=np.uint8), np.fromiter(map(len, values), dtype=np.int64, count=len(values))


def repeated_starts(kinds: list[bytes], which: np.ndarray, orders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(context, place) of every string of SPAN bytes that also starts in a context of smaller order.

    ``kinds``: the different contexts, which stand in the suffix array once; ``which``, ``orders``: each context's kind and order."""
    least = np.full(len(kinds), LAST, dtype=np.int64)
    np.minimum.at(least, which, orders)
    sizes_all = np.fromiter(map(len, kinds), dtype=np.int64, count=len(kinds)) - SPAN + 1
    base = np.cumsum(sizes_all) - sizes_all
    source = np.repeat(least, sizes_all)
    (kind, place), smallest = _sources(kinds, least)
    source[base[kind] + place] = smallest
    sizes = sizes_all[which]
    of = np.repeat(np.arange(len(which)), sizes)
    place = np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    hit = source[base[which[of]] + place] < orders[of]
    return of[hit], place[hit]


def _sources(strings: list[bytes], least: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
    """((string, place), smallest order of any string with the same SPAN bytes at some place), for all places."""
    line, starts = line_up(strings)
    word = words(line)
    order = suffix_order(line, word, SPAN)
    # Only places with a whole string before their context's end.
    ends = np.concatenate((starts[1:], [len(line)])) - 1
    owner = np.repeat(np.arange(len(strings)), np.diff(np.concatenate((starts, [len(line)]))))
    order = order[order + SPAN <= ends[owner[order]]]
    alike = common_prefixes(word, order, SPAN) >= SPAN
    block = np.cumsum(~alike) - 1
    smallest = np.full(block[-1] + 1 if len(block) else 0, LAST, dtype=np.int64)
    np.minimum.at(smallest, block, least[owner[order]])
    return (owner[order], order - starts[owner[order]]), smallest[block]


def _spans(group: pa.Table) -> pa.Table:
    """(key, spans): of each text of a group, the merged removed spans found in it."""
    context = group.column("context").combine_chunks().dictionary_encode()
    keys, sizes = _joined(group.column("keys"))
    places = _joined(group.column("places"))[0].view(np.int64).reshape(-1, 2)
    key = pa.Array.from_buffers(pa.binary(16), len(places), [None, pa.py_buffer(keys)]).dictionary_encode()
    of, place = repeated_starts(context.dictionary.to_pylist(), np.repeat(context.indices.to_numpy(), sizes // 16), places[:, 0])
    start, whose = places[of, 1] + place, key.indices.to_numpy()[of].astype(np.int64)
    by = np.argsort(whose << 40 | start) if len(start) and start.max() < 1 << 40 else np.lexsort((start, whose))
    start, whose = start[by], whose[by]
    # Starts at most SPAN apart run together; a run ends where the next text begins.
    apart = (whose[1:] != whose[:-1]) | (start[1:] > start[:-1] + SPAN)
    runs = np.append(np.flatnonzero(np.append(True, apart))[: len(start)], len(start))
    spans = np.stack([start[runs[:-1]], start[runs[1:] - 1] + SPAN], axis=1) if len(start) else np.empty((0, 2), np.int64)
    whose = whose[runs[:-1]]
    cuts = _runs(whose)
    parts = [spans[a:b].tobytes() for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
    return pa.table({"key": key.dictionary.take(pa.array(whose[cuts[:-1]])).cast(pa.binary()), "spans": pa.array(parts, pa.binary())})


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, n_removed, n_spans, kept_sha256, kept_text, removed): texts without their spans."""
    for batch in batches:
        rows = []
        for key, text, spans in zip(*(batch.column(c) for c in ("key", "text", "spans")), strict=True):
            text = _text(text)
            found = np.concatenate([np.frombuffer(s, dtype=np.int64).reshape(-1, 2) for s in spans.as_py()])
            mark = np.zeros(len(text) + 1, dtype=np.int32)
            np.add.at(mark, found[:, 0], 1)
            np.add.at(mark, found[:, 1], -1)
            gone = np.cumsum(mark[:-1]) > 0
            edges = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).astype(np.int8))).reshape(-1, 2)
            left = np.frombuffer(text, dtype=np.uint8)[~gone].tobytes()
            rows.append((key.as_py(), int(gone.sum()), len(edges), hashlib.sha256(left).hexdigest(), left, [{"start": int(a), "end": int(b)} for a, b in edges]))
        kinds = [pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=["key", "n_removed", "n_spans", "kept_sha256", "kept_text", "removed"])


_CUT = "key binary, n_removed long, n_spans long, kept_sha256 string, kept_text binary, removed array<struct<start: bigint, end: bigint>>"


def _hot_anchors(docs: DataFrame, text_col: str, hot: int) -> np.ndarray:
    """Hashes of anchors that a sample puts in over ``hot`` texts. A text has one anchor per 15 bytes or so, so the list is
    some (bytes of all texts / 15 / ``hot``) long at most."""
    n = docs.count()
    share = min(1.0, max(1e-3, SAMPLE / max(n, 1)))
    texts = docs.select(F.col(text_col).alias("text")).where(F.octet_length("text") >= SPAN)
    if share < 1:
        texts = texts.sample(share, seed=5)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, piece in _pieces([_text(t) for t in batch.column("text")]):
                whose, _, _, h = anchors(piece, SPAN, ANCHOR)
                yield pa.RecordBatch.from_arrays([pa.array(_distinct(whose, h)[1].view(np.int64), pa.int64())], ["h"])

    rows = texts.mapInArrow(found, "h long").groupBy("h").count().where(F.col("count") > hot * share).select("h").collect()
    return np.sort(np.array([r[0] for r in rows], dtype=np.int64).view(np.uint64))


def _order(id_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("long"), F.lit(LAST))


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", texts: bool = True, hot_texts: int = HOT) -> DataFrame:
    """Remove from every text each byte covered by a string of 50 bytes that also starts in a document of smaller id.

    Returned per row: ``id_col``, n_bytes, n_removed, n_spans, kept_sha256, and with ``texts`` also kept_text (binary, the
    remaining bytes) and removed (spans in bytes). Strings are judged on the input; matches never cross documents.

    Equal texts: all but the smallest id's are covered whole (from 50 bytes on), and take no further part. Of the others
    every string of 50 bytes has an anchor, the 20 bytes in it of least hash, so equal strings have equal anchors. Anchors
    are counted over all texts in groups of bounded size; those that two texts have are cut out with all strings they stand
    for (equal cuts of a batch once), and the different cuts of an anchor meet in one suffix array: suffixes are sorted in two stages, neighbours that share 50
    bytes form a block, and a place in it is removed if the block holds a smaller id. Anchors that a sample puts in over
    ``hot_texts`` texts are compared by digests of their strings instead, with partial minima, so that a passage that a
    third of all documents share meets in no task.

    Null ids come after all others and cover none; rows of one id don't cover each other; null texts are empty; texts under
    50 bytes stay; an empty table gives an empty result. Other columns are ignored.
    """
    need(docs, id_col, text_col)
    body = F.coalesce(F.col(text_col), F.lit(""))
    key = F.unhex(F.md5(body)).alias("key")
    slim = materialize(docs.select(F.col(id_col).alias("_id"), _order(id_col).alias("ord"), key, F.octet_length(body).cast("long").alias("n_bytes"), F.sha2(body, 256).alias("sha")))
    firsts = materialize(slim.groupBy("key", "n_bytes", "sha").agg(F.min("ord").alias("first")))
    total = firsts.agg(F.sum("n_bytes")).first()[0] or 0
    groups = max(8, int(total // COUNT_BYTES) + 1)
    hot = _hot_anchors(docs, text_col, hot_texts)

    long = docs.select(key, _order(id_col).alias("ord"), F.col(text_col).alias("text")).where(F.octet_length("text") >= SPAN)
    posted = long.select("key", "text").mapInArrow(_post(groups, hot), "grp int, keys binary, sizes binary, codes binary")
    shared = materialize(posted.groupBy("grp").applyInArrow(_shared, "key binary, grp int, codes binary"))
    n_shared = shared.agg(F.sum(F.octet_length("codes"))).first()[0] or 0
    arrays = max(8, int(n_shared / 4 * 80 // ARRAY_BYTES) + 1)

    by_text = shared.groupBy("key").agg(F.collect_list(F.struct("grp", "codes")).alias("codes"))
    chosen = firsts.where(f"n_bytes >= {SPAN}").select("key", F.col("first").alias("ord")).join(by_text, "key")
    lots = materialize(long.join(chosen, ["key", "ord"]).dropDuplicates(["key", "ord"]), "zstd")
    contexts = lots.mapInArrow(_contexts(groups, hot), "h long, context binary, keys binary, places binary").withColumn("arr", F.pmod("h", F.lit(arrays)))
    spans = contexts.groupBy("arr").applyInArrow(_spans, "key binary, spans binary")
    grams = []
    if len(hot):
        busy = lots.where(F.exists("codes", lambda c: c["grp"] < 0))
        grams = [materialize(busy.mapInArrow(_digests(hot), "key binary, ord long, start long, digest binary"))]
        source = grams[0].groupBy("digest").agg(F.min("ord").alias("source"))
        more = grams[0].join(source, "digest").where("source < ord").select("key", F.concat(_bytes8("start"), _bytes8(F.col("start") + SPAN)).alias("spans"))
        spans = spans.unionByName(more)
    spans = materialize(spans.groupBy("key").agg(F.collect_list("spans").alias("spans")))
    cut = lots.select("key", "text").join(spans, "key").mapInArrow(_cut, _CUT)
    cut = materialize(cut if texts else cut.drop("kept_text", "removed"))
    release(lots, spans, shared, *grams)

    # Copies are told first and need no more; so each join stands alone, where Spark can split a key with very many of them.
    told = materialize(slim.join(firsts.select("key", "first"), "key").withColumn("copy", (F.col("ord") > F.col("first")) & (F.col("n_bytes") >= SPAN)))
    release(slim, firsts)
    whole = F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end"))
    gone = [F.col("n_bytes").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"), F.lit(hashlib.sha256(b"").hexdigest()).alias("kept_sha256"), *([F.lit(b"").alias("kept_text"), F.array(whole).alias("removed")] if texts else [])]
    kept = [F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"), F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"), F.coalesce("kept_sha256", "sha").alias("kept_sha256")]
    rest = told.where("not copy").join(cut, "key", "left")
    if texts:
        body = docs.select(F.unhex(F.md5(body)).alias("key"), body.cast("binary").alias("_whole")).dropDuplicates(["key"])
        rest = rest.join(body, "key")
        kept += [F.coalesce("kept_text", "_whole").alias("kept_text"), F.coalesce("removed", F.array().cast("array<struct<start: bigint, end: bigint>>")).alias("removed")]
    own = [F.col("_id").alias(id_col), F.col("n_bytes")]
    return rest.select(*own, *kept).unionByName(told.where("copy").select(*own, *gone))


def _bytes8(value: Column | str) -> Column:
    """Eight bytes of a long, least first, as numpy reads them."""
    shown = F.lpad(F.hex(F.col(value) if isinstance(value, str) else value), 16, "0")
    return F.unhex(F.concat(*[F.substring(shown, 2 * i - 1, 2) for i in range(8, 0, -1)]))


def op2_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_repeats(table(spark, sf_dir, "documents"), texts=False)
