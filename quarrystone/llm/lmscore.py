"""Document scores by masked pseudo-likelihood of a small bidirectional network."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrystone.llm.common import Boxed, bucket, col_of, need
from quarrystone.session import materialize, release, table

#: Most frequent words that tasks hold at most, none longer than LONGEST bytes; so the model's size is bounded. All others
#: are looked up in the written counts by a join. A word's code (VOCABULARY + SHARED at most) has 16 bits.
VOCABULARY = 49_152
LONGEST = 64
CLASSES = 32
HIDDEN = 16
#: Context words with an embedding of their own, the most frequent; rows that all others share by hash; and leaves by hash
#: of the words that tasks do not hold (a divisor of SHARED).
OWN = 4096
SHARED = 4096
LEAVES = 256
#: Visits that are added to those of a row in a batch, so that a rare row takes smaller steps.
CALM = 16
#: Words looked at, relative to the masked one; each offset has embeddings of its own.
OFFSETS = (-2, -1, 1, 2)
PAD = 2
ROWS = OWN + SHARED + 1
#: Nodes of a word's path that a training step takes, drawn by chance and weighed by the path's length.
DRAWN = 2
#: Passes that each train on a part of the documents and are averaged; together they train on all of them.
ROUNDS = 2
BATCH = 4096
RATE = 0.5
SLICE = 1 << 14
#: Words that a training task holds at least, and training tasks of a pass at most.
SHARD_WORDS = 4_000_000
SHARDS = 20_000
#: Counted words that a task holds before it hands them on, and bytes of a text that are split at a time.
HELD = 300_000
PIECE = 1 << 22
#: Parts by hash of a count level that does not fit whole into the vocabulary.
PARTS = 4096
#: Rows of weights that are summed by one task.
FAN_IN = 8
#: Words that are scored or trained on at a time, in whole texts.
AT_ONCE = 1 << 18


def words_of(text: str | None) -> Iterator[list[bytes]]:
    """Words between ASCII blanks, A-Z lower-cased, of successive pieces of a text."""
    data = (text or "").encode("utf-8", "surrogatepass").lower()
    at = 0
    while at < len(data):
        end = at + PIECE
        while end < len(data) and data[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        yield data[at:end].split()
        at = end


def _added(rows: np.ndarray, at: np.ndarray, d: np.ndarray, rate: float) -> None:
    """rows[at] -= rate * the mean of d over equal ``at`` (below 2**16), less for those with few. ``d`` goes for each stretch of
    ``at`` that has its length."""
    at = at.astype(np.uint16)
    order = np.argsort(at, kind="stable")
    at = at.take(order)
    first = np.flatnonzero(np.append(True, at[1:] != at[:-1])[: len(at)])
    if not len(first):
        return
    # Two floats are summed as one complex number, in half the steps.
    sums = np.add.reduceat(d.take(order, axis=0, mode="wrap").view(np.result_type(d, np.complex64)), first, axis=0).view(d.dtype)
    sums *= (rate / (np.diff(first, append=len(at)) + CALM)).astype(d.dtype)[:, None]
    at = at.take(first).astype(np.intp)
    rows[at] = rows.take(at, axis=0) - sums


@dataclass
class Weights:
    """h = x / (1 + |x|) of x = (sum of embeddings of the words around, by offset, + b); h @ w + c, softmax over classes.

    Within a class, the word is reached by yes or no at each node of a tree, with the log odds of the counts + h @ u[node].
    ``u`` starts at 0, where words follow their counts within the class; its last row, of no node, stays there.
    """

    v: np.ndarray
    b: np.ndarray
    w: np.ndarray
    c: np.ndarray
    u: np.ndarray

    @classmethod
    def start(cls, seed: int = 8) -> Weights:
        rng = np.random.Generator(np.random.PCG64(seed))
        draw = lambda *n: (rng.standard_normal(n) * 0.1).astype(np.float32)
        none = lambda *n: np.zeros(n, np.float32)
        return cls(draw(len(OFFSETS) * ROWS, HIDDEN), none(HIDDEN), draw(HIDDEN, CLASSES), none(CLASSES), none(VOCABULARY + LEAVES + 1, HIDDEN))

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.v, self.b, self.w, self.c, self.u)])

    @classmethod
    def of(cls, flat: np.ndarray) -> Weights:
        new, at = cls.start(), 0
        for name in ("v", "b", "w", "c", "u"):
            old = getattr(new, name)
            setattr(new, name, flat[at : at + old.size].reshape(old.shape).astype(np.float32))
            at += old.size
        return new

    def hidden(self, near: np.ndarray) -> np.ndarray:
        h = self.v.take(near[0], axis=0)
        for rows in near[1:]:
            h += self.v.take(rows, axis=0)
        h += self.b
        size = np.abs(h)
        size += 1
        h /= size
        return h

    def class_log_p(self, h: np.ndarray, target: np.ndarray) -> np.ndarray:
        z = self.w.T @ h.T  # classes x words: sums over classes are sums of rows
        z += self.c[:, None]
        z -= z.max(axis=0)
        at = z[target, np.arange(len(target))]
        return at - np.log(np.exp(z, out=z).sum(axis=0))

    def log_p(self, near: np.ndarray, entries: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
        """log p of the words, given the rows of ``v`` of those around them."""
        h = self.hidden(near)
        out = self.class_log_p(h, vocabulary.classes.take(entries))
        # The deepest words first, so that every level of their trees is a stretch.
        depth = vocabulary.depth.take(entries)
        order = np.argsort((depth.max(initial=0) - depth).astype(np.uint8), kind="stable")
        h, entries, upto = h.take(order, axis=0), entries.take(order), np.cumsum(np.bincount(depth, minlength=1)[::-1])[::-1]
        p = np.ones(len(entries))
        for level in range(1, len(upto)):
            e = entries[: upto[level]]
            way = vocabulary.way[level - 1].take(e)
            x = np.einsum("ij,ij->i", h[: upto[level]], self.u.take(way >> 1, axis=0))
            x += vocabulary.odds[level - 1].take(e)
            x *= 1 - 2 * (way & 1)
            np.exp(x, out=x)
            x += 1
            p[: upto[level]] /= x
        out[order] += np.log(p)
        return out

    def gradients(self, near: np.ndarray, target: np.ndarray, node: np.ndarray, sign: np.ndarray, odds: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of the summed -log p(class) - weight * log p(sign at node): by x, by u per drawn node, by class scores; and h.

        ``node``, ``sign``, ``odds``, ``weight``: draws x words.
        """
        n = len(target)
        h = self.hidden(near)
        z = self.w.T @ h.T
        z += self.c[:, None]
        z -= z.max(axis=0)
        d = np.exp(z, out=z)
        d /= d.sum(axis=0)
        d[target, np.arange(n)] -= 1
        d = d.T
        dh = d @ self.w.T
        du = np.empty((len(node), n, HIDDEN), np.float32)
        for j in range(len(node)):
            un = self.u.take(node[j], axis=0)
            dx = (-sign[j] * weight[j] / (1 + np.exp(sign[j] * (odds[j] + np.einsum("ij,ij->i", h, un)))))[:, None]
            np.multiply(dx, h, out=du[j])
            un *= dx
            dh += un
        dh *= np.square(1 - np.abs(h))
        return dh, du, d, h

    def step(self, near: np.ndarray, target: np.ndarray, node: np.ndarray, sign: np.ndarray, odds: np.ndarray, weight: np.ndarray, rate: float) -> None:
        dh, du, d, h = self.gradients(near, target, node, sign, odds, weight)
        _added(self.v, near.ravel(), dh, rate)
        if len(node):
            _added(self.u, node.ravel(), du.reshape(-1, HIDDEN), rate)
            self.u[-1] = 0
        rate /= len(target)
        self.w -= rate * (h.T @ d)
        self.c -= rate * d.sum(axis=0)
        self.b -= rate * dh.sum(axis=0)


def _trees(counts: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of words in runs of equal class, by level: way (twice the node, + 1 for its upper half) and log odds; and lengths of their
    paths. A node splits a run at its number."""
    below = np.append(0, np.cumsum(np.maximum(counts, 1e-6)))
    words = np.arange(len(counts))
    lo, hi = np.searchsorted(classes, classes, "left"), np.searchsorted(classes, classes, "right")
    found, depth = [], np.zeros(len(counts), np.int64)
    while (more := hi - lo > 1).any():
        mid = np.where(more, (lo + hi) // 2, lo)
        up = words >= mid
        with np.errstate(divide="ignore"):
            odds = np.where(more, np.log(below[hi] - below[mid]) - np.log(below[mid] - below[lo]), 0)
        depth += more
        found.append((np.where(more, mid, VOCABULARY + LEAVES) * 2 + up, odds))
        lo, hi = np.where(more & up, mid, lo), np.where(more & ~up, mid, hi)
    none = np.empty((0, len(counts)))
    way, odds = (np.stack(x) for x in zip(*found, strict=True)) if found else (none, none)
    return way.astype(np.int32), odds.astype(np.float32), depth


@dataclass
class Vocabulary:
    """word -> entry; entry -> class, row of its embeddings and path.

    The last ``LEAVES`` entries stand for all ``rest`` kinds of words without one of their own, by hash; what is added to
    the nodes of a leaf, ``base``, lacks the log of the word's count, which the written counts hold. Texts are coded by
    entries and, for words without one, ``VOCABULARY`` + a hash below ``SHARED``.
    """

    entries: dict[bytes, int]
    classes: np.ndarray
    rest: int
    base: np.ndarray
    rows: np.ndarray
    way: np.ndarray
    odds: np.ndarray
    depth: np.ndarray

    @classmethod
    def of(cls, top: list[tuple[str, int]], leaves: np.ndarray, kinds: int) -> Vocabulary:
        """``top``: words and counts, most frequent first; ``leaves``: running words of each leaf; ``kinds`` of words in the corpus.

        Classes hold about equal shares of the running words of ``top``; all other words are the last class.
        """
        counts = np.array([n for _, n in top], dtype=np.float64)
        before = np.cumsum(counts) - counts
        classes = np.minimum((before / max(counts.sum(), 1) * (CLASSES - 1)).astype(np.int32), CLASSES - 2)
        entries = {w.encode("utf-8", "surrogatepass"): i for i, (w, _) in enumerate(top)}
        classes = np.append(classes, np.full(LEAVES, CLASSES - 1)).astype(np.int32)
        rows = OWN + np.fromiter((zlib.crc32(w) % SHARED for w in entries), dtype=np.int32, count=len(entries))
        rows[:OWN] = np.arange(len(rows[:OWN]))
        base = np.append(np.zeros(len(top)), -np.log(np.maximum(leaves, 1)))
        return cls(entries, classes, kinds - len(top), base, rows, *_trees(np.append(counts, leaves), classes))

    def encode(self, text: str | None) -> tuple[np.ndarray, list[bytes]]:
        """Codes of the words, and the words that have no entry."""
        get, codes, rest = self.entries.get, [np.empty(0, dtype=np.uint16)], []
        for words in words_of(text):
            ids = np.fromiter(map(get, words, repeat(-1)), dtype=np.int32, count=len(words))
            rare = np.flatnonzero(ids < 0)
            if len(rare):
                found = [words[i] for i in rare.tolist()]
                ids[rare] = np.fromiter(map(zlib.crc32, found), dtype=np.uint32, count=len(found)) % SHARED + VOCABULARY
                rest += found
            codes.append(ids.astype(np.uint16))
        return np.concatenate(codes), rest

    def entries_of(self, codes: np.ndarray) -> np.ndarray:
        codes = codes.astype(np.int32)
        return np.where(codes < VOCABULARY, codes, len(self.entries) + (codes - VOCABULARY) % LEAVES)

    def rows_of(self, codes: np.ndarray) -> np.ndarray:
        codes, own = codes.astype(np.int32), np.append(self.rows, 0)
        return np.where(codes < VOCABULARY, own.take(np.minimum(codes, len(self.rows))), OWN + codes - VOCABULARY).astype(np.int32)

    def drawn(self, entries: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, ...]:
        """``DRAWN`` nodes of each word's path by chance: nodes, signs, log odds, weights."""
        depth = self.depth.take(entries)
        if not len(self.way):
            return (np.empty((0, len(entries)), np.int32),) * 4
        at = (rng.random((DRAWN, len(entries)), dtype=np.float32) * depth).astype(np.int64) * self.way.shape[1] + entries
        way, weight = self.way.ravel().take(at), np.broadcast_to((depth / DRAWN).astype(np.float32), at.shape)
        return way >> 1, ((way & 1) * 2 - 1).astype(np.float32), self.odds.ravel().take(at), weight


def _near(codes: list[np.ndarray], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(entries, offsets x words of rows of ``v``) of all words of some texts; words beyond a text's ends are a row of their own."""
    sizes = np.array([len(x) for x in codes], dtype=np.int64)
    joined = np.concatenate([np.empty(0, dtype=np.uint16), *codes])
    places = np.arange(len(joined)) + np.repeat(np.arange(1, len(codes) + 1) * PAD, sizes)
    line = np.full(len(joined) + (len(codes) + 1) * PAD, ROWS - 1, dtype=np.int32)
    line[places] = vocabulary.rows_of(joined)
    return vocabulary.entries_of(joined), np.stack([line.take(places + o) + j * ROWS for j, o in enumerate(OFFSETS)])


def score_codes(codes: list[np.ndarray], vocabulary: Vocabulary, weights: Weights) -> np.ndarray:
    """Summed log p(word | both sides) of each coded text; without the logs of the counts of words that have no entry."""
    entries, near = _near(codes, vocabulary)
    owner = np.repeat(np.arange(len(codes)), [len(x) for x in codes])
    sums = np.zeros(len(codes))
    for at in range(0, len(entries), SLICE):
        e = entries[at : at + SLICE]
        sums += np.bincount(owner[at : at + SLICE], weights=weights.log_p(near[:, at : at + SLICE], e, vocabulary) + vocabulary.base.take(e), minlength=len(codes))
    return sums


def fit_codes(codes: list[np.ndarray], vocabulary: Vocabulary, weights: Weights, rate: float, rng: np.random.Generator) -> None:
    """One pass of steps over the words of some coded texts."""
    entries, near = _near(codes, vocabulary)
    for at in range(0, len(entries), BATCH):
        e = entries[at : at + BATCH]
        weights.step(near[:, at : at + BATCH], vocabulary.classes.take(e), *vocabulary.drawn(e, rng), rate * len(e) / BATCH)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()).cast(pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

    for batch in batches:
        for text in batch.column("_text").to_pylist():
            for words in words_of(text):
                held.update(words)
                if len(held) >= HELD:
                    yield out()
                    held.clear()
    yield out()


def _coded(vocabulary_b):
    """(_doc, _row, shard hash, codes, rest): texts as codes, and the words without an entry with their counts."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = vocabulary_b.value
        for batch in batches:
            codes, words, times, ends = [], [], [], [0]
            for text in batch.column("_text").to_pylist():
                found, rest = vocabulary.encode(text)
                codes.append(found.tobytes())
                held = Counter(rest)
                words += held.keys()
                times += held.values()
                ends.append(len(words))
            pairs = pa.StructArray.from_arrays([pa.array(words, pa.binary()).cast(pa.string()), pa.array(times, pa.int64())], ["word", "k"])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("_doc", "_row", "_key")], pa.array(codes, pa.binary()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)], ["_doc", "_row", "_key", "_codes", "_rest"]
            )

    return code


def _bunches(column: pa.Array) -> Iterator[list[np.ndarray]]:
    """Coded texts of a column, some ``AT_ONCE`` words at a time."""
    held, size = [], 0
    for x in column.to_pylist():
        held.append(np.frombuffer(x, dtype=np.uint16))
        size += len(held[-1])
        if size >= AT_ONCE:
            yield held
            held, size = [], 0
    if held:
        yield held


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, n, part = 0.0, 0, 0
    for batch in batches:
        for p, w, k in zip(*(batch.column(c) for c in ("part", "w", "n")), strict=True):
            total, n, part = total + np.frombuffer(w.as_py(), dtype=np.float32).astype(np.float64) * k.as_py(), n + k.as_py(), p.as_py()
    if n:
        yield _row_of(total / n, n, part)


def _row_of(flat: np.ndarray, n: int, part: int = 0) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([flat.astype(np.float32).tobytes()], pa.binary()), pa.array([n], pa.int64())], ["part", "w", "n"])


def train(coded: DataFrame, vocabulary_b, words: int, rounds: int = ROUNDS) -> Weights:
    """Local SGD with averaged weights over ``coded`` (_key, _codes).

    Texts are dealt to rounds and shards by ``_key``, which follows from their rows, and are read in its order; how many shards
    there are follows from the words of the corpus. So the layout of the input does not change the result. In each round all
    shards start alike.
    """
    spark = coded.sparkSession
    weights = Weights.start()
    shards = max(1, min(SHARDS, words // SHARD_WORDS // rounds))
    for r in range(rounds):
        start_b = spark.sparkContext.broadcast(weights.flat())

        def fit(batches: Iterator[pa.RecordBatch], start_b=start_b, r: int = r) -> Iterator[pa.RecordBatch]:
            own, n, part, rng, vocabulary = Weights.of(start_b.value), 0, 0, None, vocabulary_b.value
            for batch in batches:
                if batch.num_rows:
                    part = batch.column("part")[0].as_py()
                    rng = rng or np.random.Generator(np.random.PCG64([r, part]))
                for codes in _bunches(batch.column("_codes")):
                    fit_codes(codes, vocabulary, own, RATE / (1 + r), rng)
                    n += sum(map(len, codes))
            if n:
                yield _row_of(own.flat(), n, part)

        # Every text belongs to one round; together the rounds train on all of them.
        dealt = coded.where(F.pmod("_key", F.lit(rounds)) == r).select(F.pmod(F.expr(f"_key div {rounds}"), F.lit(shards)).cast("int").alias("part"), "_key", "_codes")
        dealt = dealt.repartitionById(shards, F.col("part")).sortWithinPartitions("_key", "_codes").select("part", "_codes")
        kind = "part int, w binary, n long"
        summed = materialize(dealt.mapInArrow(fit, kind))  # a row per shard
        while (left := summed.count()) > 1:
            fewer = -(-left // FAN_IN)
            parts, summed = summed, materialize(summed.repartitionById(fewer, F.pmod("part", F.lit(fewer))).sortWithinPartitions("part").mapInArrow(_summed, kind).withColumn("part", F.pmod("part", F.lit(fewer))))
            release(parts)
        for row in summed.collect():  # one of some 5 MB at most
            weights = Weights.of(np.frombuffer(bytes(row.w), dtype=np.float32))
        release(summed)
    return weights


def word_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """(word, n) of all words of all documents, written."""
    counts = docs.select(col_of(text_col).alias("_text")).mapInArrow(_counted, "word string, n long")
    return materialize(counts.groupBy("word").agg(F.sum("n").alias("n")))


def corpus_vocabulary(counts: DataFrame, size: int = VOCABULARY) -> tuple[Vocabulary, int]:
    """(vocabulary, words of the corpus): the most frequent words come to the driver, whole count levels, and of the one that
    crosses ``size`` a part by hash."""
    short = F.octet_length("word") <= LONGEST
    level, part = F.expr(bucket("n")), F.pmod(F.xxhash64("word"), F.lit(PARTS))
    levels = counts.groupBy(level.alias("at")).agg(F.sum("n").alias("n"), F.count("*").alias("kinds"), F.count_if(short).alias("short"))
    levels = levels.orderBy(F.desc("at")).collect()  # some thousand rows at most
    chosen, held = F.lit(False), 0
    for at in levels:
        if held + at.short <= size:
            held, chosen = held + at.short, F.col("n") >= at["at"]
            continue
        parts = counts.where(short & (level == at["at"])).groupBy(part.alias("part")).count().orderBy("part").collect()  # PARTS rows at most
        upto = 0
        for x in parts:
            if held + x["count"] > size:
                break
            held, upto = held + x["count"], x.part + 1
        chosen = chosen | ((level == at["at"]) & (part < upto))
        break
    top = [(r.word, r.n) for r in counts.where(short & chosen).collect()]
    leaves = np.zeros(LEAVES)
    leaf = (F.crc32(F.encode("word", "utf-8")) % LEAVES).cast("int")
    for x in counts.where(~(short & chosen)).groupBy(leaf.alias("leaf")).agg(F.sum("n").alias("n")).collect():  # LEAVES rows at most
        leaves[x.leaf] = x.n
    vocabulary = Vocabulary.of(sorted(top, key=lambda x: (-x[1], x[0])), leaves, sum(x.kinds for x in levels))
    return vocabulary, sum(x.n for x in levels)


def score_documents(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Pseudo-log-likelihood of every whole text.

    Added to ``keep`` (all columns by default; those named like a new one, in any case, are replaced): ``n_tokens``,
    ``log_prob`` (sum over the words of log p(word | the two words on either side), in nats) and ``mean_log_prob`` (null
    without words).

    Words of the whole corpus are counted, and texts written as codes. log p(word) is log p(class | both sides) plus log
    p(word | class, both sides), from a network in numpy that sees the words on either side (the ``OWN`` most frequent by
    embeddings of their own, others by ``SHARED`` hashed ones). Within a class the network adds to the log odds of the counts
    at the nodes of a tree, whose leaves are the words that tasks hold, or ``LEAVES`` groups by hash of all others; within
    such a group words follow their counts, to which they are joined. The network is trained by local SGD on all documents:
    shards of ``SHARD_WORDS`` words start alike, and their weights are averaged by words, summed ``FAN_IN`` to a task; the same
    rows give the same weights, however they are laid out (up to the rounding of floats). What a task holds is bounded by ``VOCABULARY`` whatever the
    corpus. Codes, counts, weights and the rarer words of each text are shuffled. Null and empty texts have no words and a sum
    of 0; repeated rows score alike; an empty table gives an empty result.
    """
    need(docs, text_col)
    boxed = Boxed(docs, keep, ["n_tokens", "log_prob", "mean_log_prob"])
    counts = word_counts(docs, text_col)
    vocabulary, words = corpus_vocabulary(counts)
    vocabulary_b = docs.sparkSession.sparkContext.broadcast(vocabulary)
    text = col_of(text_col)
    # The place of a row in training follows from all that is kept of it, so copies of a text are dealt apart.
    rows = docs.select(boxed.box, F.monotonically_increasing_id().alias("_row"), F.xxhash64(boxed.hashed(), text).alias("_key"), text.alias("_text"))
    pair = T.ArrayType(T.StructType([T.StructField("word", T.StringType()), T.StructField("k", T.LongType())]))
    kinds = T.StructType([rows.schema["_doc"], T.StructField("_row", T.LongType()), T.StructField("_key", T.LongType()), T.StructField("_codes", T.BinaryType()), T.StructField("_rest", pair)])
    coded = materialize(rows.mapInArrow(_coded(vocabulary_b), kinds), "zstd")
    weights_b = docs.sparkSession.sparkContext.broadcast(train(coded, vocabulary_b, words))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [np.empty(0), *[score_codes(codes, vocabulary_b.value, weights_b.value) for codes in _bunches(batch.column("_codes"))]]
            sizes = pa.array([len(x) // 2 for x in batch.column("_codes").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("_doc"), batch.column("_row"), sizes, pa.array(np.concatenate(sums))], ["_doc", "_row", "n_tokens", "log_prob"])

    kinds = T.StructType([rows.schema["_doc"], T.StructField("_row", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("log_prob", T.DoubleType())])
    rows = coded.select("_doc", "_row", "_codes").mapInArrow(scored, kinds)
    if vocabulary.rest:
        found = coded.select("_row", F.explode("_rest").alias("_x")).select("_row", "_x.word", "_x.k").join(counts.where("n > 1"), "word")  # the log of 1 adds nothing
        # Whole billionths, so that equal texts have equal sums in whatever order.
        added = found.groupBy("_row").agg((F.sum(F.col("k") * F.round(F.log("n") * 1e9).cast("long")) / 1e9).alias("_added"))
        rows = rows.join(added, "_row", "left").withColumn("log_prob", F.col("log_prob") + F.coalesce("_added", F.lit(0.0)))
    return rows.select(*boxed.columns(), "n_tokens", "log_prob", F.when(F.col("n_tokens") > 0, F.col("log_prob") / F.col("n_tokens")).alias("mean_log_prob"))


def op8_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), keep=["doc_id"])
