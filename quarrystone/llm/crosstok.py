"""Alignment of two tokenizers' ids over the same texts, by windows between spaces that no token of either crosses."""

from __future__ import annotations

import gc
import re
from array import array
from base64 import b64decode
from collections.abc import Iterable, Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrystone.llm.common import Boxed, col_of, need
from quarrystone.session import materialize, table

#: Folder and files of the two vocabularies, fixed values of the query's contract; A's as ranks too, and its pattern for words.
FOLDER = "/opt/tokenizers"
A_FILE = "byte_bpe_50k.json"
A_RANKS = "byte_bpe_50k.tiktoken"
A_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
B_FILE = "piece_bpe_32k.model"
#: Windows that a task keeps with their alignment, of LINKS links each on average; it starts anew beyond.
MEMO = 1 << 19
LINKS = 8
#: Characters that are encoded at once, and from which on a text is encoded in pieces.
TOGETHER = 200_000
#: Pairs that a task holds the counts of: those with over 1 / HEAD of all links, so fewer than HEAD whatever the data.
HEAD = 1 << 19
#: The spaces that end a window: neither tokenizer has a token across one that follows no blank (checked for both vocabularies). The
#: two others have been blanks in some version of Unicode. A space at the text's end stays, as B puts none before an empty text.
_WORD_SPACE = re.compile(r" (?<=[^\s\u180E\u200B] )(?!\Z)")
_CROSSED = re.compile(r"[^\s\u180E\u200B] ")
#: Texts that may go to the faster encoder of A's ranks: characters whose class (letter, digit, space, else) is the same in all
#: versions of Unicode, and no run of 500, which its merging would take long for. All others are encoded from A's file itself.
_SPACES = r"\x09-\x0D\x20"
_MARKS = r"\x00-\x08\x0E-\x1F\x21-\x7F\xA1-\u017F\u2010-\u2027\u2030-\u205E\u20AC"
_SETTLED = re.compile("(?:" + "|".join(f"[{c}]{{1,499}}+(?![{c}])" for c in (_MARKS, _SPACES)) + ")*+")


def _byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable Latin-1 for itself, the rest from 256 on."""
    printable = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


#: A's and B's ids of a window.
Encoded = tuple[array, array]


def _spelling(entries: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All entries' bytes one after another, where each begins, and how many it has."""
    sizes = np.array([len(t) for t in entries])
    return np.frombuffer(b"".join(entries), np.uint8), sizes.cumsum() - sizes, sizes


def _spelt(found: list[array], spelling: tuple[np.ndarray, np.ndarray, np.ndarray], raw: list[bytes]) -> np.ndarray:
    """For each of ``found``, whether the bytes of its ids joined are those of ``raw``."""
    flat, starts, sizes = spelling
    ids = np.frombuffer(b"".join(found), np.uint32)
    n_ids, n_raw = (np.fromiter(map(len, x), np.int64, len(x)) for x in (found, raw))
    ends = n_ids.cumsum()
    before = np.append(0, sizes.take(ids).cumsum())
    right = before.take(ends) - before.take(ends - n_ids) == n_raw
    ids, of = ids[np.repeat(right, n_ids)], np.flatnonzero(right)
    n = sizes.take(ids)
    got = flat.take(np.repeat(starts.take(ids) - n.cumsum() + n, n) + np.arange(n.sum()))
    wrong = got != np.frombuffer(b"".join([raw[i] for i in of]), np.uint8)
    if wrong.any():
        right[np.repeat(of, n_raw[of])[wrong]] = False
    return right


class Codec:
    """Both tokenizers and what each of their ids stands for in bytes."""

    def __init__(self, a_path: str, ranks_path: str | None, b_path: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer, pre_tokenizers

        self.a, self.b, self.fast = Tokenizer.from_file(a_path), SentencePieceProcessor(model_file=b_path), None
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        alphabet = _byte_alphabet()
        entry = {i: t for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.bytes_a = [bytes(alphabet[c] for c in t) if all(c in alphabet for c in t) else t.encode() for t in (entry.get(i, "") for i in range(max(entry) + 1))]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.spelling_a, self.spelling_b = _spelling(self.bytes_a), _spelling(self.bytes_b)
        words = self.a.pre_tokenizer
        self.apart = self.a.normalizer is None and isinstance(words, pre_tokenizers.ByteLevel) and words.use_regex and not words.add_prefix_space
        self.apart = self.apart and not any(_CROSSED.search(t.decode(errors="replace")) for v in (self.bytes_a, self.bytes_b) for t in v)
        if ranks_path:
            from tiktoken import Encoding

            with open(ranks_path, "rb") as lines:
                ranks = {b64decode(t): int(i) for t, i in map(bytes.split, lines)}
            if all(self.bytes_a[i] == t for t, i in ranks.items()):
                self.fast = Encoding("a", pat_str=A_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def pieces(self, text: str) -> list[str]:
        """``text``, cut at spaces that no token crosses where it is long; both tokenizers put such a space before each piece."""
        out, at = [], 0
        while self.apart and len(text) - at > TOGETHER and (m := _WORD_SPACE.search(text, at + TOGETHER // 2)):
            out.append(text[at : m.start()])
            at = m.end()
        return [*out, text[at:]]

    def windows(self, piece: str) -> list[str]:
        """``piece``, cut at all spaces that no token crosses."""
        return _WORD_SPACE.split(piece) if self.apart else [piece]

    def ids_a(self, text: str) -> array:
        if self.fast and _SETTLED.fullmatch(text):
            return array("I", self.fast.encode_ordinary(text))
        return array("I", self.a.encode(text, add_special_tokens=False).ids)

    def encode(self, pieces: list[str]) -> list[Encoded | None]:
        """Ids of each piece; None where their joined bytes are not a space and the piece."""
        a, b = [self.ids_a(" " + p) for p in pieces], [array("I", x) for x in self.b.encode(pieces, num_threads=1)]
        raw = [b" " + p.encode() for p in pieces]
        right = _spelt(a, self.spelling_a, raw) & _spelt(b, self.spelling_b, raw)
        return [(x, y) if ok else None for x, y, ok in zip(a, b, right.tolist(), strict=True)]


@lru_cache(maxsize=2)
def _codec(a_path: str, ranks_path: str | None, b_path: str) -> Codec:
    return Codec(a_path, ranks_path, b_path)


class Aligner:
    """Groups and links of texts; a window's ids, checked bytes and alignment are kept by its text."""

    def __init__(self, codec: Codec, memo: int = MEMO):
        self.codec, self.most = codec, memo
        self.lengths = [np.array([len(t) for t in v]) for v in (codec.bytes_a, codec.bytes_b)]
        ids = [str(i) for i in range(max(map(len, self.lengths)))]
        self.most_ids, self.written = len(ids), [c + i for c in "\n;,|" for i in ids]  # an id first in its window, first of A or another in its group, first of B
        self.forget()

    def forget(self) -> None:
        self.memo: dict[str, int] = {}  # place in the lists below, or -1 where bytes differ
        self.texts: list[str] = []
        self.numbers = array("q")  # n_a, n_b and n_groups of each
        self.links, self.starts = array("q"), array("q", [0])  # of all windows, and where each one's begin

    def places(self, windows: list[str]) -> list[int]:
        """The windows' places; those not known yet are encoded, checked and aligned, once each."""
        places = [*map(self.memo.get, windows)]
        if None in places:
            if len(self.memo) > self.most or len(self.links) > LINKS * self.most:
                self.forget()
                places = [None] * len(windows)
            at = [i for i, p in enumerate(places) if p is None]
            new = [*dict.fromkeys([windows[i] for i in at])]
            self.memo.update(zip(new, self.align(self.codec.encode(new)), strict=True))
            for i in at:
                places[i] = self.memo[windows[i]]
        return places

    def align(self, encoded: list[Encoded | None]) -> list[int]:
        """The places of new windows: groups as text, numbers, links as a * vocabulary of B + b; -1 for None."""
        some = [x for x in encoded if x]
        if not some:
            return [-1] * len(encoded)
        ids_a, ids_b = (np.frombuffer(b"".join(x), np.uint32).astype(np.int64) for x in zip(*some, strict=True))
        n_a, n_b = (np.fromiter(map(len, x), np.int64, len(some)) for x in zip(*some, strict=True))
        # All windows one after another: where tokens end, in bytes, and which end a group or a window.
        ends_a, ends_b = self.lengths[0].take(ids_a).cumsum(), self.lengths[1].take(ids_b).cumsum()
        ends = ends_a.take(n_a.cumsum() - 1)
        shared = ends_a[ends_b.take(np.searchsorted(ends_b, ends_a)) == ends_a]
        # A's and B's tokens by group: the ends before each one's own tell the group.
        group_a, group_b = (np.searchsorted(shared, e) for e in (ends_a, ends_b))
        first_a, first_b = (np.searchsorted(g, np.arange(len(shared) + 1)) for g in (group_a, group_b))
        kind_a, kind_b = np.full(len(ids_a), 2), np.full(len(ids_b), 2)
        kind_a[first_a[:-1]], kind_b[first_b[:-1]] = 1, 3
        kind_a[n_a.cumsum() - n_a] = 0
        written = np.empty(len(ids_a) + len(ids_b), np.int64)
        written[np.arange(len(ids_a)) + first_b.take(group_a)] = kind_a * self.most_ids + ids_a
        written[np.arange(len(ids_b)) + first_a.take(group_b + 1)] = kind_b * self.most_ids + ids_b
        # Between two neighbouring ends one A and one B token overlap: a link.
        cuts = np.unique(np.concatenate([ends_a, ends_b]))
        links = ids_a.take(np.searchsorted(ends_a, cuts)) * len(self.lengths[1]) + ids_b.take(np.searchsorted(ends_b, cuts))

        first = len(self.texts)
        self.texts += "".join(map(self.written.__getitem__, written.tolist())).split("\n")[1:]
        self.numbers.frombytes(np.stack([n_a, n_b, np.diff(np.searchsorted(shared, ends, "right"), prepend=0)], 1).tobytes())
        self.starts.frombytes((len(self.links) + np.searchsorted(cuts, ends, "right")).tobytes())
        self.links.frombytes(links.tobytes())
        place = iter(range(first, first + len(some)))
        return [next(place) if x else -1 for x in encoded]

    def _links_of(self, places: np.ndarray) -> np.ndarray:
        links, starts = np.frombuffer(self.links, np.int64), np.frombuffer(self.starts, np.int64)
        first = starts.take(places)
        n = starts.take(places + 1) - first
        return links.take(np.arange(n.sum()) + np.repeat(first - n.cumsum() + n, n))

    def counted(self, pieces: Iterable[list[int]]) -> tuple[int, int, int, int, str, tuple[np.ndarray, np.ndarray], list[str]]:
        """(n_a, n_b, n_groups, n_links, digest, (links, how often each), windows as text) of the places of a text's pieces."""
        digest, texts, links, numbers = sha256(), [], [_NONE], np.zeros(3, np.int64)
        for k, places in enumerate(pieces):
            if min(places) < 0:
                return 0, 0, 0, 0, "", (_NONE, _NONE), []
            texts.append(";".join(map(self.texts.__getitem__, places)))
            digest.update(((";" if k else "") + texts[-1]).encode())
            at = np.array(places)
            numbers += np.frombuffer(self.numbers, np.int64).reshape(-1, 3).take(at, 0).sum(0)
            links.append(self._links_of(at))
        kinds, times = np.unique(np.concatenate(links), return_counts=True)
        return *numbers.tolist(), int(times.sum()), digest.hexdigest() if texts else "", (kinds, times), texts

    def document(self, encoded: list[Encoded | None]) -> tuple[int, int, int, int, str, tuple[np.ndarray, np.ndarray], list[str]]:
        """The same of a text's encoded pieces, each aligned as one window."""
        return self.counted([p] for p in self.align(encoded))


_NONE = np.empty(0, np.int64)
_NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in arrays])])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(arrays), kind))


def _stretches(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours with up to TOGETHER characters in all; one with more stands alone."""
    first, held = 0, 0
    for i, n in enumerate(sizes):
        if i > first and held + n > TOGETHER:
            yield first, i
            first, held = i, 0
        held += n
    if first < len(sizes):
        yield first, len(sizes)


def _aligned(paths: tuple[str, str | None, str], memo: int, long_pairs: bool, groups: bool):
    kind = pa.int64() if long_pairs else pa.int32()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(*paths)
        aligner = Aligner(codec, memo)
        gc.disable()  # millions of small lists and no cycles
        for batch in batches:
            for start, end in _stretches(pc.fill_null(pc.utf8_length(batch.column("_text")), 0).to_pylist()):
                texts = batch.column("_text").slice(start, end - start).to_pylist()
                rows = [map(codec.windows, codec.pieces(t)) if t else [] for t in texts]
                if len(rows) > 1:
                    rows = [[*r] for r in rows]
                    place = iter(aligner.places([w for r in rows for windows in r for w in windows]))
                    found = [aligner.counted([[*islice(place, len(windows))] for windows in r]) for r in rows]
                else:
                    found = [aligner.counted(map(aligner.places, r)) for r in rows]
                columns = [batch.column("_doc").slice(start, end - start), *[pa.array([f[i] for f in found], pa.int64()) for i in range(4)], pa.array([f[4] for f in found])]
                columns += [_lists([f[5][k] for f in found], t) for k, t in enumerate((kind, pa.int32()))]
                names = ["_doc", *_NUMBERS, "groups_sha256", "pairs", "times"]
                if groups:
                    columns, names = [*columns, pa.array([";".join(f[6]) for f in found])], [*names, "groups"]
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return batch.column("pairs").flatten().to_numpy().astype(np.int64), batch.column("times").flatten().to_numpy().astype(np.int64)


def _added_up(pairs: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    kinds, which = np.unique(pairs, return_inverse=True)
    sums = np.zeros(len(kinds), np.int64)
    np.add.at(sums, which, times)
    return kinds, sums


def _pair_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's sum for each pair, in parts of a bounded number of pairs."""
    held = [_NONE, _NONE]
    out = lambda h: pa.RecordBatch.from_arrays([pa.array(h[0]), pa.array(h[1])], ["pair", "n"])
    for batch in batches:
        held = [*_added_up(*(np.concatenate(x) for x in zip(held, _flat(batch), strict=True)))]
        if len(held[0]) > HEAD:
            yield out(held)
            held = [_NONE, _NONE]
    yield out(held)


def _looked_up(head, rest: bool):
    """Each row's sums over pairs of the head, or the rows (_row, pair, times) of its other pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = head.value
        for batch in batches:
            pairs, times = _flat(batch)
            sizes = batch.column("times").value_lengths().to_numpy()
            row = np.repeat(np.arange(batch.num_rows), sizes)
            at = np.minimum(np.searchsorted(pair, pairs), max(len(pair) - 1, 0))
            known = pair[at] == pairs if len(pair) else np.zeros(len(pairs), bool)
            if rest:
                yield pa.RecordBatch.from_arrays([batch.column("_row").take(pa.array(row[~known])), pa.array(pairs[~known]), pa.array(times[~known])], ["_row", "pair", "times"])
                continue
            sums = [np.zeros(batch.num_rows, np.int64) for _ in range(2)]
            for s, v in zip(sums, (n, best), strict=True):
                np.add.at(s, row[known], times[known] * v[at[known]])
            kept = [c for c in batch.schema.names if c not in ("pairs", "times")]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *map(pa.array, sums)], [*kept, "count_sum", "n_best"])

    return run


def _encoded(docs: DataFrame, box: Column, text_col: str, files: tuple[str, str, str | None, str], memo: int, groups: bool) -> tuple[DataFrame, int]:
    """The written alignment of every row, and the size of B's vocabulary."""
    folder, *names = files
    paths = tuple(n and f"{folder}/{n}" for n in names)
    codec = _codec(*paths)
    wide = len(codec.bytes_a) * len(codec.bytes_b) >= 1 << 31
    bare = docs.select(box, col_of(text_col).alias("_text"))
    schema = f"_doc {bare.schema['_doc'].dataType.simpleString()}, " + ", ".join(f"{c} long" for c in _NUMBERS)
    schema += f", groups_sha256 string, pairs array<{'long' if wide else 'int'}>, times array<int>" + ", groups string" * groups
    rows = bare.mapInArrow(_aligned(paths, memo, wide, groups), schema).withColumn("_row", F.monotonically_increasing_id())
    return materialize(rows, "zstd"), len(codec.bytes_b)


def _counted(rows: DataFrame, width: int) -> DataFrame:
    """(pair, n, best) of all linked id pairs, written."""
    counts = materialize(rows.select("pairs", "times").mapInArrow(_pair_counts, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")))
    b = (F.col("pair") % width).alias("b")
    top = counts.groupBy(b).agg(F.max("n").alias("top"))  # a row for each id of B at most
    return materialize(counts.withColumn("b", b).join(F.broadcast(top), "b").select("pair", "n", (F.col("n") == F.col("top")).cast("int").alias("best")))


def token_pairs(docs: DataFrame, text_col: str = "text", folder: str = FOLDER, a_file: str = A_FILE, b_file: str = B_FILE, a_ranks: str | None = A_RANKS, memo: int = MEMO) -> DataFrame:
    """(a, b, n, best): how many links of all texts hold an id pair, and whether no other A id is linked to b more often."""
    need(docs, text_col)
    rows, width = _encoded(docs, F.struct(F.lit(True).alias("none")).alias("_doc"), text_col, (folder, a_file, a_ranks, b_file), memo, False)
    counts = _counted(rows, width)
    return counts.select(F.floor(F.col("pair") / width).cast("int").alias("a"), (F.col("pair") % width).cast("int").alias("b"), "n", (F.col("best") == 1).alias("best"))


def align_tokenizers(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None, folder: str = FOLDER, a_file: str = A_FILE, b_file: str = B_FILE, a_ranks: str | None = A_RANKS, memo: int = MEMO, head: int = HEAD, groups: bool = False) -> DataFrame:
    """Every row's alignment of A's ids (byte-level BPE, of a space and the text) with B's (pieces, of the text).

    Added to ``keep`` (all columns by default; those named like a new one, in any case, are replaced): ``n_a``, ``n_b`` tokens;
    ``n_groups`` between byte offsets at which tokens of both end; ``n_links``, pairs of an A and a B token that share a byte;
    ``n_best``, links whose id pair is the most frequent of its B id over all rows (ties included); ``count_sum``, the sum over
    links of how many links of all rows hold the same id pair; ``groups_sha256`` of the groups as ``a1,a2|b1;a3|b2,b3``; with
    ``groups`` that text too, as ``groups``. ``token_pairs`` gives the counts themselves.

    A's ids are those of ``a_file``; if ``a_ranks`` names the same vocabulary as ranks, texts of characters about which no two
    versions of Unicode differ are encoded from it, four times as fast. Every whole text is encoded and the joined bytes of both are checked, in windows: it is cut at all spaces
    that follow no blank, where both tokenizers begin a token and merge nothing across, so the ids are those of the text in one
    (a test compares both; vocabularies with a token across such a space get no cuts). A window's ids, and with them its groups
    and links, follow from its text alone, so a task encodes, checks and aligns it once and keeps it by its text, some ``memo``
    windows at a time. A row's id pairs are written with their numbers; tasks
    add them up before a shuffle by pair. Pairs with over 1 / ``head`` of all links, fewer than ``head``, go to all tasks as
    arrays; a row's other pairs are joined to the written counts.

    Null and empty texts, and texts whose joined bytes differ (those with U+2581, which B takes for a space), have no
    tokens: zeros and ''. Repeated rows count each. An empty table gives an empty result.
    """
    need(docs, text_col)
    boxed = Boxed(docs, keep, [*_NUMBERS, "n_best", "count_sum", "groups_sha256", *["groups"] * groups])
    rows, width = _encoded(docs, boxed.box, text_col, (folder, a_file, a_ranks, b_file), memo, groups)
    counts = _counted(rows, width)
    total = counts.agg(F.sum("n")).first()[0] or 0
    known = counts.where(F.col("n") * head > total).orderBy("pair").toArrow()
    arrays = tuple(known.column(c).to_numpy().astype(np.int64) for c in ("pair", "n", "best"))
    shared = docs.sparkSession.sparkContext.broadcast(arrays)

    slim = rows.drop("pairs", "times")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema) + ", count_sum long, n_best long"
    scored = rows.select(*slim.columns, "pairs", "times").mapInArrow(_looked_up(shared, False), kinds)
    rest = rows.select("_row", "pairs", "times").mapInArrow(_looked_up(shared, True), "_row long, pair long, times long")
    rest = rest.join(counts, "pair").groupBy("_row").agg(F.sum(F.col("times") * F.col("n")).alias("more_sum"), F.sum(F.col("times") * F.col("best")).alias("more_best"))
    out = scored.join(materialize(rest), "_row", "left")
    plus = lambda x, y: (F.col(x) + F.coalesce(y, F.lit(0))).alias(x)
    return out.select(*boxed.columns(), *_NUMBERS, plus("n_best", "more_best"), plus("count_sum", "more_sum"), "groups_sha256", *["groups"] * groups)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(table(spark, sf_dir, "documents"), keep=["doc_id"])
