"""Alignment against one that looks at every byte."""

import hashlib
import random
from collections import Counter

import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quarrystone.llm import crosstok

ODD = [
    "a", " ", "  two  spaces\n\nlines\t tab ", "naïve café — “quotes” 日本語 🙂  x", "<|endoftext|> <s> </s> <unk> <0x0A> [INST]",
    "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa" * 20, "don't they're I'll 1234567 3.14", "\n\n\n", "é́ ﬁ ① ​﻿", "x\r\ny\x00z\x1f", "Übermäßig große Straße", "a ▁ b",
]


def brute(texts):
    a_tok = Tokenizer.from_file(f"{crosstok.FOLDER}/{crosstok.A_FILE}")
    a_tok.encode_special_tokens = True
    b_tok = sentencepiece.SentencePieceProcessor(model_file=f"{crosstok.FOLDER}/{crosstok.B_FILE}")
    letters = [*range(33, 127), *range(161, 173), *range(174, 256)]
    decode = {chr(b): b for b in letters} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(letters)))}
    of_a = lambda i: bytes(decode[c] for c in a_tok.id_to_token(i))
    of_b = lambda i: bytes([int(b_tok.id_to_piece(i)[3:5], 16)]) if b_tok.is_byte(i) else b_tok.id_to_piece(i).replace("▁", " ").encode()
    found = []
    for text in texts:
        a = a_tok.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_tok.encode(text) if text else []
        if not text or not b"".join(map(of_a, a)) == b"".join(map(of_b, b)) == (" " + text).encode():
            found.append(([], [], "", 0, []))
            continue
        at_a = [k for k, i in enumerate(a) for _ in of_a(i)]
        at_b = [k for k, i in enumerate(b) for _ in of_b(i)]
        links = [(a[i], b[j]) for i, j in sorted(set(zip(at_a, at_b, strict=True)))]
        groups, last = [], 0
        for p in range(1, len(at_a) + 1):
            if p == len(at_a) or at_a[p] != at_a[p - 1] and at_b[p] != at_b[p - 1]:
                x, y = sorted(set(at_a[last:p])), sorted(set(at_b[last:p]))
                groups.append(",".join(str(a[k]) for k in x) + "|" + ",".join(str(b[k]) for k in y))
                last = p
        found.append((a, b, ";".join(groups), len(groups), links))
    n = Counter(x for f in found for x in f[4])
    top = {}
    for (_, b), c in n.items():
        top[b] = max(top.get(b, 0), c)
    sha = lambda g: hashlib.sha256(g.encode()).hexdigest() if g else ""
    return [(len(a), len(b), k, len(x), sum(n[y] == top[y[1]] for y in x), sum(n[y] for y in x), sha(g)) for a, b, g, k, x in found], n, [f[2] for f in found]


def texts():
    rng = random.Random(4)
    words = ["the", "Strasse", "unbelievable", "zzyzx", "don't", "of", "123,456", "naïve", "co-operate", "ing", "HTTP://x.y/z?q=1"]
    made = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 120))) for _ in range(40)]
    return [*ODD, *made, made[0], made[0], None, ""]


FIELDS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("head, memo", [(crosstok.HEAD, crosstok.MEMO), (8, 3), (0, 0)])
def test_matches_bytewise(spark, head, memo):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"N_A": F.lit("clash"), "pairs": F.lit("mine"), "_row": F.lit("mine")}).repartition(3)
    got = {r.doc_id: r for r in crosstok.align_tokenizers(df, head=head, memo=memo, groups=True).collect()}
    want, _, groups = brute([t for _, t in rows])
    assert len(got) == len(rows) and [tuple(got[i][f] for f in FIELDS) for i, _ in rows] == want
    assert [got[i].groups for i, _ in rows] == groups and all(r.pairs == "mine" and r["_row"] == "mine" for r in got.values())
    assert got[ODD.index("a ▁ b")].n_a == 0 and got[0].n_groups == 1


def test_pair_counts(spark):
    df = spark.createDataFrame([(t,) for t in texts()], "text string")
    got = {(r.a, r.b): (r.n, r.best) for r in crosstok.token_pairs(df).collect()}
    _, n, _ = brute(texts())
    assert {k: v[0] for k, v in got.items()} == dict(n)
    assert all(best == (c == max(m for (_, y), m in n.items() if y == b)) for (_, b), (c, best) in got.items())


def test_long_texts_are_cut_without_another_result(spark, monkeypatch):
    rng = random.Random(9)
    long = " ".join(rng.choice(["the", "Haus", "zz,", "\n", "  ", "x1"]) for _ in range(3000))
    codec = crosstok._codec(*(f"{crosstok.FOLDER}/{f}" for f in (crosstok.A_FILE, crosstok.A_RANKS, crosstok.B_FILE)))
    assert codec.apart
    whole = crosstok.Aligner(codec).document(codec.encode([long]))
    monkeypatch.setattr(crosstok, "TOGETHER", 100)
    pieces = codec.pieces(long)
    parts = crosstok.Aligner(codec, 5).document(codec.encode(pieces))
    assert len(pieces) > 50 and " ".join(pieces) == long and parts[:5] == whole[:5]
    assert all((x == y).all() for x, y in zip(parts[5], whole[5], strict=True))


def test_ranks_give_the_ids_of_the_file():
    codec = crosstok._codec(*(f"{crosstok.FOLDER}/{f}" for f in (crosstok.A_FILE, crosstok.A_RANKS, crosstok.B_FILE)))
    rng = random.Random(2)
    settled = [chr(c) for c in range(0x2100) if crosstok._SETTLED.fullmatch(chr(c))]
    made = ["".join(rng.choice(settled if rng.random() < 0.5 else " a1'\n.s\t") for _ in range(rng.randint(1, 60))) for _ in range(4000)]
    assert codec.fast and 400 < len(settled) < 500
    for text in [*made, *[t for t in texts() if t and crosstok._SETTLED.fullmatch(t)]]:
        assert codec.ids_a(text).tolist() == codec.a.encode(text, add_special_tokens=False).ids, text
    assert all(crosstok._SETTLED.fullmatch(t) is None for t in ("a" * 500, "x " + "\n" * 500, "日")) and crosstok._SETTLED.fullmatch("a" * 499 + " ")
    assert codec.ids_a("a" * 5000).tolist() == codec.a.encode("a" * 5000, add_special_tokens=False).ids


def codec():
    return crosstok._codec(*(f"{crosstok.FOLDER}/{f}" for f in (crosstok.A_FILE, crosstok.A_RANKS, crosstok.B_FILE)))


def test_windows_have_the_ids_of_the_whole_text():
    rng, both = random.Random(3), codec()
    parts = [*" " * 30, *"aZ7.é«ж日'\u0301🙂\0", "the", "don't", "'s", "\n", "\t", "\r\n", *"\x0b\x1c\x1f\x85\xa0\u1680\u180e\u2003\u200b\u2028\u202f\u3000\ufeff", "\xa0 \xa0", "<s>", "<|endoftext|>"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 40)))
        windows = both.windows(text)
        found = both.encode(windows)
        assert " ".join(windows) == text and all(windows) and None not in found
        assert [i for a, _ in found for i in a] == both.a.encode(" " + text, add_special_tokens=False).ids, text
        assert [i for _, b in found for i in b] == both.b.encode(text), text
    assert both.windows("a  b \n c d\xa0 e ") == ["a", " b", "\n c", "d\xa0 e "]


def test_a_window_is_encoded_once_and_long_rows_alone(monkeypatch):
    rows = [*texts(), "the of " * 3000 + "▁", *texts(), "Strasse of don't " * 40, "ж" * 300]
    batch = pa.RecordBatch.from_pydict({"_doc": [{"none": True}] * len(rows), "_text": pa.array(rows, pa.string())})
    paths = tuple(f"{crosstok.FOLDER}/{f}" for f in (crosstok.A_FILE, crosstok.A_RANKS, crosstok.B_FILE))
    once, encode = [], crosstok.Codec.encode
    monkeypatch.setattr(crosstok.Codec, "encode", lambda self, pieces: once.extend(pieces) or encode(self, pieces))
    run = lambda memo: pa.Table.from_batches(crosstok._aligned(paths, memo, False, True)(iter([batch]))).to_pydict()
    found = run(crosstok.MEMO)
    assert len(once) == len(set(once)) and sum(map(len, once)) < sum(len(t or "") for t in rows) / 5
    want, _, groups = brute(rows)
    assert [tuple(found[f][i] for f in (*FIELDS[:4], FIELDS[6])) for i in range(len(rows))] == [(*w[:4], w[6]) for w in want] and found["groups"] == groups
    monkeypatch.setattr(crosstok, "TOGETHER", 100)
    assert run(crosstok.MEMO) == found and run(5) == found


def test_empty_table_and_query(spark):
    assert crosstok.align_tokenizers(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert crosstok.token_pairs(spark.createDataFrame([(None,)], "text string")).count() == 0
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in crosstok.op11_token_alignment(spark, sf).collect()}
    want, _, _ = brute([r.text for r in rows])
    assert [tuple(got[r.doc_id][f] for f in FIELDS) for r in rows] == want
