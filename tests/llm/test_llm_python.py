"""Brute-force checks, round trips and held-out accuracy of the operators with numpy or plain Python in tasks."""

import base64
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarrystone.llm import lmscore, neardup, suffixdup, suffixes, urls, warc
from quarrystone.llm.shingles import set_key, shingle_set


def prose(rng, n, letters="abcdeft"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n))


def shingles(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_classes(rows, percent):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    out = {}
    for i in range(len(rows)):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out[i] = min(ids) if ids else None
    return [(rows[i][0], len(sets[i]), out[i]) for i in range(len(rows))]


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates_match_brute_force(spark, percent):
    rng = random.Random(2)
    base = [prose(rng, n) for n in (60, 80, 70, 3, 120)]
    rows = [(i, t) for i, t in enumerate(base)] + [(10, None), (11, ""), (12, " \t"), (13, base[0]), (14, base[3].upper()), (None, base[1]), (15, "One two"), (16, "one  TWO"), (17, base[4]), (17, base[4])]
    for k in range(60):  # one group of copies with up to four edits: chains, and members that link with none
        w = base[k % 2].split()
        for _ in range(rng.randint(1, 4)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(6)}"
        rows.append((100 + k, " ".join(w)))
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit("clash"))
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in neardup.near_duplicates(d, percent=percent).collect()), key=str)
    assert got == sorted(brute_classes(rows, percent), key=str)
    kept = neardup.drop_near_duplicates(d, percent=percent)
    assert kept.columns == d.columns and {r.doc_id for r in kept.collect()} == {i for i, _, c in brute_classes(rows, percent) if i == c}
    assert neardup.near_duplicates(d.limit(0)).count() == 0


def test_shingle_hashes_follow_the_words():
    rng = random.Random(3)
    for n in (0, 1, 4, 5, 6, 300):
        t = prose(rng, n, "ab")
        assert len(shingle_set(t)) == len(shingles(t))
    assert set_key(shingle_set("A b\tc d  e f")) == set_key(shingle_set("a B c d e F"))
    assert set_key(shingle_set("a b c d e f")) != set_key(shingle_set("a b c d f e"))


def brute_cut(rows):
    first, out = {}, []
    for i, t in rows:
        b = (t or "").encode()
        for s in range(len(b) - 49):
            key = b[s : s + 50]
            first[key] = min(first.get(key, math.inf), math.inf if i is None else i)
    for i, t in rows:
        b, order = (t or "").encode(), math.inf if i is None else i
        gone = [False] * len(b)
        for s in range(len(b) - 49):
            if first[b[s : s + 50]] < order:
                gone[s : s + 50] = [True] * 50
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        left = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [5, 1000])
def test_repeats_match_brute_force(spark, hot):
    rng = random.Random(4)
    passages = [prose(rng, 25), "ä" * 60 + "z" * 70, prose(rng, 12)[:50]]
    rows = [(i, prose(rng, 20) + passages[i % 3] + prose(rng, 15)) for i in range(40)]
    rows += [(50, None), (51, ""), (52, "short"), (53, "short"), (54, rows[3][1]), (54, rows[3][1]), (None, rows[5][1]), (None, rows[6][1][5:]), (55, "q" * 300), (56, "q" * 120 + "\x00" * 80), (57, "\x00" * 80), (58, rows[7][1] + rows[8][1])]
    rng.shuffle(rows)
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit("clash"))
    got = suffixdup.cut_repeats(d, hot_texts=hot).collect()
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted((tuple(r[n] for n in names) for r in got), key=str) == sorted(brute_cut(rows), key=str)
    for r in got:
        assert hashlib.sha256(bytes(r.kept_text)).hexdigest() == r.kept_sha256 and len(r.removed) == r.n_spans
        assert sum(s.end - s.start for s in r.removed) == r.n_removed
    assert suffixdup.cut_repeats(d.limit(0), texts=False).count() == 0


def test_anchors_depend_on_the_string_alone():
    rng = random.Random(12)
    texts = [bytes(rng.choice(b"abc") for _ in range(rng.choice([0, 10, 49, 50, 51, 200]))) for _ in range(40)]
    texts.append(texts[-1][:120] + texts[-1])
    whose, first, last, h = suffixes.anchors(texts, 50, 20)
    anchor_of = {}
    starts = [[] for _ in texts]
    for i, a, b, x in zip(whose, first, last, h, strict=True):
        for s in range(a, b + 1):
            starts[i].append(s)
            assert anchor_of.setdefault(texts[i][s : s + 50], x) == x
            assert x in suffixes.window_hashes(np.frombuffer(texts[i][s : s + 50], np.uint8), 20)
    assert [sorted(s) for s in starts] == [list(range(max(0, len(t) - 49))) for t in texts]


def test_suffix_order_and_prefixes():
    for seed in range(60):
        rng = random.Random(seed)
        strings = [bytes(rng.choice(b"ab\x00\xff"[: rng.randint(1, 4)]) for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(1, 5))]
        line, _ = suffixes.line_up(strings)
        word = suffixes.words(line)
        order = suffixes.suffix_order(line, word, 60)
        flat = line.tolist()
        assert sorted(order.tolist()) == list(range(len(flat)))
        assert [flat[i : i + 60] for i in order] == sorted(flat[i : i + 60] for i in order)
        lcp = suffixes.common_prefixes(word, order, 50)
        for i in range(1, len(order)):
            a, b = (flat[x:] + [0] * 60 for x in (order[i - 1], order[i]))
            assert lcp[i] == next((k for k in range(50) if a[k] != b[k]), 50)


def test_url_rules_and_model(spark):
    rng = random.Random(6)
    rows = [(i, f"https://www.good{rng.randrange(99)}.com/news/{i}") for i in range(60)] + [(100 + i, f"https://spam{rng.randrange(99)}.net/es/win-{i}") for i in range(60)]
    rows += [(200, None), (201, ""), (202, "no scheme"), (203, "HTTP://WWW.Example.COM/en/x?y"), (204, "x://a.example.com/en/"), (205, "x://example.com/EN/"), (206, "x://net"), (207, "x://a.net/fr/#z"), (208, "a://b://c.com/d"), (209, "x://xcom/"), (300, "https://www.good5.org/news/7"), (301, "https://spam5.org/es/win-7")]
    got = {r.page_id: r for r in urls.filter_urls(spark.createDataFrame(rows, "page_id long, url string").withColumn("rule", F.lit(1))).collect()}
    rule = lambda i: (got[i].host, got[i].path, got[i].rule)
    assert rule(200) == rule(201) == rule(202) == ("", "", None)
    assert rule(203) == ("www.example.com", "/en/x", "www.example.com/en/") and got[203].verdict == "allow"
    assert rule(204) == ("a.example.com", "/en/", "example.com/en/") and got[204].verdict == "block"
    assert rule(205)[2] == "com/" and rule(206) == ("net", "", None) and rule(207) == ("a.net", "/fr/", "net/fr/") and rule(208) == ("b:", "//c.com/d", None) and rule(209)[2] is None
    assert got[300].verdict == "allow" and got[301].verdict == "block"
    assert urls.filter_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_url_verdicts_match_brute_force(spark):
    """Sample, models, threshold and verdicts of a table, said again plainly."""
    rng = random.Random(18)
    word = lambda letters: prose(rng, 1, letters)
    pages = [(i, f"https://{word('abcd')}.com/{word('abef')}") for i in range(90)] + [(200 + i, f"http://{word('xyz')}.net/es/{word('xqz')}?{i}") for i in range(70)]
    pages += [(400 + i, f"https://{word('abcdxyz')}.{rng.choice(['org', 'info'])}/{word('abqz')}") for i in range(60)] + [(500, pages[0][1]), (501, None), (502, "x" * 3000 + "://a.com/"), (503, "ü://ä.com/é")]
    sample, longest, held = 50, 2000, urls.HELD_OUT
    got = {r.page_id: r for r in urls.filter_urls(spark.createDataFrame(pages, "page_id long, url string"), sample=sample).collect()}
    of = lambda verdict: {u for i, u in pages if u and len(u) <= longest and got[i].rule and got[i].verdict == verdict}
    hashed = {r.u: r.h for r in spark.createDataFrame([(u,) for u in of("allow") | of("block")], "u string").select("u", F.xxhash64("u").alias("h")).collect()}
    taken = {v: sorted(of(v), key=lambda u: (hashed[u], u))[:sample] for v in ("allow", "block")}
    part = lambda v, out: [u for k, u in enumerate(taken[v]) if (k % held == 0) == out]

    def log_p(model_urls, url):
        text, total = "\x02" * urls.ORDER + url, 0.0
        for at in range(urls.ORDER, len(text)):
            p = 1 / 256
            for k in range(urls.ORDER + 1):
                context = text[at - k : at]
                after = [t[j] for t in ("\x02" * urls.ORDER + u for u in model_urls) for j in range(urls.ORDER, len(t)) if t[j - k : j] == context]
                if not after:
                    break
                p = (after.count(text[at]) + len(set(after)) * p) / (len(after) + len(set(after)))
            total += math.log(p)
        return total

    score = lambda u: (log_p(part("allow", False), u) - log_p(part("block", False), u)) / len(u) if u else 0.0
    good, bad = ([score(u) for u in part(v, True)] for v in ("allow", "block"))
    cuts = sorted({*good, *bad})
    cuts = [cuts[0] - 1, *[(x + y) / 2 for x, y in zip(cuts, cuts[1:])], cuts[-1] + 1]  # noqa: B905
    worth = lambda c: sum(s >= c for s in good) / len(good) + sum(s < c for s in bad) / len(bad)
    best = max(map(worth, cuts))
    for i, u in pages:
        if got[i].rule is None:
            assert abs(got[i].log_ratio - score(u)) < 1e-9
    undecided = {got[i].verdict for i, u in pages if got[i].rule is None}
    threshold = max(s for i, u in pages if got[i].rule is None and got[i].verdict == "block" for s in [got[i].log_ratio])
    assert undecided == {"allow", "block"} and all(r.log_ratio > threshold for r in got.values() if r.rule is None and r.verdict == "allow")
    model = urls.UrlRatio(taken["allow"], taken["block"])
    assert worth(model.threshold) == best and all((r.log_ratio >= model.threshold) == (r.verdict == "allow") for r in got.values() if r.rule is None)


def test_url_model_counts_all_labelled(spark):
    """By default every labelled URL is counted or held out, those of over 2000 characters too; held or joined steps agree."""
    rng = random.Random(19)
    word = lambda letters: prose(rng, 1, letters)
    pages = [(i, f"https://{word('abcd')}.com/{word('abef')}") for i in range(60)] + [(100 + i, f"http://{word('xyz')}.net/es/{word('xqz')}?{i}") for i in range(60)]
    pages += [(200 + i, f"https://long{i}.com/" + "".join(rng.choice("jkv") for _ in range(2400))) for i in range(6)]
    pages += [(300 + i, f"https://{word('jkvxyz')}.org/{word('abjk')}") for i in range(30)] + [(400, None), (401, pages[0][1])]
    d = spark.createDataFrame(pages, "page_id long, url string")
    got = {r.page_id: r for r in urls.filter_urls(d).collect()}
    held = {r.url for r in d.where(F.pmod(F.xxhash64("url"), F.lit(urls.HELD_OUT)) == 0).collect()}
    of = lambda verdict, out: sorted({u for i, u in pages if u and got[i].rule and got[i].verdict == verdict and (u in held) == out})
    plain = urls.UrlRatio([], [])
    plain.yes, plain.no = urls.MarkovModel(of("allow", False)), urls.MarkovModel(of("block", False))
    threshold = plain._calibrated(*([plain.score(u) for u in of(v, True)] for v in ("allow", "block")))
    assert any(len(u) > 2000 for u in of("allow", False)) and of("allow", True) and of("block", True)
    for i, u in pages:
        if got[i].rule is None:
            assert abs(got[i].log_ratio - plain.score(u or "")) < 1e-9 and (got[i].log_ratio >= threshold) == (got[i].verdict == "allow")
    for head in (1, 30):
        assert {r.page_id: r for r in urls.filter_urls(d, head=head).collect()} == got


def test_gradients_are_added_by_row():
    """Calmed means by row, for stretches of ``at`` and for none."""
    rng = np.random.Generator(np.random.PCG64(3))
    rows, d = (rng.standard_normal((n, lmscore.HIDDEN)).astype(np.float32) for n in (50, 200))
    at = rng.integers(0, 50, 600)
    want = rows.astype(np.float64)
    for k in set(at.tolist()):
        found = [d[i % 200] for i in np.flatnonzero(at == k)]
        want[k] -= 0.5 * np.sum(found, axis=0, dtype=np.float64) / (len(found) + lmscore.CALM)
    lmscore._added(rows, at, d, 0.5)
    assert np.abs(rows - want).max() < 1e-5
    before = rows.copy()
    lmscore._added(rows, at[:0], d, 0.5)
    assert (rows == before).all()


def test_url_model_held_out():
    rng = random.Random(7)
    good = [f"https://{prose(rng, 1, 'aeiou')}.org/wiki/{rng.randrange(999)}" for _ in range(300)]
    bad = [f"http://{prose(rng, 1, 'xyzq')}.biz/?id={rng.randrange(999)}" for _ in range(300)]
    model = urls.UrlRatio(good[:200], bad[:200])
    right = sum(model.score(u) >= model.threshold for u in good[200:]) + sum(model.score(u) < model.threshold for u in bad[200:])
    assert right >= 195
    one = urls.MarkovModel(["ab", "ac"], order=2, alphabet=4)
    # empty context: 'a' twice of four, three kinds; after 'a': b and c once each.
    p_b = (1 + 3 * 0.25) / (4 + 3)
    assert math.isclose(math.exp(one.log_p("a", "b")), (1 + 2 * p_b) / (2 + 2))


def test_archives_round_trip(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, f"http://h/{i}", prose(rng, rng.randint(0, 200))) for i in range(80)]
    rows += [(90, None, None), (91, "http://h/\n x", ""), (92, "u", rows[3][2]), (93, "u", rows[3][2]), (93, "v", rows[4][2]), (None, "n", rows[5][2]), (10**12, "far", "é"), (2, "again", rows[2][2])]
    d = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("range", F.lit("clash"))
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    want = []
    for i, _, h in rows:
        b = (h or "").encode()
        revisit = i is not None and first[h or ""] != i
        want.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if revisit else "response", first[h or ""] if revisit else None))
    shas = []
    for n, parts in (("one", 3), ("two", 1)):
        folder = f"file://{tmp_path}/{n}"
        manifest = warc.write_archives(d.repartition(parts), folder, range_bytes=8_000, roll_bytes=2_000).collect()
        assert sum(m.records for m in manifest) == len(rows) and len({m.range for m in manifest}) > 2 and len(manifest) > len({m.range for m in manifest})
        shas.append(sorted((m.file, m.sha256) for m in manifest))
        got = warc.read_archives(spark, folder).collect()
        assert sorted((tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for r in got), key=str) == sorted(want, key=str)
        assert not [p for p in (tmp_path / n).iterdir() if p.name.startswith("_temporary")]
    assert shas[0] == shas[1]
    empty = f"file://{tmp_path}/empty"
    assert warc.write_archives(d.limit(0), empty).count() == 0
    assert warc.read_archives(spark, empty).count() == 0


def build(spark, docs):
    """(vocabulary, coded texts of a table, trained weights)."""
    vocabulary, words = lmscore.corpus_vocabulary(lmscore.word_counts(docs, "text"))
    held = spark.sparkContext.broadcast(vocabulary)
    rows = docs.select(F.struct("doc_id").alias("_doc"), F.col("doc_id").alias("_row"), F.xxhash64("doc_id").alias("_key"), F.col("text").alias("_text"))
    kinds = "_doc struct<doc_id: long>, _row long, _key long, _codes binary, _rest array<struct<word: string, k: long>>"
    return vocabulary, lmscore.train(rows.mapInArrow(lmscore._coded(held), kinds), held, words)


def scores(texts, vocabulary, weights):
    return lmscore.score_codes([vocabulary.encode(" ".join(x))[0] for x in texts], vocabulary, weights).sum()


def plain_score(text, vocabulary, weights):
    """One word after another: the network, the softmax over classes, then the way through the class's tree."""
    words = (text or "").lower().encode().split()
    codes = [vocabulary.entries.get(w, lmscore.VOCABULARY + zlib.crc32(w) % lmscore.SHARED) for w in words]
    entry = [c if c < lmscore.VOCABULARY else len(vocabulary.entries) + (c - lmscore.VOCABULARY) % lmscore.LEAVES for c in codes]
    row = [c if c < lmscore.OWN else lmscore.OWN + zlib.crc32(w) % lmscore.SHARED for c, w in zip(codes, words, strict=True)]
    total = 0.0
    for t, e in enumerate(entry):
        x = weights.b.astype(float)
        for j, o in enumerate(lmscore.OFFSETS):
            x = x + weights.v[j * lmscore.ROWS + (row[t + o] if 0 <= t + o < len(row) else lmscore.ROWS - 1)]
        h = x / (1 + abs(x))
        z = h @ weights.w + weights.c
        total += z[vocabulary.classes[e]] - np.log(np.exp(z).sum()) + vocabulary.base[e]
        for level in range(vocabulary.depth[e]):
            way = vocabulary.way[level][e]
            logit = vocabulary.odds[level][e] + h @ weights.u[way >> 1]
            total -= np.log1p(np.exp(-logit if way & 1 else logit))
    return len(words), total


def test_pseudo_likelihood_matches_plain_loops(spark):
    rng = random.Random(10)
    rows = [(i, prose(rng, rng.randint(1, 60), "abc")) for i in range(30)] + [(40, None), (41, ""), (42, "x"), (43, "A b"), (43, "A b"), (44, "b a " * 3000)]
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"N_Tokens": F.lit("clash"), "_row": F.lit(1), "_text": F.lit(2)})
    vocabulary, weights = build(spark, d)
    weights.u[:-1] += np.random.Generator(np.random.PCG64(2)).standard_normal(weights.u[:-1].shape).astype(np.float32)
    codes = [vocabulary.encode(t)[0] for _, t in rows]
    for (_, text), code, total in zip(rows, codes, lmscore.score_codes(codes, vocabulary, weights), strict=True):
        size, plain = plain_score(text, vocabulary, weights)
        assert size == len(code) and abs(plain - total) < 1e-4 * max(1, size)
    # A word without an entry in the vocabulary stands for all of its leaf.
    few = lmscore.Vocabulary.of([("a", 5), ("b", 3)], np.full(lmscore.LEAVES, 2.0), 700)
    size, plain = plain_score("a c b d a", few, weights)
    assert abs(lmscore.score_codes([few.encode("a c b d a")[0]], few, weights)[0] - plain) < 1e-4
    scored = lmscore.score_documents(d)
    assert scored.columns == ["doc_id", "text", "_row", "_text", "n_tokens", "log_prob", "mean_log_prob"]
    got = {r.doc_id: r for r in scored.collect()}
    assert got[40].n_tokens == 0 and got[40].log_prob == 0 and got[40].mean_log_prob is None and got[43].n_tokens == 2 and got[44]._row == 1
    assert lmscore.score_documents(d.limit(0)).count() == 0


def test_pseudo_likelihood_gradients(spark):
    rng = np.random.Generator(np.random.PCG64(4))
    vocabulary = lmscore.Vocabulary.of([(f"w{i}", 90 - i) for i in range(90)], np.zeros(lmscore.LEAVES), 90)
    weights = lmscore.Weights.start()
    weights.u[:-1] += rng.standard_normal(weights.u[:-1].shape).astype(np.float32)
    for name in ("v", "b", "w", "c", "u"):
        setattr(weights, name, getattr(weights, name).astype(np.float64))
    entries, near = lmscore._near([rng.integers(0, 90, 12).astype(np.uint16)], vocabulary)
    drawn = vocabulary.drawn(entries, rng)
    dh, du, d, h = weights.gradients(near, vocabulary.classes[entries], *drawn)

    def loss():
        x = weights.hidden(near)
        node, sign, odds, weight = drawn
        at = odds + np.einsum("ij,kij->ki", x, weights.u[node])
        return -weights.class_log_p(x, vocabulary.classes[entries]).sum() + (weight * np.log1p(np.exp(-sign * at))).sum()

    def slope(values, at):
        held, found = values[at], []
        for step in (1e-5, -1e-5):
            values[at] = held + step
            found.append(loss())
        values[at] = held
        return (found[0] - found[1]) / 2e-5

    for k in range(lmscore.HIDDEN):
        row, node = near[1, 5], drawn[0][0, 3]
        assert abs(slope(weights.v, (row, k)) - dh[(near == row).nonzero()[1], k].sum()) < 1e-3
        assert abs(slope(weights.u, (node, k)) - du[drawn[0] == node][:, k].sum()) < 1e-3
        assert abs(slope(weights.b, k) - dh[:, k].sum()) < 1e-3
        assert abs(slope(weights.w, (k, 2)) - (h[:, k] * d[:, 2]).sum()) < 1e-3
    # Rows move against their mean gradient.
    rows, at, move = np.zeros((5, 2)), np.array([3, 1, 3]), np.array([[1.0, 2], [4, 8], [3, 4]])
    lmscore._added(rows, at, move, 1.0)
    assert np.allclose(rows[3], -move[[0, 2]].sum(axis=0) / (2 + lmscore.CALM)) and np.allclose(rows[1], -move[1] / (1 + lmscore.CALM)) and not rows[[0, 2, 4]].any()


def test_pseudo_likelihood_does_not_depend_on_the_layout(spark, monkeypatch):
    monkeypatch.setattr(lmscore, "SHARD_WORDS", 500)
    rng = random.Random(13)
    d = spark.createDataFrame([(i, prose(rng, 60)) for i in range(100)], "doc_id long, text string")
    one, two = (sorted((r.doc_id, r.log_prob) for r in lmscore.score_documents(x, keep=["doc_id"]).collect()) for x in (d.coalesce(1), d.repartition(7, "text")))
    assert [x[0] for x in one] == [x[0] for x in two] and np.allclose([x[1] for x in one], [x[1] for x in two], rtol=1e-6)


def test_pseudo_likelihood_learns_order(spark):
    rng = random.Random(11)
    follow = {c: rng.sample("abcdefgh", 2) for c in "abcdefgh"}

    def chain(n):
        c, out = "a", []
        for _ in range(n):
            c = rng.choice(follow[c])
            out.append(c * 3)
        return out

    vocabulary, weights = build(spark, spark.createDataFrame([(i, " ".join(chain(200))) for i in range(1200)], "doc_id long, text string"))
    held = [chain(200) for _ in range(20)]
    mixed = [rng.sample(x, len(x)) for x in held]
    assert scores(held, vocabulary, weights) > scores(mixed, vocabulary, weights) + 0.2 * 4000


def test_pseudo_likelihood_counts_every_word(spark):
    # Over VOCABULARY words of one count, then rarer ones, one of them long: each has its own log p.
    common = [f"c{i}" for i in range(lmscore.VOCABULARY + 1000)]
    # Texts of one word, of one leaf: nothing but their counts sets them apart.
    once, thrice = [w for w in ("y" * 100 + str(i) for i in range(9999)) if zlib.crc32(w.encode()) % 256 == 7][:2]
    rows = [(i, " ".join(common)) for i in range(4)] + [(10, once), (11, thrice), (12, thrice), (13, thrice)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    vocabulary, _ = lmscore.corpus_vocabulary(lmscore.word_counts(d, "text"))
    assert lmscore.VOCABULARY * 0.99 < len(vocabulary.entries) <= lmscore.VOCABULARY
    got = {r.doc_id: r for r in lmscore.score_documents(d).collect()}
    assert abs(got[11].log_prob - got[10].log_prob - math.log(3)) < 1e-6
    assert got[12].log_prob == got[13].log_prob == got[12].mean_log_prob and got[0].n_tokens == len(common)


def test_pseudo_likelihood_tells_words_of_a_class_apart(spark):
    # Words of one count, some ten to a class; each has two successors. Another word of the same class is less likely.
    rng = random.Random(12)
    names = [f"w{i:03}" for i in range(310)]
    follow = {w: rng.sample(names, 2) for w in names}

    def chain(n):
        c, out = rng.choice(names), []
        for _ in range(n):
            out.append(c)
            c = rng.choice(follow[c])
        return out

    vocabulary, weights = build(spark, spark.createDataFrame([(i, " ".join(chain(300))) for i in range(2000)], "doc_id long, text string"))
    alike = {}
    for w, i in vocabulary.entries.items():
        alike.setdefault(int(vocabulary.classes[i]), []).append(w.decode())
    assert np.mean([len(x) for x in alike.values()]) >= 8
    other = {w: x[(i + 1) % len(x)] for x in alike.values() for i, w in enumerate(x)}
    held = [chain(200) for _ in range(20)]
    salad = [[rng.choice([w, other[w]]) for w in x] for x in held]
    assert scores(held, vocabulary, weights) > scores(salad, vocabulary, weights) + 0.2 * 4000
    # All words of a class have a probability of 1 together, whatever the context.
    every = np.arange(len(vocabulary.classes))
    near = np.tile(np.array([[5], [6], [7], [8]]) + np.arange(4)[:, None] * lmscore.ROWS, (1, len(every)))
    log_p = weights.log_p(near, every, vocabulary) - weights.class_log_p(weights.hidden(near), vocabulary.classes)
    total = np.bincount(vocabulary.classes, weights=np.exp(log_p), minlength=lmscore.CLASSES)
    assert np.allclose(total[total > 0], 1, atol=1e-4)
