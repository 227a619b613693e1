"""License scan by a positional index of licence words weighted by rarity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarrystone.llm.common import SEPARATOR_CLASS, Boxed, ascii_lower, col_of, let, need
from quarrystone.session import materialize, table

#: Base phrases and their labels, fixed values of the contract.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Notices by label, fixed values: the passages of each licence's usual wording, which must all be found, and the phrases
#: that must stand in the file.
TEMPLATES = [
    ("gpl-3.0", ["this work is licensed under the gnu general public license version 3"], ["gnu general public license version 3"]),
    ("gpl-3.0-or-later", ["you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"], ["free software foundation", "either version 3 of the license"]),
    ("gpl-2.0-or-later", ["you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"], ["free software foundation", "either version 2 of the license"]),
    ("lgpl-3.0", ["licensed under the gnu lesser general public license version 3"], ["gnu lesser general public license"]),
    ("agpl-3.0", ["licensed under the gnu affero general public license version 3"], ["gnu affero general public license"]),
    ("apache-2.0", ["licensed under the apache license version 2 0"], ["apache license version 2 0"]),
    ("mit", ["released under the mit license"], ["mit license"]),
    ("mit", ["permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"], ["permission is hereby granted free of charge"]),
    ("isc", ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"], ["with or without fee is hereby granted"]),
    ("bsd-3-clause", ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software"], ["redistribution and use in source and binary forms", "neither the name of"]),
    ("bsd-2-clause", ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"], ["redistribution and use in source and binary forms"]),
    ("mpl-2.0", ["this source code form is subject to the terms of the mozilla public license v 2 0"], ["mozilla public license v 2 0"]),
    ("cc-by-4.0", ["licensed under cc by 4 0"], ["cc by 4 0"]),
    ("cc-by-sa-4.0", ["licensed under cc by sa 4 0"], ["cc by sa 4 0"]),
    ("cc-by-nc-4.0", ["licensed under cc by nc 4 0"], ["cc by nc 4 0"]),
    ("cc0-1.0", ["released under the cc0 1 0 universal public domain dedication"], ["cc0 1 0"]),
    ("unlicense", ["this is free and unencumbered software released into the public domain"], ["free and unencumbered software"]),
]
#: Labels that do not stand beside another whose passages hold theirs, fixed values: label, the wider one.
WITHIN = [("bsd-2-clause", "bsd-3-clause")]
#: Words that a word may be shifted by against the rest of its passage, and the least percentage of a passage's IDF weight
#: that must be found so.
SLACK = 8
MATCH = 60
#: IDF weights are whole thousandths, so that sums are the same in any order.
SCALE = 1000
#: Every base phrase, and of each template one mandatory phrase at least, holds one of these words; other files are not looked at further.
LEADS = ["license", "by", "mit", "apache", "gnu", "cc0", "mozilla", "permission", "redistribution", "granted", "foundation", "unencumbered"]
PHRASES = sorted({p for _, _, ps in TEMPLATES for p in ps})


def _passages() -> list[tuple[int, int, str]]:
    """(passage number, template number, text)."""
    found = [(t, text) for t, (_, texts, _) in enumerate(TEMPLATES) for text in texts]
    return [(p, t, text) for p, (t, text) in enumerate(found)]


def _postings() -> list[tuple[int, int, str]]:
    return [(p, i, w) for p, _, text in _passages() for i, w in enumerate(text.split())]


def _words() -> list[str]:
    return sorted({w for _, _, w in _postings()})


def _starts(words: Column, phrase: str) -> Column:
    parts = phrase.split()

    def here(i: Column) -> Column:
        test = F.get(words, i) == parts[0]
        for j, w in enumerate(parts[1:], 1):
            test = test & F.coalesce(F.get(words, i + j) == w, F.lit(False))
        return test

    return F.filter(F.sequence(F.lit(0), F.size(words) - 1), here)


def _first_pass(docs: DataFrame, kept: Column, text_col: str) -> DataFrame:
    """One reading of the texts: a number for the row, base places, the licence words there are, and for files with a lead
    word all licence words with their positions and the mandatory phrases."""
    words = F.array_remove(F.split(ascii_lower(F.coalesce(col_of(text_col), F.lit(""))), SEPARATOR_CLASS + "+"), "")
    none = F.array().cast("array<int>")
    listed = F.lit(_words())

    def of(w: Column) -> Column:
        lead = F.arrays_overlap(w, F.lit(LEADS))
        starts = [F.when(lead, _starts(w, p)).otherwise(none).alias(f"b{i}") for i, p in enumerate(BASE)]
        placed = F.filter(F.transform(w, lambda x, i: F.struct(x.alias("w"), i.alias("i"))), lambda y: y["w"].isin(_words()))
        spaced = F.concat(F.lit(" "), F.array_join(w, " "), F.lit(" "))
        present = lambda s: F.filter(F.lit(PHRASES), lambda p: F.contains(s, F.concat(F.lit(" "), p, F.lit(" "))))
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.struct(*starts).alias("b"),
            F.array_intersect(w, listed).alias("there"),
            F.when(lead, placed).alias("placed"),
            F.when(lead, let(spaced, present)).alias("phrases"),
        )

    return docs.select(kept, let(words, of).alias("_c")).select("_doc", F.monotonically_increasing_id().alias("_n"), "_c.*")


def _matches(scanned: DataFrame) -> DataFrame:
    """(_n, added labels, score) of the files that match a template."""
    spark = scanned.sparkSession
    # IDF over all files; a row per licence word, so the index is as small as the templates.
    n = scanned.count()
    df = scanned.select(F.explode("there").alias("w")).groupBy("w").agg(F.count("*").alias("df"))
    weight = F.round((F.log((1.0 + n) / (1.0 + F.coalesce("df", F.lit(0)))) + 1) * SCALE).cast("long")
    weights = spark.createDataFrame([(w,) for w in _words()], "w string").join(df, "w", "left").select("w", weight.alias("v"))
    weights = materialize(weights)
    index = spark.createDataFrame(_postings(), "p int, ti int, w string").join(weights, "w")

    files = scanned.where("size(phrases) > 0").select("_n", "there", "placed", "phrases")
    # Where postings of a file's licence words meet at one position relative to a passage, for every passage whose key phrases
    # are there: words are looked up from the rarest down to the commonest, as a file of many licences has rarer ones than a
    # given passage holds. A file without key phrases is not looked at.
    of = {p: TEMPLATES[t][2] for p, t, _ in _passages()}
    possible = F.array_compact(F.array(*[F.when(F.size(F.array_except(F.lit(n), F.col("phrases"))) == 0, F.lit(p)) for p, n in of.items()]))
    looked_up = files.select("_n", possible.alias("ps"), F.explode("placed").alias("y")).where("size(ps) > 0").select("_n", "ps", "y.w", "y.i")
    met = looked_up.join(F.broadcast(index), "w").where(F.array_contains("ps", F.col("p"))).groupBy("_n", "p", (F.col("i") - F.col("ti")).alias("shift")).agg(F.sum("v").alias("got"))
    best = met.groupBy("_n", "p").agg(F.max(F.struct("got", (-F.col("shift")).alias("back")))["back"].alias("back"))

    # Then all words of the passage, within SLACK of that position, and the mandatory phrases.
    texts = index.groupBy("p").agg(F.collect_list(F.struct("w", "ti", "v")).alias("words"), F.sum("v").alias("whole"), F.max("ti").alias("last"))
    parts = [(p, t, len(TEMPLATES[t][1]), TEMPLATES[t][0], TEMPLATES[t][2]) for p, t, _ in _passages()]
    texts = texts.join(spark.createDataFrame(parts, "p int, t int, n_parts int, label string, needed array<string>"), "p")
    near = F.filter("placed", lambda y: y["i"].between(-F.col("back") - SLACK, F.col("last") - F.col("back") + SLACK))
    found = lambda near: F.aggregate("words", F.lit(0).cast("long"), lambda acc, x: acc + F.when(F.exists(near, lambda y: (y["w"] == x["w"]) & (F.abs(y["i"] - x["ti"] + F.col("back")) <= SLACK)), x["v"]).otherwise(F.lit(0)))
    checked = best.join(F.broadcast(texts), "p").join(files.select("_n", "placed", "phrases"), "_n").where(F.size(F.array_except("needed", "phrases")) == 0)
    checked = checked.select("_n", "t", "n_parts", "label", "whole", let(near, found).alias("got")).where(f"100 * got >= {MATCH} * whole")
    whole = checked.groupBy("_n", "t", "n_parts", "label").agg(F.count("*").alias("k"), F.sum("got").alias("got"), F.sum("whole").alias("whole")).where("k = n_parts")
    return whole.groupBy("_n").agg(F.collect_set("label").alias("added"), F.max(F.col("got") / F.col("whole")).alias("score"))


def scan_licenses(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Licence labels of every row's whole text.

    Added to ``keep`` (all columns by default; those named like a new one, in any case, are replaced): ``n_words``;
    ``n_base``, ``first_word``, ``last_word`` and ``base_labels`` for the places where the words of a base phrase stand;
    ``labels`` with those of matching templates; ``score``, the best template's share of matched weight, 0 without one.

    Words lie between ASCII separators, A-Z lower-cased. The IDF of every licence word is taken over all files. Of each file
    that holds the key phrases of a template, the licence words are looked up in the positional index of its passages, each with
    the weight of its IDF, down to the commonest, so that none is lost in a file of very many licences;
    postings are intersected by relative position (file position less passage position), the heaviest position of a passage
    (the first of equal ones) is verified on all its words, which may be shifted by ``SLACK`` against each other,
    and a template matches if all its passages reach ``MATCH`` percent of their weight and its key phrases stand in the
    file. A label of ``WITHIN`` gives way to its wider one.

    Texts are read once; what is kept of them is the licence words there are, with positions only in files with a lead word.
    Every row has a number of its own, so copies of one text, however many, are spread like other rows. The templates are a
    fixed list, so index and weights (some hundred rows) are broadcast.

    Null and empty texts have no words and no labels; repeated rows share one result; an empty table gives an empty result.
    """
    need(docs, text_col)
    boxed = Boxed(docs, keep, ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])
    scanned = materialize(_first_pass(docs, boxed.box, text_col))
    starts = F.flatten(F.array(*[F.col(f"b.b{i}") for i in range(len(BASE))]))
    base = F.array_compact(F.array(*[F.when(F.size(f"b.b{i}") > 0, F.lit(label)) for i, label in enumerate(BASE.values())]))
    added = F.coalesce("added", F.array().cast("array<string>"))
    for narrow, wide in WITHIN:
        added = F.when(F.array_contains(added, wide), F.array_remove(added, narrow)).otherwise(added)
    listed = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    return scanned.select("_doc", "_n", "n_words", "b").join(_matches(scanned), "_n", "left").select(
        *boxed.columns(),
        "n_words",
        F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        listed(base).alias("base_labels"),
        listed(F.concat(base, added)).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"), keep=["doc_id"])


def _sql() -> str:
    """The same result by plain word positions in all texts."""
    rows = ", ".join(f"({p}, {i}, '{w}')" for p, i, w in _postings())
    parts = ", ".join(f"({p}, {t}, {len(TEMPLATES[t][1])}, '{TEMPLATES[t][0]}', {TEMPLATES[t][2]!r})" for p, t, _ in _passages())
    here = lambda p: " AND ".join(f"w[i + {j}] = '{x}'" for j, x in enumerate(p.split()))
    narrow = " OR ".join(f"(label = '{a}' AND list_contains(all_, '{b}'))" for a, b in WITHIN)
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
    WITH words AS (SELECT doc_id, regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    base AS (SELECT doc_id, label, i - 1 AS i FROM (
      {" UNION ALL ".join(f"SELECT doc_id, '{label}' AS label, unnest(list_filter(range(1, len(w) + 1), lambda i: {here(p)})) AS i FROM words" for p, label in BASE.items())})),
    based AS (SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word FROM base GROUP BY doc_id),
    flagged AS (SELECT doc_id, w, list_filter({PHRASES!r}, lambda p: contains(' ' || array_to_string(w, ' ') || ' ', ' ' || p || ' ')) AS phrases FROM words),
    files AS (SELECT * FROM flagged WHERE len(phrases) > 0),
    postings(p, ti, w) AS (VALUES {rows}),
    parts(p, t, n_parts, label, needed) AS (VALUES {parts}),
    df AS (SELECT w, count(*) AS df FROM (SELECT unnest(list_distinct(w)) AS w FROM words) GROUP BY w),
    weights AS (SELECT w, round((ln((1.0 + (SELECT count(*) FROM words)) / (1.0 + coalesce(df, 0))) + 1) * {SCALE})::BIGINT AS v FROM (SELECT DISTINCT w FROM postings) LEFT JOIN df USING (w)),
    placed AS (SELECT doc_id, unnest(w) AS w, unnest(range(len(w))) AS i FROM files),
    met AS (SELECT doc_id, p, i - ti AS shift, sum(v) AS got FROM placed JOIN postings USING (w) JOIN weights USING (w) GROUP BY ALL),
    best AS (SELECT doc_id, p, shift FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, p ORDER BY got DESC, shift) AS r FROM met) WHERE r = 1),
    seen AS (SELECT DISTINCT b.doc_id, b.p, q.ti, v FROM best b JOIN postings q ON q.p = b.p JOIN weights USING (w) JOIN placed x ON x.doc_id = b.doc_id AND x.w = q.w AND abs(x.i - q.ti - b.shift) <= {SLACK}),
    got AS (SELECT doc_id, p, sum(v) AS got FROM seen GROUP BY ALL),
    sizes AS (SELECT p, sum(v) AS whole FROM postings JOIN weights USING (w) GROUP BY p),
    passed AS (SELECT doc_id, t, n_parts, label, got, whole FROM got JOIN sizes USING (p) JOIN parts USING (p) JOIN files USING (doc_id)
      WHERE list_has_all(phrases, needed) AND 100 * got >= {MATCH} * whole),
    matched AS (SELECT doc_id, label, sum(got) / sum(whole) AS score FROM passed GROUP BY doc_id, t, n_parts, label HAVING count(*) = n_parts),
    added AS (SELECT doc_id, label FROM (SELECT *, list(label) OVER (PARTITION BY doc_id) AS all_ FROM matched) WHERE NOT ({narrow}))
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
      coalesce((SELECT string_agg(DISTINCT label, ',' ORDER BY label) FROM base b WHERE b.doc_id = words.doc_id), '') AS base_labels,
      coalesce((SELECT string_agg(DISTINCT label, ',' ORDER BY label) FROM (SELECT doc_id, label FROM base UNION SELECT doc_id, label FROM added) x WHERE x.doc_id = words.doc_id), '') AS labels,
      coalesce((SELECT max(score) FROM matched a WHERE a.doc_id = words.doc_id), 0.0)::DOUBLE AS score
    FROM words LEFT JOIN based USING (doc_id)"""


OP9_SQL = _sql()
